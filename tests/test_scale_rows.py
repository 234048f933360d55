"""Distinct rows are made from keys before names are joined to them."""

from mixtape.operators import interactions as inter
from mixtape.operators import stored_catalog
from mixtape.plans.context import context
from mixtape.session import scratch_path
from mixtape.sources import testview as tv

import datetime


def top(df):
    """The uppermost operator of the plan that isn't a projection."""
    lines = [x.strip(" +-:") for x in df._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    return next(x for x in lines if not x.startswith("Project"))


def test_distinct_rows(spark):
    path = scratch_path(spark, "t-tables").removeprefix("file:")
    day = datetime.datetime(2000, 1, 1)
    lines = [(1, 5), (1, 5), (2, 5), (2, 6), (3, None), (None, 5), (4, 9), (5, 6)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(1, 7, day), (2, 7, day), (3, 8, day), (5, None, day), (5, 8, None)], "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")
    parts = [(5, "a", "b", "c"), (5, "a", "b", "c"), (5, "A", "b", "c"), (6, None, "b", "c"), (None, "n", "b", "c")]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{path}/part.parquet")
    for until in (None, "2000-07-01"):
        found = tv.distinct_playlist_tracks(spark, path, until)
        assert sorted(map(str, found.collect())) == sorted(map(str, tv.playlist_tracks(spark, path, until=until).distinct().collect()))
        assert top(found).startswith("Join")
    assert sorted(map(tuple, tv.order_baskets(spark, path).collect()), key=str) == sorted(
        {(o, None if p is None else f"part:{p}") for o, p in lines}, key=str)


def test_basket_interactions_distinct_before_names(spark):
    baskets = spark.createDataFrame([(1, "u"), (1, "u"), (2, "u"), (2, "v"), (3, None)], "basket_id long, track_uri string")
    catalog = spark.createDataFrame([("n", "a", "b", "u"), ("n", "a", "b", "u"), ("m", "a", "b", "u"), ("n", None, "b", "v")],
                                    "track_name string, artist_name string, album_name string, track_uri string")
    index = spark.createDataFrame([("u", 1), ("u", 1)], "track string, id int")
    found = inter.basket_interactions(baskets, catalog, index)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, [
        (1, "n", "a", "b", "u", 1, 1), (1, "m", "a", "b", "u", 1, 1), (2, "n", "a", "b", "u", 1, 1), (2, "m", "a", "b", "u", 1, 1),
        (2, "n", None, "b", "v", None, 1)]))
    assert top(found).startswith("Join")


def test_parts_share_ranges(spark):
    """However many parts, no more ranges (and rows sampled for their bounds) than shuffle partitions."""
    catalog = spark.range(400).selectExpr("concat('n', id) as track_name", "'a' as artist_name", "'b' as album_name", "concat('u', id) as track_uri")
    path = stored_catalog.write(catalog, scratch_path(spark, "t-parts"), part_rows=3)
    stored = stored_catalog.read(spark, path)
    rows = stored.manifest.orderBy("first_row").collect()
    assert len(rows) > 60 and max(r["n_rows"] for r in rows) < 6
    assert len({r["part"] >> 33 for r in rows}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    uris = sorted(f"u{i}" for i in range(400))
    assert [r["track_uri"] for r in stored_catalog.page(stored, 101, 50).collect()] == uris[101:151]


def _tables(spark):
    """Tables with repeated lines, keys that are null or repeat, and a part that isn't in the catalog."""
    path = scratch_path(spark, "t-tables").removeprefix("file:")
    day = datetime.datetime(2000, 1, 1)
    lines = [(1, 5), (1, 5), (2, 5), (2, 6), (3, None), (None, 5), (4, 9), (5, 6), (6, 8)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long").write.parquet(f"{path}/lineitem.parquet")
    orders = [(1, 7, day), (2, 7, day), (2, 7, day), (3, 8, day), (5, None, day), (5, 8, None), (6, 8, day.replace(year=2001))]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp").write.parquet(f"{path}/orders.parquet")
    parts = [(5, "a", "b", "c"), (5, "A", "b", "c"), (6, None, "b", "c"), (8, "d", "b", "c"), (None, "n", "b", "c")]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_brand string, p_type string").write.parquet(f"{path}/part.parquet")
    return path


def test_distinct_uris_in_tasks_of_bounded_lines(spark, monkeypatch):
    path = _tables(spark)
    monkeypatch.setattr(tv, "TASK_LINES", 1)   # more tasks than lines coalesced by their bytes
    for until in (None, "2000-07-01"):
        found = tv.distinct_playlist_uris(spark, path, until)
        rows = tv.playlist_tracks(spark, path, until=until).select("playlist_id", "track_uri").distinct()
        assert sorted(map(str, found.collect())) == sorted(map(str, rows.collect()))
        assert found.rdd.getNumPartitions() == 9


def test_pairs_are_stored_not_cached(spark):
    """Cached pairs keep shuffle-partition many parts in each of their reads, and executor memory."""
    ctx = context(spark, _tables(spark))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for pairs, rows in ((ctx.pairs, ctx.interactions), (ctx.history_pairs, ctx.history)):
            assert not pairs.storageLevel.useMemory and pairs.rdd.getNumPartitions() < 20
            assert sorted(map(str, pairs.collect())) == sorted(map(str, inter.user_items(rows).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
