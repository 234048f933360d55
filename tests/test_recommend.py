"""ALS top-k invariants and batched routing."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixtape.operators import catalog as cat
from mixtape.operators import factors as fac
from mixtape.operators import interactions as inter
from mixtape.operators import recommend as rec
from mixtape.sources import models as mdl
from mixtape.sources import testview as tv
from mixtape.session import scratch_path, stage


@pytest.fixture(scope="module")
def world(spark, sf_smoke):
    from mixtape.operators import index as idx
    rows = tv.playlist_tracks(spark, sf_smoke)
    index = idx.build_index(rows)
    ui = inter.interactions(rows, index).cache()
    pairs = inter.user_items(ui).cache()
    model = fac.fit_als(pairs, seed=42)
    return {"rows": rows, "index": index, "ui": ui, "pairs": pairs, "model": model,
            "by_id": cat.catalog_by_id(ui).cache()}


def test_topk_invariants(spark, world):
    model, pairs = world["model"], world["pairs"]
    users = pairs.select("playlist_id").distinct()
    recs = rec.recommend_known(model, users, 5, world["by_id"]).toPandas()
    assert set(recs.playlist_id) == {r.playlist_id for r in users.collect()}   # all users present
    uf = {r.id: np.array(r.features) for r in model.userFactors.collect()}
    itf = {r.id: np.array(r.features) for r in model.itemFactors.collect()}
    for _, g in recs.groupby("playlist_id"):
        assert list(g.sort_values("rank")["rank"]) == [1, 2, 3, 4, 5]       # no gaps
        scores = list(g.sort_values("rank")["score"])
        assert all(a >= b - 1e-6 for a, b in zip(scores, scores[1:]))      # non-increasing
    row = recs.iloc[0]
    assert float(uf[row.playlist_id] @ itf[row.track_uri_index]) == pytest.approx(row.score, rel=1e-4)
    assert recs.track_uri.notna().all()                                     # every id decodes
    assert recs.groupby(["playlist_id", "rank"]).size().max() == 1         # one row per id (Q13)


def test_same_seed_same_result_and_persistence(spark, world):
    pairs = world["pairs"]
    a = fac.fit_als(pairs, seed=42).userFactors.orderBy("id").collect()
    b = fac.fit_als(pairs, seed=42).userFactors.orderBy("id").collect()
    assert [r.features for r in a] == [r.features for r in b]
    path = scratch_path(spark, "t-als")
    mdl.save_model(world["model"], path)
    loaded = mdl.load_als(path)
    assert loaded.itemFactors.count() == world["model"].itemFactors.count()
    pipe = mdl.save_as_pipeline(world["model"], scratch_path(spark, "t-pipe"))
    assert mdl.load_pipeline_stage(pipe).rank == world["model"].rank


def test_recommend_all_routes_known_and_new(spark, world):
    pairs = world["pairs"]
    some_user = pairs.agg(F.min("playlist_id")).first()[0]
    known_items = [r.track_uri for r in world["ui"].where(F.col("playlist_id") == some_user).limit(3).collect()]
    baskets = spark.createDataFrame(
        [(some_user, u) for u in known_items]                # id clash: an existing playlist (Q15)
        + [(10**9, known_items[0]), (10**9, "part:unknown")]  # a new basket with an unseen key
        + [(10**9 + 1, "part:unknown")],                      # nothing known at all
        "basket_id bigint, track_uri string")
    out = rec.recommend_all(world["model"], baskets, world["index"], pairs, 5, world["by_id"]).toPandas()
    assert set(out.basket_id) == {some_user, 10**9, 10**9 + 1}               # every basket answered
    assert set(out[out.basket_id == some_user].method) == {"known"}
    assert set(out[out.basket_id == 10**9].method) == {"neighbour"}
    assert out.groupby("basket_id").size().to_dict() == {some_user: 5, 10**9: 5, 10**9 + 1: 5}
    own = rec.recommend_known(world["model"], spark.createDataFrame([(some_user,)], "playlist_id bigint"), 5)
    assert sorted(own.toPandas().track_uri_index) == sorted(out[out.basket_id == some_user].track_uri_index)


def test_exclude_seen_and_envelope(spark, world):
    pairs = world["pairs"]
    ui = world["ui"]
    uris = [r.track_uri for r in ui.select("track_uri").distinct().orderBy("track_uri").limit(6).collect()]
    baskets = spark.createDataFrame([(77, u) for u in uris], "basket_id bigint, track_uri string")
    plain = rec.recommend_new(world["model"], baskets, world["index"], pairs, 10, world["by_id"])
    clean = rec.recommend_new(world["model"], baskets, world["index"], pairs, 10, world["by_id"],
                              exclude_seen=True).toPandas()
    assert not set(clean.track_uri) & set(uris)                               # Q14
    assert list(clean.sort_values("rank")["rank"]) == list(range(1, 11))
    env = rec.envelope(plain, baskets).collect()[0]
    doc = json.loads(env.envelope)
    assert doc["input_tracks"] == sorted(uris) and len(doc["recommendations"]) == 10
    # a request keeps its order and repeats; without recommendations its list is empty
    asked = spark.createDataFrame([(77, 0, "z"), (77, 1, uris[0]), (77, 2, "z"), (78, 0, "q")],
                                  "basket_id bigint, pos int, track_uri string")
    docs = {r.basket_id: json.loads(r.envelope) for r in rec.envelope(plain, asked).collect()}
    assert docs[77]["input_tracks"] == ["z", uris[0], "z"] and len(docs[77]["recommendations"]) == 10
    assert docs[78] == {"recommendations": [], "input_tracks": ["q"]}
    enriched = rec.enrich(plain, cat.build_catalog(ui)).toPandas()
    assert set(enriched.track_uri) == set(plain.toPandas().track_uri)


def test_stream_equals_batch(spark, world):
    from mixtape.streaming import baskets as sb
    ui = world["ui"]
    uris = [r.track_uri for r in ui.select("track_uri").distinct().orderBy("track_uri").limit(8).collect()]
    req = spark.createDataFrame([(5, ",".join(uris[:3])), (6, ",".join(uris[3:]))],
                                "basket_id bigint, uri_list string")
    root = scratch_path(spark, "t-stream")
    sb.write_requests(req, f"{root}/in")
    q = sb.start(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", world["model"], world["index"],
                 world["pairs"], world["by_id"], k=4)
    q.awaitTermination()
    got = {(r.basket_id, r.envelope) for r in spark.read.parquet(f"{root}/out").collect()}
    want = {(r.basket_id, r.envelope) for r in sb.recommend_batch(
        req, world["model"], world["index"], world["pairs"], world["by_id"], k=4).collect()}
    assert got == want and len(got) == 2


def test_exclude_seen_covers_what_a_known_playlist_holds(spark, world):
    pairs, ui = world["pairs"], world["ui"]
    user = pairs.groupBy("playlist_id").count().orderBy(F.desc("count"), "playlist_id").first()[0]
    baskets = spark.createDataFrame([(user, "part:1"), (10**9, "part:1"), (10**9, "part:2")],
                                    "basket_id bigint, track_uri string")
    out = rec.recommend_all(world["model"], baskets, world["index"], pairs, 5, world["by_id"], exclude_seen=True).collect()
    held = {r.track_uri for r in ui.where(F.col("playlist_id") == user).collect()}
    mine = [r for r in out if r.basket_id == user]
    assert sorted(r["rank"] for r in mine) == [1, 2, 3, 4, 5] and not {r.track_uri for r in mine} & (held | {"part:1"})
    new = [r for r in out if r.basket_id == 10**9]
    assert sorted(r["rank"] for r in new) == [1, 2, 3, 4, 5] and not {r.track_uri for r in new} & {"part:1", "part:2"}


def test_a_playlist_that_answers_most_baskets_is_not_one_partition(spark, world):
    users = [r.id for r in world["model"].userFactors.orderBy("id").collect()]
    n = 4000
    route = spark.range(n).select(
        F.col("id").alias("basket_id"), F.lit("neighbour").alias("method"),
        F.when(F.col("id") % 10 != 0, F.lit(users[0])).otherwise(
            F.element_at(F.array(*[F.lit(u) for u in users[1:40]]), (F.col("id") / 10 % 39).cast("int") + 1))
        .cast("bigint").alias("neighbor_id"), F.lit(1.0).alias("distance")).withColumn("_src", F.col("neighbor_id"))
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled",
                                           "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        spark.conf.set("spark.sql.adaptive.enabled", False)
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        recs = rec._answer(world["model"], route, 5, "basket_id", "playlist_id", None)
        sizes = [r[1] for r in recs.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert sum(sizes) == 5 * n and max(sizes) <= 2 * 5 * n / 4
    own = rec.recommend_known(world["model"], spark.createDataFrame([(users[0],)], "playlist_id bigint"), 5)
    assert {r.track_uri_index for r in own.collect()} == {
        r.track_uri_index for r in recs.where(F.col("neighbor_id") == users[0]).select("track_uri_index").distinct().collect()}


FIT = """
import sys, tempfile
from mixtape.session import get_session
from mixtape.operators import factors as fac
spark = get_session(sys.argv[1], shuffle_partitions=4, conf={"spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "2g", "spark.checkpoint.dir": tempfile.mkdtemp()})
pairs = spark.read.parquet(sys.argv[2])
model = fac.fit_als(pairs, seed=42)
rows = fac.top_k(model, pairs.select("playlist_id").distinct(), 5, "playlist_id").collect()
print("ROWS", sorted((r.playlist_id, r["rank"], r.track_uri_index) for r in rows))
"""


def test_recommendations_do_not_depend_on_the_number_of_cores(world, tmp_path):
    import os
    import subprocess
    import sys
    path = str(tmp_path / "pairs")
    world["pairs"].coalesce(3).write.parquet(path)
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = [subprocess.run([sys.executable, "-c", FIT, master, path], capture_output=True, text=True, cwd=root, timeout=300,
                          env=os.environ | {"PYTHONPATH": root}).stdout.split("ROWS")[-1] for master in ("local[2]", "local[4]")]
    assert len(out[0]) > 1000 and out[0] == out[1]


def test_stream_batches_release_what_they_store(spark, world):
    import os
    from mixtape.session import ensure_checkpoint_dir
    from mixtape.streaming import baskets as sb
    uris = [r.track_uri for r in world["ui"].select("track_uri").distinct().orderBy("track_uri").limit(3).collect()]
    root = scratch_path(spark, "t-stream-release")
    for i in range(3):
        sb.write_requests(spark.createDataFrame([(i, ",".join(uris))], "basket_id bigint, uri_list string").coalesce(1),
                          f"{root}/in")
    scratch = ensure_checkpoint_dir(spark).removeprefix("file:") + "/mixtape-scratch"
    before = set(os.listdir(scratch))
    q = sb.start(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", world["model"], world["index"],
                 world["pairs"], world["by_id"], k=2, max_files_per_trigger=1)
    q.awaitTermination()
    assert set(os.listdir(scratch)) - before <= {os.path.basename(root)}
    assert spark.read.parquet(f"{root}/out").count() == 3


def _most_rows(df):
    """The largest number of rows that any operator of the executed plan gave."""
    most = []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        metric = node.metrics().get("numOutputRows")
        if metric.isDefined() and ("Join" in node.nodeName() or node.nodeName() == "Generate"):
            most.append((int(metric.get().value()), node.nodeName()))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(most)


def test_exclude_seen_with_a_huge_basket_on_a_hot_playlist(spark, world):
    """One basket that has seen nearly everything costs the baskets beside it nothing."""
    n, k = 500, 5
    items = sorted(r.id for r in world["model"].itemFactors.select("id").collect())
    src = world["pairs"].first()[0]
    route = stage(spark.range(n).select(F.col("id").alias("basket_id"), F.lit("neighbour").alias("method"),
                                        F.lit(src).cast("long").alias("neighbor_id"), F.lit(1.0).alias("distance"),
                                        F.lit(src).cast("long").alias("_src")), "t-route")
    huge = items[:-k - 1]
    seen = spark.createDataFrame([(0, i) for i in huge] + [(b, items[b % 7]) for b in range(1, n)],
                                 "basket_id long, track_uri_index int")
    recs = rec._answer(world["model"], route, k, "basket_id", "playlist_id", seen)
    rows = recs.collect()
    assert len(rows) == n * k
    assert not {(r.basket_id, r.track_uri_index) for r in rows} & {(r.basket_id, r.track_uri_index) for r in seen.collect()}
    assert {r.track_uri_index for r in rows if r.basket_id == 0} <= set(items[-k - 1:])
    assert _most_rows(recs)[0] <= n * k
    # the same as the head of the whole ranking without what was seen
    full = fac.top_k(world["model"], spark.createDataFrame([(src,)], "playlist_id long"), len(items), "playlist_id")
    ranked = [r.track_uri_index for r in full.orderBy("rank").collect()]
    for b in (0, 1, 3):
        own = {r.track_uri_index for r in seen.where(F.col("basket_id") == b).collect()}
        want = [i for i in ranked if i not in own][:k]
        assert [r.track_uri_index for r in sorted(rows, key=lambda r: r["rank"]) if r.basket_id == b] == want
