"""One playlist that answers most baskets, one track in most lists: no task gets all of their rows, and
what baskets share is worked out once."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixtape.operators import factors as fac
from mixtape.operators import recommend as rec
from mixtape.operators import topk
from mixtape.operators.skew import join_dealt
from mixtape.plans import checks
from mixtape.session import stage
from tests.test_recommend import _most_rows

N = 6000


@pytest.fixture(scope="module")
def world(spark):
    pairs = stage(spark.range(1200).select((F.col("id") % 40).alias("playlist_id"), (F.pmod(F.xxhash64("id"), F.lit(60)) + 1).cast("int").alias("track_uri_index"))
                  .distinct(), "t-pairs")
    index = spark.createDataFrame([(f"t{i}", i) for i in range(1, 61)], "track string, id int")
    by_id = index.select(F.col("id").alias("track_uri_index"), F.concat(F.lit("name "), "track").alias("track_name"),
                         F.lit("a").alias("artist_name"), F.col("track").alias("track_uri"))
    # nine tenths of the baskets are answered by playlist 3
    src = F.when(F.col("id") % 10 != 0, F.lit(3)).otherwise(F.col("id") / 10 % 40).cast("long")
    route = stage(spark.range(N).select(F.col("id").alias("basket_id"), F.lit("neighbour").alias("method"), src.alias("neighbor_id"),
                                        F.lit(1.0).alias("distance"), src.alias("_src")), "t-route")
    return {"pairs": pairs, "index": index, "by_id": by_id, "route": route, "model": fac.fit_als(pairs, seed=3)}


@pytest.fixture
def plain_joins(spark):
    """Joins by shuffle, whose partitions are left as they are."""
    new = {"spark.sql.autoBroadcastJoinThreshold": -1, "spark.sql.adaptive.enabled": False, "spark.sql.shuffle.partitions": 4}
    keep = {k: spark.conf.get(k) for k in new}
    for k, v in new.items():
        spark.conf.set(k, v)
    yield
    for k, v in keep.items():
        spark.conf.set(k, v)


def _largest(df):
    sizes = [r[1] for r in df.groupBy(F.spark_partition_id()).count().collect()]
    return max(sizes) / sum(sizes)


def test_names_come_before_baskets(spark, world, plain_joins):
    recs = rec.recommend_known(world["model"], world["route"].select(F.col("_src").alias("playlist_id")).distinct(), 1, world["by_id"])
    best = {r.playlist_id: (r.track_uri_index, r.track_name, r.track_uri) for r in recs.collect()}
    found = rec._answer(world["model"], world["route"], 1, "basket_id", "playlist_id", None, world["by_id"])
    rows = found.collect()
    assert len(rows) == N and all((r.track_uri_index, r.track_name, r.track_uri) == best[r.neighbor_id] for r in rows)
    assert _largest(found) < 0.6


def test_enrich_deals_a_track_of_most_rows(spark, plain_joins):
    recs = spark.range(N).select(F.col("id").alias("basket_id"), F.lit(1).alias("rank"),
                                 F.when(F.col("id") % 10 != 0, "u").when(F.col("id") % 20 != 0, F.concat(F.lit("v"), F.col("id") % 7)).alias("track_uri"))
    catalog = spark.createDataFrame([("n", "a", "b", "u"), ("m", "a", "b", "u"), ("n", "a", None, "v3"), ("x", "a", "b", None)],
                                    "track_name string, artist_name string, album_name string, track_uri string")
    found = rec.enrich(recs, catalog)
    want = recs.join(catalog, "track_uri").select(*found.columns)
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))
    assert _largest(found) < 0.6


def test_baskets_that_have_seen_little_share_a_search(spark, world, monkeypatch):
    seen = spark.createDataFrame([(b, i) for b in range(0, N, 3) for i in range(1, 2 + b % 20)], "basket_id long, track_uri_index int")
    alone = []
    unseen = fac.top_k_unseen
    monkeypatch.setattr(fac, "top_k_unseen", lambda m, queries, *a: alone.extend(r[0] for r in queries.select("basket_id").collect()) or unseen(m, queries, *a))
    rows = rec._answer(world["model"], world["route"], 5, "basket_id", "playlist_id", seen, world["by_id"]).collect()
    held = {}
    for r in seen.collect():
        held.setdefault(r.basket_id, set()).add(r.track_uri_index)
    assert sorted(alone) == sorted(b for b, s in held.items() if len(s) > rec.SPARE) and alone
    full = fac.top_k(world["model"], world["route"].select(F.col("_src").alias("playlist_id")).distinct(), 60)
    ranked = {r[0]: [x.track_uri_index for x in sorted(r[1])] for r in full.groupBy("playlist_id").agg(F.collect_list(F.struct("rank", "track_uri_index"))).collect()}
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        assert r.track_uri == f"t{r.track_uri_index}"
        got.setdefault(r.basket_id, []).append((r["rank"], r.track_uri_index))
    src = {r.basket_id: r._src for r in world["route"].collect()}
    assert got == {b: list(enumerate([i for i in ranked[p] if i not in held.get(b, ())][:5], 1)) for b, p in src.items()}


def test_facts_are_found_once_per_list(spark, world):
    recs = stage(rec._answer(world["model"], world["route"], 5, "basket_id", "playlist_id", None, world["by_id"]), "t-recs")
    wrong = recs.withColumn("score", F.when((F.col("basket_id") == 11) & (F.col("rank") == 1), F.col("score") + 1).otherwise(F.col("score")))
    wrong = wrong.withColumn("track_uri", F.when(F.col("basket_id") == 12, F.lit(None)).otherwise(F.col("track_uri")))
    wrong = wrong.where("basket_id <> 13 or rank <> 2").where("basket_id <> 14")
    facts = checks.recs_facts(wrong, world["model"], world["index"], ["basket_id", "method"], F.col("neighbor_id"))
    found = facts.collect()
    rows = {r.basket_id: r for r in found}
    flags = ("n_recs", "ranks_ok", "scores_ordered", "dot_ok", "decoded_ok")
    odd = {11: (5, True, True, False, True), 12: (5, True, True, True, False), 13: (4, False, True, True, True)}
    assert len(found) == N - 1 and set(rows) == set(range(N)) - {14}
    assert all(tuple(r[f] for f in flags) == odd.get(b, (5, True, True, True, True)) for b, r in rows.items())
    assert _most_rows(facts)[0] <= N


def test_residuals_send_vectors_in_single_precision(spark, world):
    left = fac.residuals(world["model"], world["pairs"])
    plan = left._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("as array<double>") == 1          # of the users, a row each
    y = {r.id: np.array(r.features, float) for r in world["model"].itemFactors.collect()}
    x = {r.id: np.array(r.features, float) for r in world["model"].userFactors.collect()}
    gram = sum(np.outer(v, v) for v in y.values())
    mine = {}
    for r in world["pairs"].collect():
        mine.setdefault(r.playlist_id, []).append(y[r.track_uri_index])
    for r in left.collect():
        v = np.array(mine[r.id])
        b = (1 + fac.ALPHA) * v.sum(0)
        off = gram @ x[r.id] + fac.ALPHA * v.T @ (v @ x[r.id]) + fac.REG_PARAM * len(v) * x[r.id] - b
        assert r.residual == pytest.approx(np.linalg.norm(off) / np.linalg.norm(b), rel=1e-6, abs=1e-12)


def test_one_small_file_is_dealt(spark, world):
    """Also where the other side is broadcast, and for a search of few queries."""
    left = stage(world["route"].coalesce(1).select("basket_id", "_src"), "t-left")
    found = join_dealt(left, spark.range(40).select(F.col("id").alias("_src"), F.lit("x").alias("n")), "_src", "basket_id")
    assert found.count() == N and _largest(found) < 0.6
    users = world["model"].userFactors.coalesce(1)
    searched = topk.top_k(users, topk.store_items(world["model"].itemFactors), 3)
    assert searched.count() == 40 and _largest(searched) < 0.6
