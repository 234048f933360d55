"""Exact kNN against brute force, LSH invariants and fallback."""

import math
import random

import pytest
from pyspark.ml.linalg import Vectors

from mixtape.operators import neighbors as nb
from mixtape.operators import vectors as vec


def _brute(baskets, users, k):
    out = {}
    for b, items in baskets.items():
        a = set(i for i in items if i is not None)
        scored = [(round(math.sqrt(len(a) + len(us) - 2 * len(a & us)), 6), u) for u, us in users.items()]
        out[b] = [u for _, u in sorted(scored)[:k]]
    return out


def _fixture(seed, n_users=60, n_items=40, n_baskets=25):
    rnd = random.Random(seed)
    users = {u: set(rnd.sample(range(1, n_items + 1), rnd.randint(1, 12))) for u in range(n_users)}
    users[n_users] = set(users[0])                       # an exact tie with user 0
    baskets = {1000 + b: rnd.sample(range(1, n_items + 5), rnd.randint(1, 6)) for b in range(n_baskets)}
    baskets[2000] = [n_items + 3]                        # no overlap with anybody
    baskets[2001] = [None]                               # only unknown items
    return users, baskets


def _knn(spark, users, baskets, k):
    ex = spark.createDataFrame([(u, i) for u, s in users.items() for i in s],
                               "playlist_id bigint, track_uri_index int")
    bk = spark.createDataFrame([(b, i) for b, s in baskets.items() for i in s],
                               "basket_id bigint, track_uri_index int")
    got = {}
    for r in nb.knn_exact(bk, ex, k=k).orderBy("basket_id", "rank").collect():
        got.setdefault(r.basket_id, []).append(r.neighbor_id)
    return got


@pytest.mark.parametrize("k,seed", [(1, 1), (3, 2), (1, 5), (3, 6), (2, 7)])
def test_knn_exact_equals_brute_force(spark, k, seed):
    users, baskets = _fixture(seed)
    assert _knn(spark, users, baskets, k) == _brute(baskets, users, k)


def test_knn_with_fewer_users_than_k(spark):
    users = {1: {1, 2, 3}, 2: {9}, 3: set(range(20, 60))}
    baskets = {100: [1, 2], 101: [77], 102: list(range(20, 50))}
    assert _knn(spark, users, baskets, 5) == _brute(baskets, users, 5)


def test_knn_exclude_same_id(spark):
    ex = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 9)], "playlist_id bigint, track_uri_index int")
    bk = spark.createDataFrame([(1, 1), (1, 2)], "basket_id bigint, track_uri_index int")
    r = nb.knn_exact(bk, ex, k=1, exclude_same_id=True).collect()[0]
    assert r.neighbor_id == 2 and r.distance == 1.0


def test_lsh_distance_is_euclidean_and_fallback(spark):
    rows = [(1, [1, 2, 3]), (2, [2, 3]), (3, [7, 8, 9, 10]), (4, [5])]
    pairs = spark.createDataFrame([(u, i) for u, s in rows for i in s], "playlist_id bigint, track_uri_index int")
    vectors = vec.sparse_vectors(pairs, 12)
    model = nb.fit_lsh(vectors, bucket_length=4.0, seed=1)
    key = Vectors.sparse(12, [2, 3], [1.0, 1.0])
    hits = nb.ann_single(model, vectors, key, k=4).collect()
    sets = dict(rows)
    for h in hits:
        o = len({2, 3} & set(sets[h.playlist_id]))
        assert h.distCol == pytest.approx(math.sqrt(2 + len(sets[h.playlist_id]) - 2 * o), abs=1e-6)
    hashes = nb.hash_values(model, vectors).collect()
    assert all(len(r.hashes) == nb.LSH_TABLES for r in hashes)
    # a far key matches no bucket -> the exact neighbour answers (Q11)
    tiny = nb.fit_lsh(vectors, bucket_length=1e-9, seed=1)
    far = Vectors.sparse(12, [11], [50.0])
    items = spark.createDataFrame([(0, 11)], "basket_id bigint, track_uri_index int")
    out = nb.ann_with_fallback(tiny, vectors, far, items, pairs, k=1).collect()
    assert [(r.neighbor_id, r.method) for r in out] == [(4, "exact")]


def test_exact_search_is_not_built_when_lsh_answers(spark, monkeypatch):
    pairs = spark.createDataFrame([(1, 1), (1, 2), (2, 2)], "playlist_id bigint, track_uri_index int")
    vectors = vec.sparse_vectors(pairs, 5)
    model = nb.fit_lsh(vectors, bucket_length=100.0, num_tables=20, seed=1)
    monkeypatch.setattr(nb, "knn_exact", None)
    items = spark.createDataFrame([(0, 1), (0, 2)], "basket_id bigint, track_uri_index int")
    out = nb.ann_with_fallback(model, vectors, Vectors.sparse(5, [1, 2], [1.0, 1.0]), items, pairs, k=1).collect()
    assert [(r.neighbor_id, r.distance, r.method) for r in out] == [(1, 0.0, "lsh")]


def test_prefix_with_one_very_popular_item(spark):
    """A third of all rows on one item: prefix candidates equal brute force."""
    rnd = random.Random(11)
    users = {u: set(rnd.sample(range(2, 60), rnd.randint(1, 8))) | ({1} if u % 3 == 0 else set())
             for u in range(90)}
    baskets = {500 + b: [1] + rnd.sample(range(2, 60), rnd.randint(0, 4)) for b in range(30)}
    for k in (1, 3):
        assert _knn(spark, users, baskets, k) == _brute(baskets, users, k)


def test_dense_ann_distances_are_exact(spark, sf_smoke):
    import numpy as np
    import __spark_entry__ as entry
    out = entry.queries()["ann_dense"](spark, sf_smoke).collect()
    emb = {r.vec_id: np.array(r.embedding, dtype=np.float64)
           for r in spark.read.parquet(f"{sf_smoke}/embeddings.parquet").collect()}
    key = emb[min(emb)]
    assert out[0].vec_id == min(emb) and out[0].distCol == 0.0     # the key is its own nearest
    for r in out:
        assert r.distCol == pytest.approx(float(np.linalg.norm(emb[r.vec_id] - key)), abs=1e-4)
    hashes = entry.queries()["lsh_dense_hashes"](spark, sf_smoke).collect()
    assert len(hashes) == len(emb) and all(len(h.hashes) == nb.LSH_TABLES for h in hashes)


def test_many_tables_are_fitted_in_groups_of_bounded_size(spark, monkeypatch):
    """No model holds more numbers than allowed, and the nearest of all groups are the exact ones."""
    rnd = random.Random(5)
    held = {u: sorted(rnd.sample(range(40), rnd.randint(1, 11))) for u in range(60)}
    pairs = spark.createDataFrame([(u, i) for u, items in held.items() for i in items], "playlist_id long, track_uri_index int")
    vectors = vec.sparse_vectors(pairs, 40).persist()
    key = vectors.where("playlist_id = 7").first()["features"]
    exact = sorted(len(set(items) ^ set(held[7])) ** 0.5 for items in held.values())[:4]
    fitted = []
    monkeypatch.setattr(nb, "MODEL_NUMBERS", 300)
    monkeypatch.setattr(nb, "fit_lsh", lambda v, length, n, seed, fit=nb.fit_lsh: fitted.append((n, seed)) or fit(v, length, n, seed))
    got = nb.ann_tables(vectors, key, 4, 1e9, 40).collect()
    assert [r.distCol for r in got] == pytest.approx(exact, abs=1e-5) and len({r.playlist_id for r in got}) == 4
    assert sum(n for n, _ in fitted) == 40 and max(n for n, _ in fitted) * 40 <= 300 and len(set(fitted)) == len(fitted)
