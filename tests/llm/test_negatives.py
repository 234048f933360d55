"""Hard negatives against all pairs of anchors and rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from mixtape.llm import negatives, oracle, queries


def brute(rows, is_anchor, positives=5, wanted=10, low=30, high=90):
    kept = sorted({(i, l, tuple(int(np.floor(256 * float(c))) for c in v)) for i, l, v in rows
                   if i is not None and l is not None and v is not None
                   and all(c is not None and np.isfinite(c) for c in v)})
    out = []
    for a, label, x in kept:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, l) for i, l, y in kept if i != a)
        near = [(i, -s) for s, i, l in scored if l == label][:positives]
        for p, p_score in near:
            bad = [(i, -s) for s, i, l in scored if l != label and low * p_score <= -100 * s <= high * p_score]
            out += [(a, p, k + 1, i, p_score, s) for k, (i, s) in enumerate(bad[:wanted])]
    return sorted(out)


def mined(df, **more):
    return sorted(tuple(r) for r in negatives.mine(df, F.col("_id") % 10 == 0, **more).collect())


def table(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(3)
    for name in ("_id", "_label", "_v", "x", "row", "anchor", "slot", "rank", "score") if clash else ():
        df = df.withColumn(name, F.lit("x"))
    return df


def vectors(seed, n, dims, spread=1.0, labels=3):
    rnd = np.random.default_rng(seed)
    centres = rnd.standard_normal((labels, dims))
    label = rnd.integers(0, labels, n)
    x = centres[label] + spread * rnd.standard_normal((n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, int(l), [float(c) for c in v]) for i, (l, v) in enumerate(zip(label, x.astype(np.float32)))]


@pytest.mark.parametrize("spread, dims", [(0.3, 12), (5.0, 7)])
def test_against_all_pairs(spark, spread, dims):
    rows = vectors(1, 200, dims, spread)
    assert mined(table(spark, rows), rows_per_cell=40, anchors_per_cell=7) == brute(rows, lambda a: a % 10 == 0)


def test_odd_rows(spark):
    """Nulls, bad entries, repeats, ties, zero vectors, shorter vectors, one label, an id twice."""
    rows = vectors(3, 60, 4)
    rows += [rows[5], rows[5], rows[20], (None, 1, [1.0, 0.0, 0.0, 0.0]), (61, None, [1.0] * 4), (62, 1, None),
             (63, 1, [1.0, None, 0.0, 0.0]), (64, 1, [float("nan")] * 4), (65, 1, [float("inf"), 0.0, 0.0, 0.0]),
             (70, 1, [0.0] * 4), (71, 9, [1.0, 0.0, 0.0, 0.0]), (80, 2, [0.5]), (90, 0, []),
             (100, 0, [0.5, 0.5, 0.5, 0.5]), (101, 0, [0.5, 0.5, 0.5, 0.5]), (102, 0, [0.5, 0.5, 0.5, 0.5]),
             (103, 1, [0.4, 0.4, 0.4, 0.4]), (104, 1, [0.4, 0.4, 0.4, 0.4]), (30, 2, [0.1, 0.2, 0.3, 0.4])]
    assert mined(table(spark, rows)) == brute(rows, lambda a: a % 10 == 0)


def test_no_rows(spark):
    assert mined(table(spark, [])) == []
    assert mined(table(spark, [(10, 1, [1.0, 2.0]), (1, 2, [1.0, 2.0])])) == []


def test_one_label_and_copies(spark):
    """A third of the rows is one vector; another third has one label."""
    rows = vectors(4, 60, 8)
    rows += [(1000 + i, 1, rows[0][2]) for i in range(60)] + [(2000 + i, 7, v) for i, (_, _, v) in enumerate(vectors(5, 60, 8))]
    assert mined(table(spark, rows), rows_per_cell=32) == brute(rows, lambda a: a % 10 == 0)


def test_large_entries(spark):
    rows = [(i, i % 2, [1e5 * (1 + i % 3), 1.0 * i]) for i in range(30)]
    assert mined(table(spark, rows)) == brute(rows, lambda a: a % 10 == 0)
    with pytest.raises(ValueError, match="fit a long"):
        mined(table(spark, [(0, 0, [1e12]), (1, 0, [1e12])]))


def test_matches_leave_out_entries_and_lose_nothing():
    """At a high threshold most entries stay out of the index, and no pair is lost."""
    rnd = np.random.default_rng(7)
    x = np.floor(256 * rnd.standard_normal((300, 32)) / 6).astype(np.int64)
    q = np.concatenate([x[:20], np.floor(256 * rnd.standard_normal((20, 32)) / 6).astype(np.int64), np.zeros((1, 32), np.int64)])
    full = x @ q.T
    for share in (0.99, 0.7, 0.4, 0.1, 0.0, -0.5):
        t = (share * np.sqrt((q * q).sum(1).astype(float)) * np.sqrt((x * x).sum(1).max())).astype(np.int64)
        row, anchor, score = negatives.matches(x, q, t, lambda r, a: np.ones(len(r), bool))
        want = {(int(r), int(a), int(full[r, a])) for r, a in np.argwhere(full >= t)}
        assert {(int(r), int(a), int(s)) for r, a, s in zip(row, anchor, score)} == want
    least = 0.7 * np.sqrt((x * x).sum(1).max())
    index = negatives.Index(x.astype(float), least)
    assert index.keep.mean() < 0.3 and (index.omitted < least).all()


def test_query(spark, sf_smoke):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{sf_smoke}/embeddings.parquet')")
    got = queries.QUERIES["op11_hard_negatives"](spark, sf_smoke)
    want = con.execute(oracle.HARD_NEGATIVES)
    assert got.columns == [d[0] for d in want.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want.fetchall())
