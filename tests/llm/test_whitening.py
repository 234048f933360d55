"""Whitening against a full eigendecomposition and exact sums."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixtape.llm import queries, whitening


class Dense:
    """A matrix in place of the distributed products."""

    def __init__(self, a):
        self.a, self.dims, self.products = a, len(a), 0

    def times(self, block):
        self.products += 1
        return self.a @ block


def random_covariance(seed, n, d):
    return np.cov(np.random.default_rng(seed).standard_normal((n, d)).T)


@pytest.mark.parametrize("a", [
    random_covariance(0, 5000, 64), random_covariance(1, 40, 64), np.diag([5.0] * 6 + [1.0] * 40), np.zeros((30, 30)), np.eye(12),
    np.array([[2.0]]), np.diag([3.0, 2.0]), np.diag(10.0 ** -np.arange(20)), random_covariance(2, 2, 50), np.diag([1.0, 1 - 1e-9, *[0.5] * 30]),
    1e-6 * random_covariance(3, 900, 150), 1e9 * random_covariance(4, 900, 33)])
def test_leading_to_double_precision(a):
    dense = Dense(a)
    values, u = whitening.leading(dense, 4)
    k, top = min(4, len(a)), max(np.abs(a).max(), 1e-300)
    assert len(values) == k and (np.diff(values) <= 0).all()
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1][:k]).max() <= 1e-12 * top * len(a)
    assert np.linalg.norm(a @ u - u * values, axis=0).max() <= 1e-12 * top * len(a)
    assert np.abs(u.T @ u - np.eye(k)).max() < 1e-12


def test_minres_solves_the_projected_equation():
    a = random_covariance(5, 500, 20)
    rnd = np.random.default_rng(6)
    base = np.linalg.qr(rnd.standard_normal((20, 3)))[0]
    r = rnd.standard_normal((20, 2))
    r -= base @ (base.T @ r)
    theta = np.array([3.0, 0.4])
    t = whitening._corrections(lambda b: a @ b, theta, base, r, 60, 1e-13)
    p = np.eye(20) - base @ base.T
    for j in range(2):
        assert np.abs(p @ (a - theta[j] * np.eye(20)) @ p @ t[:, j] + r[:, j]).max() < 1e-9
    assert np.abs(base.T @ t).max() < 1e-12


def expected(rows, count=4):
    kept = [(i, [int(np.floor(256 * float(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    d = max((len(x) for _, x in kept), default=0)
    kept = [(i, tuple(x + [0] * (d - len(x)))) for i, x in kept]
    fit = np.array(sorted({x for _, x in kept}), float).reshape(-1, d)
    centred = fit - fit.mean(0)
    v = centred.T @ centred / len(fit)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:count], u[:, ::-1][:, :count]
    n, sums = len(fit), [int(s) for s in fit.sum(0)]
    return kept, fit, n, sums, e, u, np.trace(v)


def compare(got, rows):
    kept, fit, n, sums, e, u, trace = expected(rows)
    k = len(e)
    assert len(got) == k * len(kept)
    assert {r.n for r in got} == {n}
    key = lambda i: (i is None, i or 0)
    want_deviation = sorted((key(i), sum((n * c - s) ** 2 for c, s in zip(x, sums))) for i, x in kept for _ in range(k))
    assert sorted((key(r[0]), r.deviation) for r in got) == want_deviation
    for j in range(k):
        own = sorted(((key(r[0]), r.deviation, r.whitened, r.explained) for r in got if r.component == j + 1), key=lambda r: r[:2])
        white = [(key(i), sum((n * c - s) ** 2 for c, s in zip(x, sums)), (np.array(x) - fit.mean(0)) @ u[:, j] / np.sqrt(e[j])) for i, x in kept]
        white.sort(key=lambda r: r[:2])
        a, b = np.array([w for _, _, w, _ in own]), np.array([w for _, _, w in white])
        assert min(np.abs(a - b).max(), np.abs(a + b).max()) < 1e-8
        assert all(abs(x - e[j] / trace) < 1e-12 for _, _, _, x in own)
    assert all(0 <= r.identity_error < 1e-9 for r in got) and len({r.identity_error for r in got}) == 1


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for name in ("id", "x", "_v", "component", "n", "label", "block"):
        df = df.withColumn(name, F.lit("x"))
    return df


def vectors(seed, n, d):
    scale = np.linspace(3, 0.5, d)
    return [(i, [float(c) for c in v]) for i, v in enumerate((np.random.default_rng(seed).standard_normal((n, d)) * scale).astype(np.float32))]


def test_rows(spark):
    rows = vectors(1, 150, 9)
    rows += [rows[3], rows[3], (500, rows[4][1]), (None, rows[5][1]), (501, None), (502, [1.0, None] + [0.0] * 7),
             (503, [float("nan")] * 9), (504, [float("-inf")] + [0.0] * 8), (505, [0.5, -0.0]), (506, [-0.0] * 9), (507, [0.0] * 9)]
    compare(whitening.whiten(table(spark, rows)).collect(), rows)


def test_few_dimensions_and_no_variance(spark):
    rows = vectors(2, 40, 2)
    got = whitening.whiten(table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2}
    compare(got, rows)
    same = whitening.whiten(table(spark, [(i, [1.0, 2.0, 3.0]) for i in range(5)])).collect()
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, None, 0.0, 0.0)} and len(same) == 15
    line = whitening.whiten(table(spark, [(i, [1.0 * i, 2.0 * i, 0.0, 0.0, 0.0]) for i in range(9)])).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in line)
    assert all(abs(r.explained - (r.component == 1)) < 1e-12 for r in line)


def test_no_rows(spark):
    assert whitening.whiten(table(spark, [])).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(table(spark, [])).count() == 0
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0


def test_deviation_beyond_long(spark):
    rows = [(i, [1e7 * (i % 2)] * 2) for i in range(4)] + [(i, [1e7 + i, 5.0]) for i in range(4, 100)]
    with pytest.raises(Exception, match="exceeds long"):
        whitening.whiten(table(spark, rows)).collect()


def test_query(spark, sf_smoke):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_smoke}/embeddings.parquet").select("vec_id", "embedding").collect()]
    compare(queries.QUERIES["op12_whitening"](spark, sf_smoke).collect(), rows)
