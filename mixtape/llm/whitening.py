"""Whitening of embeddings on their leading principal components, by Jacobi-Davidson.

The covariance matrix is never formed. A distributed product centres every
vector of the fit list, multiplies it with a block of directions and sums what
it adds to each (``Covariance.times``); the driver holds a few columns of one
number per dimension. The components come from a subspace that the
Jacobi-Davidson iteration grows: Rayleigh-Ritz gives the best directions inside
it; those whose residual has reached double precision are locked; for each of
the others a projected correction equation, orthogonal to the locked and the
present directions, is solved by inner MINRES, and the corrections join the
subspace. The corrections of a round advance together, so an inner step is one
distributed product for all of them. A full subspace restarts from its best
directions.

Defined results: rows whose vector is null or holds an entry that is null or no
finite number are dropped; null ids stay; shorter vectors count as zero beyond
their end; equal vectors count once in the fit list, and every row gets its own
result; other columns are left out; no rows give none. There are as many
components as dimensions if those are fewer than asked for. A component
without variance (its value is zero to double precision) has no whitened value
(null), explains 0 and takes no part in the identity error; without any
variance that error is 0. A deviation that exceeds long raises an error.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixtape.llm.embed import dimensions, finite, matrix, whole
from mixtape.session import stage

EPS = np.finfo(np.float64).eps
#: Vectors of a stored block, and bytes of vectors that a task of a product reads.
BLOCK, TASK_BYTES = 4096, 8 << 20
#: Tasks of a product at most; beyond it tasks read more.
TASKS = 20_000
#: Inner steps of a correction, and rounds at most.
INNER, OUTER = 6, 500


class Covariance:
    """The covariance of a fit list, as an operator on blocks of directions."""

    def __init__(self, vectors: DataFrame, dims: int):
        """``vectors``: column x, whole numbers, each vector once."""
        self.dims, self.spark = dims, vectors.sparkSession
        sums = vectors.agg(F.count(F.lit(1)), *[F.sum(F.coalesce(F.get("x", F.lit(i)), F.lit(0))) for i in range(dims)]).first()
        self.n, self.sums = int(sums[0]), np.array([int(s or 0) for s in sums[1:]], object)
        self.mean = np.array([float(s) / max(self.n, 1) for s in self.sums])
        tasks = int(min(TASKS, -(-self.n * dims * 8 // TASK_BYTES))) or 1

        def blocks(batches):
            for batch in batches:
                x = matrix(batch.column(0), dims)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[a:a + BLOCK].astype("<i8").tobytes() for a in range(0, len(x), BLOCK)], pa.binary())], names=["block"])

        self.blocks = stage(vectors.select("x").repartition(tasks).mapInArrow(blocks, "block binary"), "fit-blocks")
        self.products = 0

    def _sums(self, add, width: int) -> np.ndarray:
        """The sum over all blocks of ``add(centred vectors)``, a matrix with a row per
        dimension (or fewer) and ``width`` columns; partial sums are added by Spark."""
        dims, mean = self.dims, self.mean

        def partial(batches):
            total = None
            for batch in batches:
                for block in batch.column(0):
                    x = np.frombuffer(block.as_buffer(), "<i8").reshape(-1, dims)
                    value = add(x - mean)
                    total = value if total is None else total + value
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), *(pa.array(c, pa.float64()) for c in total.T)],
                                                 names=["i", *(f"c{j}" for j in range(width))])

        schema = "i int, " + ", ".join(f"c{j} double" for j in range(width))
        rows = self.blocks.mapInArrow(partial, schema).groupBy("i").agg(*[F.sum(f"c{j}").alias(f"c{j}") for j in range(width)]).collect()
        out = np.zeros((len(rows), width))
        for row in rows:
            out[row[0]] = row[1:]
        return out

    def times(self, block: np.ndarray) -> np.ndarray:
        """The covariance matrix times a block of directions: one distributed pass."""
        self.products += 1
        return self._sums(lambda x: x.T @ (x @ block), block.shape[1]) / self.n

    def trace(self) -> float:
        return float(self._sums(lambda x: (x * x).sum(0)[:, None], 1).sum()) / self.n

    def moments(self, project) -> np.ndarray:
        """Covariance of the projected fit list, centred by its own mean."""
        def add(x):
            w = project(x)
            return np.concatenate([w.T @ w, w.sum(0)[None, :]])
        width = project(np.zeros((1, self.dims))).shape[1]
        got = self._sums(add, width) / self.n
        return got[:-1] - np.outer(got[-1], got[-1])


def _orthonormal(block: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """The block made orthonormal and orthogonal to the bases; what they span already goes."""
    size = np.linalg.norm(block, axis=0)
    block = block[:, size > 0] / size[size > 0]
    for _ in range(3):
        for base in bases:
            block = block - base @ (base.T @ block)
    out = np.zeros((len(block), 0))
    for column in block.T:
        before = np.linalg.norm(column)
        for _ in range(3):
            column = column - out @ (out.T @ column)
            for base in bases:
                column = column - base @ (base.T @ column)
        after = np.linalg.norm(column)
        if after > 1e-10 * max(before, 1e-300) and after > 1e-12:
            out = np.column_stack([out, column / after])
    return out


def _corrections(operator, theta: np.ndarray, base: np.ndarray, residuals: np.ndarray, steps: int, tolerance: float) -> np.ndarray:
    """MINRES for (1 - QQ')(A - theta)(1 - QQ') t = -r, all columns in step: one product each time."""
    def project(block):
        block = block - base @ (base.T @ block)
        return block - base @ (base.T @ block)

    def dot(a, b):
        return (a * b).sum(0)

    n, k = residuals.shape
    x = np.zeros((n, k))
    v = project(-residuals)
    beta = np.sqrt(dot(v, v))
    first = np.where(beta > 0, beta, 1.0)
    v = v / first
    v_old, w, w_old = np.zeros((n, k)), np.zeros((n, k)), np.zeros((n, k))
    eta, going = beta.copy(), beta > 0
    c_old = c = np.ones(k)
    s_old = s = np.zeros(k)
    beta = np.zeros(k)
    for _ in range(steps):
        if not going.any():
            break
        p = np.zeros((n, k))
        p[:, going] = project(operator(v[:, going]) - theta[going] * v[:, going])
        alpha = dot(v, p)
        p = p - alpha * v - beta * v_old
        beta_new = np.sqrt(dot(p, p))
        # the new column of the tridiagonal matrix under the last two rotations
        delta = c * alpha - c_old * s * beta
        rho = np.sqrt(delta ** 2 + beta_new ** 2)
        r2, r3 = s * alpha + c_old * c * beta, s_old * beta
        safe = np.where(rho > 0, rho, 1.0)
        c_new, s_new = delta / safe, beta_new / safe
        w_new = (v - r3 * w_old - r2 * w) / safe
        x = x + np.where(going & (rho > 0), c_new * eta, 0.0) * w_new
        eta = np.where(going, -s_new * eta, eta)
        going = going & (rho > 0) & (np.abs(eta) > tolerance * first) & (beta_new > EPS * first)
        v_old, v = v, p / np.where(beta_new > 0, beta_new, 1.0)
        w_old, w, beta = w, w_new, beta_new
        c_old, c, s_old, s = c, c_new, s, s_new
    return x


def leading(covariance: Covariance, count: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(values, directions) of the largest ``count`` eigenpairs, the largest first."""
    d = covariance.dims
    count = min(count, d)
    largest = 8 * count
    locked = np.zeros((d, 0))
    values = np.zeros(0)
    basis = _orthonormal(np.random.default_rng(seed).standard_normal((d, min(d, 2 * count))))
    image = covariance.times(basis)
    best, idle = np.inf, 0
    for turn in range(OUTER):
        need = count - len(values)
        h = basis.T @ image
        theta, y = np.linalg.eigh((h + h.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        norm = max([abs(theta[0]) if len(theta) else 0.0, *np.abs(values)])
        # as many directions again are corrected along: they cost no product more
        wide = need + count
        u, au = basis @ y[:, :wide], image @ y[:, :wide]
        residuals = au - theta[:wide] * u
        residuals -= locked @ (locked.T @ residuals)
        size = np.linalg.norm(residuals[:, :need], axis=0)
        limit = d * EPS * norm
        # rounding of the products may stay a little above the limit
        idle = 0 if size.max() < 0.5 * best else idle + 1
        best = min(best, size.max())
        if idle >= 5 and best <= 100 * limit:
            limit = max(limit, size.max())
        ready = int(np.argmin(np.append(size <= limit, False)))
        if ready:
            locked = np.column_stack([locked, u[:, :ready]])
            values = np.append(values, theta[:ready])
            if len(values) == count:
                # one more Rayleigh-Ritz step among the locked directions, in falling order
                q = np.linalg.qr(locked)[0]
                h = q.T @ covariance.times(q)
                values, y = np.linalg.eigh((h + h.T) / 2)
                return values[::-1], q @ y[:, ::-1]
            rest = y[:, ready:]
            basis, image = basis @ rest, image @ rest
            best, idle = np.inf, 0
            if basis.shape[1]:
                continue
        fresh = np.zeros((d, 0))
        if not ready and u.shape[1]:
            if basis.shape[1] >= largest:
                basis, image = basis @ y[:, :2 * need], image @ y[:, :2 * need]
            q = np.column_stack([locked, u])
            if q.shape[1] < d:
                t = _corrections(covariance.times, theta[:wide], q, residuals, INNER, max(1e-3, 0.1 ** (turn + 1)))
                fresh = _orthonormal(t, locked, basis)
        if not fresh.shape[1]:
            fresh = _orthonormal(np.random.default_rng(seed + turn + 1).standard_normal((d, 1)), locked, basis)
        if fresh.shape[1]:
            basis, image = np.column_stack([basis, fresh]), np.column_stack([image, covariance.times(fresh)])
    raise RuntimeError(f"no {count} components after {OUTER} rounds")


def whiten(rows: DataFrame, components: int = 4, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) of every row that
    takes part, for the leading components numbered from 1."""
    spark = rows.sparkSession
    kind = rows.schema[id_col].dataType.simpleString()
    schema = (f"id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    kept = stage(rows.select(F.col(id_col).alias("id"), F.col(vector_col).alias("_v")).where(finite(F.col("_v")))
                 .select("id", whole(F.col("_v"), scale).alias("x")), "whole-vectors")
    dims = dimensions(kept, "x")
    if dims <= 0:
        return spark.createDataFrame([], schema).withColumnRenamed("id", id_col)
    # zeros at the end count for nothing, also in what counts as equal
    padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("x")))
    covariance = Covariance(stage(kept.select(padded.alias("x")).distinct(), "fit-list"), dims)
    n, sums, mean = covariance.n, covariance.sums, covariance.mean
    values, directions = leading(covariance, components)
    trace = covariance.trace()
    real = values > dims * EPS * trace if trace > 0 else np.zeros(len(values), bool)
    to_unit = directions / np.sqrt(np.where(real, values, 1.0))

    def project(x):
        return x @ to_unit

    error = 0.0
    if real.any():
        got = covariance.moments(lambda x: project(x)[:, real])
        error = float(np.abs(got - np.eye(int(real.sum()))).max())
    explained = [float(v / trace) if r else 0.0 for v, r in zip(values, real)]
    whole_sums = np.array([int(s) for s in sums], np.int64)

    def out(batches):
        k = len(values)
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                x = matrix(part.column(1), dims)
                rough = ((float(n) * x - whole_sums.astype(float)) ** 2).sum(1)
                if len(rough) and rough.max() >= 2.0 ** 63:
                    raise OverflowError("a deviation exceeds long")
                away = n * x - whole_sums
                deviation = (away * away).sum(1)
                white = project(x - mean)
                rows = len(x)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(np.repeat(np.arange(rows), k))),
                    pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, n), pa.int64()),
                    pa.array(np.repeat(deviation, k), pa.int64()),
                    pa.array(white.ravel(), pa.float64(), mask=np.tile(~real, rows)),
                    pa.array(np.tile(explained, rows), pa.float64()), pa.array(np.full(rows * k, error), pa.float64())],
                    names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return kept.mapInArrow(out, schema).withColumnRenamed("id", id_col)
