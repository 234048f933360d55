"""Hard negatives of anchors by threshold joins over an inverted index, in the manner of L2AP.

A threshold join finds, for every anchor, all rows with an inner product of at
least the anchor's threshold. Rows and anchors meet in cells of bounded size
(a block of rows, a block of anchors). A cell puts its rows into an inverted
index, dimension by dimension; of each row it leaves out the smallest entries
whose norm, times that of any anchor, stays below the threshold. Partial scores
are accumulated along the posting lists; after each few dimensions the rows
whose partial scores plus the product of what remains of both norms reach no
threshold go. What is left is scored exactly, in whole numbers.

Windows are filled from above: each asks for the best rows within a range of
scores and starts with a threshold near the upper end. A cell lowers the
thresholds of the windows that it can't fill, down to the depth of the round;
windows that all cells together leave short are asked again in the next round,
down to their lower end. First every anchor has one
window for its positives, then each (anchor, positive) has one for its negatives.
A cell hands on the wanted number of rows of a window at most, so what is
shuffled for the final choice is bounded by windows x row blocks x wanted.

Defined results: rows with a null id, a null label, a null vector or an entry
that is null or no finite number take no part; shorter vectors count as zero
beyond their end; equal rows (id, label, vector) count once; other rows of one
id stand for themselves and never meet each other; ties go to the smaller id; an
anchor without positives, or a positive without negatives, gives no row; a
window below zero holds nothing; other columns are left out; no rows give none.
Scores must fit a long a hundred times over, else an error is raised.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mixtape.llm.embed import dimensions, finite, matrix, whole
from mixtape.session import stage

#: Rows and anchors of a cell. A cell holds their product in scores of eight bytes at most.
ROWS, ANCHORS = 4096, 1024
#: How far below the upper end of a window the rounds may go: 0 upper, 1 lower end.
POSITIVE_ROUNDS, NEGATIVE_ROUNDS = (0.3, 1.0), (0.5, 1.0)
#: Thresholds of a cell in a round, as parts of that depth.
STEPS = (0.25, 0.5, 1.0)
#: Dimensions between two prunings, and rows whose scores are accumulated together.
STRIDE, TILE = 16, 1024
#: Pairs that are scored exactly together.
CHUNK = 8192


class Index:
    """Posting lists of a block of rows, without the entries that can't matter alone.

    ``least``: for each anchor, what a row's norm must reach to matter (threshold
    over the anchor's norm); the smallest of them bounds what is left out."""

    def __init__(self, x: np.ndarray, least: float):
        kind = x.dtype
        x = x.astype(np.float64, copy=False)
        by_size = np.argsort(-np.abs(x), axis=1, kind="stable")
        squares = np.take_along_axis(x * x, by_size, 1)
        suffix = np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])
        # kept: the entries from whose place on the norm still reaches the bound
        kept = suffix >= least * (1 - 1e-9) if least > 0 else squares > 0
        keep = np.zeros(x.shape, bool)
        np.put_along_axis(keep, by_size, kept & (squares > 0), 1)
        self.keep = keep
        #: norm of what is left out of each row
        self.omitted = np.sqrt(np.where(keep, 0.0, x * x).sum(1))
        #: dimensions with the heaviest postings first
        self.order = np.argsort(-np.where(keep, x * x, 0.0).sum(0), kind="stable")
        kept_values = np.where(keep, x, 0.0)[:, self.order]
        later = kept_values * kept_values
        #: norm of the postings of each row from a place in the order on
        self.later = np.sqrt(np.concatenate([np.cumsum(later[:, ::-1], 1)[:, ::-1], np.zeros((len(x), 1))], 1))
        #: posting lists of each ``STRIDE`` dimensions: the rows with a kept entry there, and their entries
        self.postings = []
        for first in range(0, x.shape[1], STRIDE):
            values = kept_values[:, first:first + STRIDE]
            rows = np.flatnonzero(values.any(1))
            self.postings.append((rows, values[rows].astype(kind)))


def matches(x: np.ndarray, q: np.ndarray, thresholds: np.ndarray, allowed) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, anchor, score) of all pairs that reach the anchor's threshold, scores exact.

    ``allowed(rows, anchors)`` says which pairs count."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(x) or not len(q):
        return none
    largest = math.sqrt(float((x.astype(np.float64) ** 2).sum(1).max()) * float((q.astype(np.float64) ** 2).sum(1).max()))
    # whole numbers up to these are exact in a float
    kind = np.float32 if largest < 1 << 23 else np.float64
    fx, fq = x.astype(kind), q.astype(kind)
    exact_x, exact_q = (fx, fq) if largest < 1 << 52 else (x, q)
    norms = np.sqrt((fq.astype(np.float64) ** 2).sum(1))
    t = thresholds.astype(np.float64)
    least = float(np.min(np.divide(t, norms, out=np.where(t > 0, np.inf, 0.0), where=norms > 0)))
    index = Index(fx, least)
    row_norms = np.sqrt((fx.astype(np.float64) ** 2).sum(1))
    slack = 1e-6 + (1e-6 if kind is np.float32 else 1e-12) * norms * row_norms.max()
    # norm of each anchor from a place in the order of dimensions on
    rest = fq[:, index.order].astype(np.float64) ** 2
    rest = np.sqrt(np.concatenate([np.cumsum(rest[:, ::-1], 1)[:, ::-1], np.zeros((len(q), 1))], 1))
    reach = row_norms >= least * (1 - 1e-9) if least > 0 else np.ones(len(x), bool)
    dims = x.shape[1]
    found = [], []
    for start in range(0, len(x), TILE):
        alive = start + np.flatnonzero(reach[start:start + TILE])
        scores = np.zeros((len(alive), len(q)), kind)
        for group in range(0, len(index.postings) or 1):
            last = min((group + 1) * STRIDE, dims)
            if dims and len(alive):
                rows, values = index.postings[group]
                a, b = np.searchsorted(rows, (start, start + TILE))
                at = np.searchsorted(alive, rows[a:b])
                there = at < len(alive)
                there[there] = alive[at[there]] == rows[a:b][there]
                scores[at[there]] += values[a:b][there] @ fq[:, index.order[group * STRIDE:last]].T
            # what remains of both norms, and what was left out of the index
            bound = np.column_stack([index.later[alive, last], index.omitted[alive], np.ones(len(alive))]).astype(kind) @ np.stack(
                [rest[:, last], norms, slack - t]).astype(kind)
            bound += scores
            stays = bound >= 0
            if last == dims:
                row, anchor = np.nonzero(stays)
                found[0].append(alive[row])
                found[1].append(anchor)
            else:
                some = stays.any(1)
                if not some.all():
                    scores, alive = scores[some], alive[some]
    row, anchor = np.concatenate(found[0]), np.concatenate(found[1])
    good = allowed(row, anchor)
    row, anchor = row[good], anchor[good]
    exact = np.concatenate([np.zeros(0, np.int64), *(
        np.einsum("ij,ij->i", exact_x[row[a:a + CHUNK]], exact_q[anchor[a:a + CHUNK]]).astype(np.int64) for a in range(0, len(row), CHUNK))])
    good = exact >= thresholds[anchor]
    return row[good], anchor[good], exact[good]


def _cell(rows: pa.Table, asks: pa.Table, dims: int, same: bool, want: int) -> pa.Table:
    """The best rows of this cell for every window of its anchors: thresholds go down from
    the upper end until the cell has as many as wanted or the end of the round is reached."""
    ids, labels = (rows.column(c).to_numpy() for c in ("id", "label"))
    anchor_ids, anchor_labels, keys = (asks.column(c).to_numpy() for c in ("id", "label", "anchor"))
    windows = asks.column("windows").combine_chunks()
    sizes = windows.value_lengths().to_numpy(zero_copy_only=False)
    flat = windows.flatten()
    slot, low, high = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
    owner = np.repeat(np.arange(len(keys)), sizes)
    x, q = matrix(rows.column("x"), dims), matrix(asks.column("x"), dims)

    def allowed(row, anchor):
        return ((labels[row] == anchor_labels[anchor]) == same) & (ids[row] != anchor_ids[anchor])

    out = {name: [np.zeros(0, np.int64)] for name in ("window", "id", "score")}
    going = np.arange(len(owner))
    for step in STEPS:
        if not len(going) or not len(x):
            break
        t = low[going] if step == 1 else np.maximum(low[going], high[going] - np.ceil(step * (high[going] - low[going])).astype(np.int64))
        asked, place = np.unique(owner[going], return_inverse=True)
        thresholds = np.full(len(asked), np.iinfo(np.int64).max)
        np.minimum.at(thresholds, place, t)
        row, anchor, score = matches(x, q[asked], thresholds, lambda r, a: allowed(r, asked[a]))
        order = np.lexsort((ids[row], -score, anchor))
        row, anchor, score = row[order], anchor[order], score[order]
        begin = np.searchsorted(anchor, np.arange(len(asked) + 1))
        still = []
        for w, p, least in zip(going, place, t):
            a, b = begin[p], begin[p + 1]
            start = a + int(np.searchsorted(-score[a:b], -high[w], "left"))
            end = a + int(np.searchsorted(-score[a:b], -least, "right"))
            if end - start < want and least > low[w]:
                still.append(w)
                continue
            end = min(end, start + want)
            out["window"].append(np.full(max(0, end - start), w))
            out["id"].append(ids[row[start:end]])
            out["score"].append(score[start:end])
        going = np.array(still, np.int64)
    w, found, scores = (np.concatenate(out[name]) for name in ("window", "id", "score"))
    return pa.table({"anchor": pa.array(keys[owner[w]], pa.int64()), "slot": pa.array(slot[w], pa.int32()),
                     "id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.int64())})


def _numbers(n: int) -> Column:
    """A row for each of 0 to n - 1."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))


def _round(rows: DataFrame, anchors: DataFrame, asked: DataFrame, dims: int, same: bool, want: int,
           n_rows: int, n_anchors: int, rows_per_cell: int, anchors_per_cell: int) -> DataFrame:
    """(anchor, slot, rank, id, score): the best rows of each asked window at its threshold."""
    row_blocks, anchor_blocks = -(-n_rows // rows_per_cell), max(1, -(-n_anchors // anchors_per_cell))
    block = F.pmod(F.xxhash64("row"), F.lit(row_blocks))
    left = rows.select("id", "label", "x", block.alias("r"), _numbers(anchor_blocks).alias("a"))
    windows = asked.groupBy("anchor").agg(F.collect_list(F.struct("slot", F.col("t").alias("low"), F.col("high"))).alias("windows"))
    block = F.pmod(F.xxhash64("anchor"), F.lit(anchor_blocks))
    right = (anchors.join(windows, "anchor")
             .select("anchor", "id", "label", "x", "windows", block.alias("a"),
                     _numbers(row_blocks).alias("r")))
    pairs = (left.groupBy("r", "a").cogroup(right.groupBy("r", "a"))
             .applyInArrow(lambda x, y: _cell(x, y, dims, same, want), "anchor long, slot int, id long, score long"))
    best = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= want)


def _fill(rows: DataFrame, anchors: DataFrame, windows: DataFrame, rounds: tuple[float, ...], want: int, **cells) -> DataFrame:
    """(anchor, slot, rank, id, score) for ``windows`` (anchor, slot, low, high): rounds go deeper
    until a window has what it wants or its lower end is reached."""
    open_windows, done = stage(windows, "windows"), []
    for depth in rounds:
        if done and open_windows.isEmpty():
            break
        span = (F.col("high") - F.col("low")).cast("double") * F.lit(depth)
        t = F.col("low") if depth == 1 else F.greatest(F.col("low"), F.col("high") - F.ceil(span))
        asked = open_windows.select("anchor", "slot", "low", "high", t.alias("t"))
        found = stage(_round(rows, anchors, asked, want=want, **cells), "window-rows")
        counts = found.groupBy("anchor", "slot").agg(F.max("rank").alias("n"))
        state = stage(asked.join(counts, ["anchor", "slot"], "left").withColumn(
            "full", (F.coalesce("n", F.lit(0)) >= want) | (F.col("t") <= F.col("low"))), "window-state")
        done.append(found.join(state.where("full").select("anchor", "slot"), ["anchor", "slot"], "left_semi"))
        open_windows = state.where(~F.col("full")).select("anchor", "slot", "low", "high")
    out = done[0] if done else rows.sparkSession.createDataFrame([], "anchor long, slot int, rank int, id long, score long")
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def mine(rows: DataFrame, anchors: Column, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
         scale: int = 256, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         rows_per_cell: int = ROWS, anchors_per_cell: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchors``: a condition on the column ``_id``. An anchor's positives are the
    ``positives`` best rows of its label; the negatives of a positive are the best
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` hundredths
    of the positive's."""
    spark = rows.sparkSession
    kept = (rows.select(F.col(id_col).cast("long").alias("_id"), F.col(label_col).cast("long").alias("_label"), F.col(vector_col).alias("_v"))
            .where(F.col("_id").isNotNull() & F.col("_label").isNotNull() & finite(F.col("_v")))
            .select("_id", "_label", whole(F.col("_v"), scale).alias("x"), anchors.alias("is_anchor")))
    kept = stage(kept.distinct().select(F.col("_id").alias("id"), F.col("_label").alias("label"), "x", "is_anchor",
                                        F.monotonically_increasing_id().alias("row")), "vectors")
    squares = F.aggregate(F.transform("x", lambda c: c.cast("double") * c.cast("double")), F.lit(0.0), lambda a, b: a + b)
    n_rows, longest = kept.agg(F.count(F.lit(1)), F.coalesce(F.max(squares), F.lit(0.0))).first()
    if longest * 100 >= 2.0 ** 63:
        raise ValueError("scores don't fit a long")
    chosen = stage(kept.where("is_anchor").select(F.col("row").alias("anchor"), "id", "label", "x"), "anchors")
    cells = {"dims": dimensions(kept, "x"), "n_rows": max(1, n_rows), "n_anchors": chosen.count(), "rows_per_cell": rows_per_cell, "anchors_per_cell": anchors_per_cell}
    # no score lies further from zero than the product of the norms
    reach = F.ceil(F.sqrt(squares) * F.lit(math.sqrt(longest))) + F.lit(1)
    windows = chosen.select("anchor", F.lit(0).alias("slot"), (-reach).alias("low"), reach.alias("high"))
    liked = stage(_fill(kept, chosen, windows, POSITIVE_ROUNDS, positives, same=True, **cells)
                  .select("anchor", F.col("rank").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # whole numbers between the two ends; below zero the ends cross
    windows = (liked.where("positive_score >= 0")
               .select("anchor", "slot", F.expr(f"({low} * positive_score + 99) div 100").alias("low"),
                       F.expr(f"{high} * positive_score div 100").alias("high")).where("low <= high"))
    found = _fill(kept, chosen, windows, NEGATIVE_ROUNDS, negatives, same=False, **cells)
    return (found.withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
            .join(liked, ["anchor", "slot"]).join(chosen.select("anchor", F.col("id").alias("anchor_id")), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
