"""Packing of tokenised documents into sequences by bin completion.

A document longer than a sequence is cut into whole sequences, the remainder
first. What is packed are piece lengths from 1 to the sequence length, so the
counts per length are all that the search has to see: ``capacity`` numbers at
most, whatever the number of documents. Spark counts them over all rows, the
driver searches for a plan over the counts, and every piece finds its place
from its length and its number among pieces of that length.

The search takes the largest remaining piece and enumerates fillings of the room
beside it. A branch ends when the room wasted so far rules out fewer sequences
than the incumbent has. Best fit gives the first incumbent, and the lower bound
(all lengths over the capacity) ends the search. A first pass has a few
promising fillings per piece, each repeated as often as the counts allow; if
these run out above the lower bound, a second pass has all fillings, also
taken once. Only a second pass that comes to its end proves more sequences
than the lower bound to be needed; ``NODES`` bounds both.

Defined results: a null text is empty and has only the end id; repeated rows
are packed each; pieces of equal length are interchangeable; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from mixtape.llm.encoding import encoder
from mixtape.llm.planes import with_end
from mixtape.llm.textscan import joined, slices
from mixtape.session import scratch_path

#: Fillings that the search may try before it keeps the best plan so far.
NODES = 20_000
#: Of the first pass: exact pairs, largest pieces to look for a triple with, largest pieces to fill up beside.
PAIRS, TRIPLES, GREEDY = 4, 64, 4

Pattern = tuple[int, ...]


# --- the plan over counts -------------------------------------------------------

def best_fit(counts: np.ndarray) -> list[tuple[Pattern, int]]:
    """Patterns and times: the largest piece, then always the largest that fits."""
    counts, out = counts.copy(), []
    for largest in range(len(counts) - 1, 0, -1):
        while counts[largest]:
            pattern, room, left = [], len(counts) - 1, counts.copy()
            size = largest
            while size:
                pattern.append(size)
                left[size] -= 1
                room -= size
                fits = np.flatnonzero(left[1:room + 1])
                size = int(fits[-1]) + 1 if len(fits) else 0
            out.append((tuple(pattern), take(counts, tuple(pattern))))
    return out


def take(counts: np.ndarray, pattern: Pattern) -> int:
    """Takes the pattern out of the counts as often as it goes; returns how often."""
    sizes, each = np.unique(pattern, return_counts=True)
    times = int((counts[sizes] // each).min())
    counts[sizes] -= times * each
    return times


class Stock:
    """Pieces left per length. The lengths that are there are also the bits of one number,
    and of its mirror image, so that a look for a length or a pair is one operation."""

    def __init__(self, counts: np.ndarray):
        self.n, self.capacity = counts.tolist(), len(counts) - 1
        self.upto = [(2 << i) - 1 for i in range(self.capacity + 1)]
        self.there = sum(1 << i for i, n in enumerate(self.n) if n)
        self.mirror = sum(1 << self.capacity - i for i, n in enumerate(self.n) if n)

    def add(self, size: int, n: int) -> None:
        before = self.n[size]
        self.n[size] = before + n
        if not before or not before + n:
            self.there ^= 1 << size
            self.mirror ^= 1 << self.capacity - size

    def largest(self, room: int) -> int:
        """The largest length that fits, 0 if none."""
        return max((self.there & self.upto[room]).bit_length() - 1, 0)

    def times(self, pattern: Pattern) -> int:
        """How often the pattern can be taken."""
        return min(self.n[size] // pattern.count(size) for size in set(pattern))

    def pairs(self, room: int, most: int | None = None) -> Iterator[Pattern]:
        """(x, y), x >= y, x + y = room, both there; the largest x first."""
        both = self.there & self.mirror >> self.capacity - room & self.upto[room if most is None else min(room, most)]
        while (x := both.bit_length() - 1) * 2 >= room > 1:
            if x * 2 != room or self.n[x] > 1:
                yield x, room - x
            both ^= 1 << x

    def sizes(self, room: int, most: int) -> Iterator[int]:
        """The ``most`` largest lengths that fit, the largest first."""
        size = self.largest(room)
        while size and most:
            yield size
            size, most = self.largest(size - 1), most - 1

    def triple(self, room: int) -> Pattern | None:
        """Three pieces of exactly the room, the first of them among the ``TRIPLES`` largest."""
        for first in self.sizes(room, TRIPLES):
            self.add(first, -1)
            pair = next(self.pairs(room - first, first), None)
            self.add(first, 1)
            if pair:
                return first, *pair
        return None

    def fill(self, room: int) -> Pattern:
        """The first of ``fillings``: the largest that fits until the rest is filled by three at most."""
        taken = []
        while size := self.largest(room):
            found = (room,) if size == room else next(self.pairs(room), None) or self.triple(room)
            if found:
                break
            taken.append(size)
            self.add(size, -1)
            room -= size
        for size_back in taken:
            self.add(size_back, 1)
        return *taken, *(found if size else ())


def fillings(stock: Stock, room: int) -> Iterator[Pattern]:
    """Promising fillings of ``room``, those without waste first.

    One piece of exactly the room dominates all else. Then come the ``PAIRS`` exact
    pairs of the largest pieces, one exact triple, and each of the ``GREEDY`` largest
    pieces that fit with the first filling of the room beside it, if that wastes
    less than those before. Others, undominated ones too, are left to ``all_fillings``.
    """
    size = stock.largest(room)
    if not size or size == room:
        yield (size,) if size else ()
        return
    yield from islice(stock.pairs(room), PAIRS)
    if triple := stock.triple(room):
        yield triple
    best = None
    for first in stock.sizes(room, GREEDY):
        stock.add(first, -1)
        rest = stock.fill(room - first)
        stock.add(first, 1)
        waste = room - first - sum(rest)
        if best is None or waste < best:
            best = waste
            yield (first, *rest)


def all_fillings(stock: Stock, room: int) -> Iterator[Pattern]:
    """All fillings of ``room`` beside which no further piece fits, larger pieces first."""
    taken: list[int] = []
    size = room
    while True:
        while size := stock.largest(min(room, size)):
            taken.append(size)
            stock.add(size, -1)
            room -= size
        if not stock.largest(room):
            for one in taken:
                stock.add(one, 1)
            yield tuple(taken)
            for one in taken:
                stock.add(one, -1)
        if not taken:
            return
        size = taken.pop()
        stock.add(size, 1)
        room += size
        size -= 1


class Search:
    """Depth first over fillings; keeps the plan of fewest sequences seen."""

    def __init__(self, have: np.ndarray, nodes: int = NODES):
        self.have, self.capacity, self.left = have, len(have) - 1, nodes
        self.total = int((have * np.arange(len(have))).sum())
        self.bound = -(-self.total // self.capacity)
        self.incumbent = best_fit(have)
        self.bins = sum(n for _, n in self.incumbent)
        #: Whether no plan has fewer sequences.
        self.proven = self.bins == self.bound

    def run(self) -> list[tuple[Pattern, int]]:
        for whole in (False, True):
            if not self.proven and self.left > 0:
                ended = self._descend(whole)
                self.proven = self.bins == self.bound or (whole and ended)
        return self.incumbent

    def _options(self, stock: Stock, whole: bool) -> Iterator[tuple[Pattern, int]]:
        """Patterns with the largest piece, and how often to take each: as often as they go and,
        when the search is whole, once (the rest may be better off with others)."""
        largest = stock.largest(self.capacity)
        stock.add(largest, -1)
        for filling in (all_fillings if whole else fillings)(stock, self.capacity - largest):
            stock.add(largest, 1)
            pattern = (largest, *filling)
            times = stock.times(pattern)
            yield pattern, times
            if whole and times > 1:
                yield pattern, 1
            stock.add(largest, -1)
        stock.add(largest, 1)

    def _descend(self, whole: bool) -> bool:
        """Whether the enumeration came to its end within the budget."""
        stock, waste = Stock(self.have), [0]
        chosen: list[tuple[Pattern, int]] = []

        def put(pattern, n):
            for size in set(pattern):
                stock.add(size, n * pattern.count(size))

        stack = [self._options(stock, whole)]
        while stack and self.bins > self.bound and self.left > 0:
            option = next(stack[-1], None)
            if option is None:
                stack.pop()
                if chosen:
                    put(*chosen.pop())
                    waste.pop()
                continue
            self.left -= 1
            pattern, times = option
            lost = waste[-1] + times * (self.capacity - sum(pattern))
            if lost > (self.bins - 1) * self.capacity - self.total:
                continue
            put(pattern, -times)
            if stock.there:
                chosen.append(option)
                waste.append(lost)
                stack.append(self._options(stock, whole))
                continue
            put(pattern, times)
            bins = sum(n for _, n in chosen) + times
            if bins < self.bins:
                self.incumbent, self.bins = [*chosen, option], bins
        return not stack


def plan(counts: dict[int, int], capacity: int, nodes: int = NODES) -> list[tuple[Pattern, int]]:
    """Patterns and how often each is used; together they use up the counts."""
    have = np.zeros(capacity + 1, np.int64)
    for size, n in counts.items():
        have[size] += n
    return Search(have, nodes).run()


def slots(patterns: list[tuple[Pattern, int]]) -> np.ndarray:
    """Rows (length, first number, first sequence, pieces per sequence, offset) sorted by
    (length, number): piece r of a length lies in sequence s + (r - first) // per, as
    copy (r - first) % per from the offset on."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times in patterns:
        at = 0
        for size in sorted(set(pattern), reverse=True):
            per = pattern.count(size)
            first = used.get(size, 0)
            rows.append((size, first, sequence, per, at))
            used[size] = first + per * times
            at += per * size
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


# --- the documents ---------------------------------------------------------------

def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids, _part, _number) of every piece, stored. ``_number``
    counts the pieces of this length within the stored partition ``_part``."""
    def cut(batches):
        from pyspark import TaskContext
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                ids, offsets = with_end(*encoder(tokenizer).encode(texts), end_id)
                sizes = np.diff(offsets)
                each = -(-sizes // capacity)
                doc = np.repeat(np.arange(len(sizes)), each)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(each) - each, each)
                head = sizes - (each - 1) * capacity
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                number = _count_up(length, seen)
                yield pa.RecordBatch.from_arrays([
                    rows.column(0).take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start),
                    pa.array(length), joined(ids.astype("<u4"), 4 * np.append(offsets[doc] + start, len(ids))),
                    pa.array(np.full(len(doc), part, np.int32)), pa.array(number)],
                    names=[id_col, "piece", "start", "length", "ids", "_part", "_number"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    path = scratch_path(docs.sparkSession, "pieces")
    schema = f"{id_col} long, piece int, start long, length long, ids binary, _part int, _number long"
    rows.mapInArrow(cut, schema).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.parquet(path)


def _count_up(length: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each value among equal values, going on from ``seen``."""
    order = np.argsort(length, kind="stable")
    values, first, n = np.unique(length[order], return_index=True, return_counts=True)
    out = np.empty(len(length), np.int64)
    out[order] = np.arange(len(length)) - np.repeat(first, n) + np.repeat(seen[values], n)
    seen[values] += n
    return out


def place(stored: DataFrame, capacity: int = 2048, carry: list[Column] | None = None,
          id_col: str = "doc_id", nodes: int = NODES) -> DataFrame:
    """(id, piece, start, length, sequence_id, offset) of stored pieces and what
    ``carry`` selects from them (by default their ids)."""
    spark = stored.sparkSession
    per_part = stored.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("length", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    # a row per length: at most ``capacity``
    totals = {r["length"]: r["n"] for r in
              stored.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = spark.sparkContext.broadcast(slots(plan(totals, capacity, nodes)))
    kept = stored.select(id_col, "piece", "start", "length", "_part", "_number",
                         *(carry if carry is not None else [F.col("ids")]))
    numbered = kept.join(base, ["length", "_part"]).withColumn("_number", F.col("_base") + F.col("_number"))
    names = [c for c in kept.columns if c not in ("_part", "_number")]

    def put(batches):
        rows = table.value
        keys = rows[:, 0] << 40 | rows[:, 1]
        for batch in batches:
            length, number = (batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False)
                              for c in ("length", "_number"))
            at = rows[np.searchsorted(keys, length << 40 | number, "right") - 1]
            nth = number - at[:, 1]
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(c)) for c in names]
                + [pa.array(at[:, 2] + nth // at[:, 3]), pa.array(at[:, 4] + nth % at[:, 3] * length)],
                names=[*names, "sequence_id", "offset"])

    kinds = [f"`{c}` {kept.schema[c].dataType.simpleString()}" for c in names]
    return numbered.select(*names, "_number").mapInArrow(put, ", ".join([*kinds, "sequence_id long, offset long"]))


def sequences(placed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(sequence_id, n_tokens, ids, members) from placed pieces with ids. A sequence has
    ``capacity`` ids at most, so its pieces meet in one row of bounded size."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.col(id_col).alias("id"), "piece", "ids")))
    joined_ids = F.expr("aggregate(_parts, cast('' as binary), (a, p) -> concat(a, p.ids))")
    return (placed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("_parts"))
            .select("sequence_id", "n_tokens", joined_ids.alias("ids"),
                    F.transform("_parts", lambda p: F.struct(p["id"].alias(id_col), p["piece"], p["offset"]))
                    .alias("members")))


def pack(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = 2048, carry: list[Column] | None = None,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return place(pieces(docs, tokenizer, end_id, capacity, id_col, text_col), capacity, carry, id_col)
