"""Benchmark decontamination: edit-tolerant search of benchmark items in documents.

Texts are sequences of lower-cased words. The CGK random walk embeds a sequence
so that edit distance becomes Hamming distance: at step t it writes the word
under its pointer, and a random bit of (t, word) says whether the pointer moves
on. Two walks over an edited copy fall back into step after an edit, and then
write the same words again. Bit sampling keeps a few steps of the walk as a
signature; repetitions with other bits and samples raise the recall to the
target (``plan_repetitions`` measures the rate for the parameters, at the worst
of the items' lengths). As a walk
only depends on where it starts, one walk serves the windows of all item sizes.

Documents start a walk at every ``STRIDE``-th word and items at every word, so a
copy meets some start of its item wherever it lies. Item signatures fill a Bloom
filter of fixed size, which scans of documents use to send on only windows that
may match; a join on the signature then finds the items. Every (document, item,
place) is verified by the exact edit distance of the whole item to the best
stretch of the document there.

Walks of items with fewer than ``WALK_WORDS`` words end before they fall into step,
so these items are found by pieces: with e edits allowed, one of e + 1 pieces of the
item is left as it was, and the pieces' word grams, looked up at every word of a
document, take the place of the signatures. That loses nothing.

Defined results: a copy has ``max_edits`` per word of the item at most (under one
half); items of fewer than ``min_words`` words, which the caller may set, null or
empty texts match nothing; repeated items and documents are reported each under their
id; ``find`` has no name for null ids and leaves them out, ``clean`` judges documents
without an id by their text; of several places the one with fewest edits, then
the earliest, is reported; other columns don't matter. A target that the
repetitions can't reach raises an error.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mixtape.llm.hits import lists, near
from mixtape.llm.textscan import ASCII_LOWER, BASE, U64, WORD_BYTES, gram_starts, mix, ngrams, range_hashes, scan, slices
from mixtape.session import stage

#: Shorter items are found by pieces instead of walks.
WALK_WORDS = 8
MAX_EDITS = 0.2
STRIDE = 2
STEPS = 18
SAMPLES = 6
TARGET = 0.99
#: Words of an item beyond which fewer repetitions do than for this many.
LONG = 20
#: Bits of the filter (16 MB), and places per signature.
FILTER_BITS = 1 << 27
FILTER_PLACES = 4


def samples(rep: int) -> np.ndarray:
    """The sampled steps of a repetition, one from each of equal parts of its walk."""
    rng = np.random.default_rng([20240, rep])
    edges = np.linspace(0, int(rng.integers(2 * SAMPLES, STEPS + 1)), SAMPLES + 1).astype(int)
    return np.array([rng.integers(a, b) for a, b in zip(edges[:-1], edges[1:])])


def signatures(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, rep: int) -> tuple[np.ndarray, np.ndarray]:
    """(signature, complete) of the walks from ``starts``; a walk that leaves its text
    (at ``ends``) before the last sampled step is incomplete."""
    at = starts.copy()
    out = np.full(len(starts), U64(rep + 1))
    complete = np.ones(len(starts), bool)
    picked = samples(rep)
    last = len(words) - 1
    for t in range(int(picked[-1]) + 1):
        here = words[np.minimum(at, last)]
        if t in picked:
            complete &= at < ends
            out = (out ^ (out >> U64(31))) * BASE + here
        # bit t of the word under this repetition
        salt = mix(np.array([rep * STEPS + t + 1], np.uint64) * BASE)
        at += (((here ^ salt) * BASE) >> U64(63)).astype(np.int64)
    return mix(out), complete


@lru_cache
def plan_repetitions(target: float = TARGET, max_edits: float = MAX_EDITS, words: int = 14, most: int = 100) -> int:
    """Repetitions that reach the target recall, measured on random items of ``words``
    words with as many random edits as are allowed (each a change, a loss or a gain).
    Raises ValueError if ``most`` don't."""
    rng = np.random.default_rng(7)
    missed = []
    for _ in range(400):
        item = rng.integers(1, 1 << 60, words).astype(U64)
        copy = item.tolist()
        for _ in range(int(max_edits * words)):
            i, kind = int(rng.integers(len(copy))), rng.integers(3)
            new = int(rng.integers(1, 1 << 60))
            copy[i:i + (kind != 1)] = [new] if kind == 0 else [] if kind == 2 else [new]
        text = np.array(rng.integers(1, 1 << 60, int(rng.integers(1, 9))).tolist() + copy
                        + rng.integers(1, 1 << 60, 20).tolist()).astype(U64)
        a, b = np.arange(0, len(text), STRIDE), np.arange(len(item))
        first = most
        for rep in range(most):
            x, full_x = signatures(text, a, np.full(len(a), len(text)), rep)
            y, full_y = signatures(item, b, np.full(len(b), len(item)), rep)
            if np.isin(y[full_y], x[full_x]).any():
                first = rep
                break
        missed.append(first)
    missed = np.array(missed)
    enough = next((r for r in range(1, most + 1) if (missed < r).mean() >= target), None)
    if enough is None:
        raise ValueError(f"{most} repetitions find {(missed < most).mean():.3f} of the copies of {words} words with "
                         f"{int(max_edits * words)} edits, the target is {target}")
    return enough


def repetitions(lengths: list[int], target: float = TARGET, max_edits: float = MAX_EDITS) -> int:
    """Repetitions that reach the target for items of all these lengths: of each number of
    edits, the shortest item has the least left between them."""
    shortest = {}
    for n in sorted(lengths):
        if n >= WALK_WORDS:
            shortest.setdefault(int(max_edits * n), n)
    return max((plan_repetitions(target, max_edits, n) for n in shortest.values()), default=1)


def pieces(n: int, max_edits: float) -> list[tuple[int, int]]:
    """(start, words) of the pieces of an item of ``n`` words, one more than edits allowed."""
    count = int(max_edits * n) + 1
    cut = [n * i // count for i in range(count + 1)]
    return [(a, b - a) for a, b in zip(cut, cut[1:])]


def piece_grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Signatures of the runs of ``k`` words from each place on."""
    return mix(ngrams(hashes, k) ^ U64(0x5bd1e995 + k))


def item_lengths(items: DataFrame, text_col: str) -> list[int]:
    """The numbers of words of the items; those above ``LONG`` count as ``LONG``."""
    def run(batches):
        for batch in batches:
            for _, texts in slices(batch, "_text"):
                n = np.unique(np.minimum(np.diff(scan(texts, WORD_BYTES).first), LONG))
                yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int64))], names=["n"])

    rows = items.select(F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return [r["n"] for r in rows.mapInArrow(run, "n long").distinct().collect()]


def places(signature: np.ndarray) -> np.ndarray:
    """Bits of the filter for each signature."""
    return np.stack([place(signature, i) for i in range(FILTER_PLACES)]).astype(np.int64)


def place(signature: np.ndarray, i: int) -> np.ndarray:
    return mix(signature + U64((i * int(BASE)) % (1 << 64))) % U64(FILTER_BITS)


def item_signatures(items: DataFrame, reps: int, id_col: str, text_col: str, max_edits: float, min_words: int) -> DataFrame:
    """(item, n, words, sigs, offsets), a row per item that is long enough; stored."""
    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                words = scan(texts, WORD_BYTES)
                hashes = range_hashes(texts.data, words.starts, words.ends, ASCII_LOWER)
                start = np.arange(len(words))
                found = []
                size = np.diff(words.first)
                for n in np.unique(size[(size > 0) & (size < WALK_WORDS)]):
                    for at, k in pieces(int(n), max_edits):
                        text = np.flatnonzero(size == n)
                        found.append((text, piece_grams(hashes, k)[words.first[text] + at], np.full(len(text), at)))
                for rep in range(reps if len(words) else 0):
                    sig, whole = signatures(hashes, start, words.first[words.text + 1], rep)
                    whole &= size[words.text] >= WALK_WORDS
                    found.append((words.text[whole], sig[whole], (start - words.first[words.text])[whole]))
                text, sig, offset = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3
                order = np.argsort(text, kind="stable")
                n = len(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(words.first)), lists(hashes, words.text, n),
                     lists(sig[order], text[order], n), lists(offset[order], text[order], n)],
                    names=["_item", "_n", "_words", "_sigs", "_offsets"])

    rows = items.select(F.col(id_col).cast("long").alias("_item"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.where(F.col("_item").isNotNull())
    out = rows.mapInArrow(run, "_item long, _n long, _words array<long>, _sigs array<long>, _offsets array<long>")
    return stage(out.where(F.col("_n") >= max(1, min_words)), "benchmark-items")


def filter_of(items: DataFrame) -> np.ndarray:
    """The filter as 64-bit words. Its bits are gathered as at most FILTER_BITS / 64 rows."""
    def run(batches):
        for batch in batches:
            sig = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            bit = places(sig).reshape(-1)
            word, slot = np.unique(bit >> 6, return_inverse=True)
            value = np.zeros(len(word), np.uint64)
            np.bitwise_or.at(value, slot, U64(1) << (bit & 63).astype(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(value.view(np.int64))], names=["word", "bits"])

    bits = (items.select(F.explode("_sigs").alias("_sig")).mapInArrow(run, "word long, bits long")
            .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    table = np.zeros(FILTER_BITS // 64, np.uint64)
    table[bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, signature: np.ndarray) -> np.ndarray:
    """Numbers of the signatures that may be in the filter."""
    left = np.arange(len(signature))
    for i in range(FILTER_PLACES):
        bit = place(signature[left], i)
        left = left[(table[(bit >> U64(6)).astype(np.int64)] >> (bit & U64(63))) & U64(1) == 1]
    return left


def edit_span(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the stretch of ``text`` nearest to the whole item; of
    equals the one that ends first, then the one that starts first."""
    n = len(text)
    grid = np.arange(n + 1)
    cost, origin = np.zeros(n + 1, np.int64), grid.copy()
    for i, word in enumerate(item):
        # cost and origin as one number: fewer edits first, then the earlier start
        old = cost * (n + 1) + origin
        best = old + (n + 1)
        np.minimum(best[1:], old[:-1] + (text != word) * (n + 1), out=best[1:])
        best = np.minimum.accumulate(best - grid * (n + 1)) + grid * (n + 1)
        cost, origin = best // (n + 1), best % (n + 1)
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         item_id_col: str = "item_id", item_text_col: str = "text", max_edits: float = MAX_EDITS,
         target: float = TARGET, min_words: int = 1) -> DataFrame:
    """(document id, item id, edits, item_words, start_word, end_word), a row for each
    document and item of which it holds a copy. ``min_words``: items of fewer words, which
    ordinary text may hold by chance, are left out."""
    if not 0 <= max_edits < 0.5:
        raise ValueError("max_edits must be at least 0 and under one half")
    lengths = item_lengths(items, item_text_col)
    reps = repetitions(lengths, target, max_edits)
    grams = sorted({k for n in lengths if max(1, min_words) <= n < WALK_WORDS for _, k in pieces(n, max_edits)})
    known = item_signatures(items, reps, item_id_col, item_text_col, max_edits, min_words)
    longest = known.agg(F.max("_n")).first()[0] or 0
    reach = int(longest * (1 + max_edits)) + 1
    table = docs.sparkSession.sparkContext.broadcast(filter_of(known))

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                words = scan(texts, WORD_BYTES)
                if not len(words):
                    continue
                hashes = range_hashes(texts.data, words.starts, words.ends, ASCII_LOWER)
                start = np.flatnonzero((np.arange(len(words)) - words.first[words.text]) % STRIDE == 0)
                ends = words.first[words.text[start] + 1]
                at, sigs = [], []
                for rep in range(reps):
                    sig, whole = signatures(hashes, start, ends, rep)
                    hit = np.flatnonzero(whole)
                    hit = hit[passes(table.value, sig[hit])]
                    at.append(start[hit])
                    sigs.append(sig[hit])
                for k in grams:
                    place_, sig = gram_starts(words, k), piece_grams(hashes, k)
                    hit = passes(table.value, sig[place_])
                    at.append(place_[hit])
                    sigs.append(sig[place_[hit]])
                at, sigs = np.concatenate(at), np.concatenate(sigs)
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, sigs = at[order], sigs[order]
                around = near(words, at, reach, reach)
                n, first = len(texts), words.first
                some = np.unique(words.text[at])
                out = pa.RecordBatch.from_arrays(
                    [rows.column(0), lists(sigs, words.text[at], n), lists(at - first[words.text[at]], words.text[at], n),
                     lists(around - first[words.text[around]], words.text[around], n),
                     lists(hashes[around], words.text[around], n)], names=["_id", "_sigs", "_at", "_near", "_hashes"])
                yield out.take(pa.array(some))

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    rows = rows.where(F.col("_id").isNotNull())
    hit = stage(rows.mapInArrow(run, "_id long, _sigs array<long>, _at array<long>, _near array<long>, "
                                     "_hashes array<long>").withColumn("_row", F.monotonically_increasing_id()),
                "benchmark-hits")
    # each hit places the item's start in the document; windows of one copy agree up to its edits
    offsets = known.select("_item", "_n", F.explode(F.arrays_zip("_sigs", "_offsets")).alias("_s")).select(
        "_item", "_n", F.col("_s._sigs").alias("_sig"), F.col("_s._offsets").alias("_offset"))
    at = hit.select("_row", F.explode(F.arrays_zip("_sigs", "_at")).alias("_s")).select(
        "_row", F.col("_s._sigs").alias("_sig"), F.col("_s._at").alias("_at"))
    spans = (at.join(offsets, "_sig").select("_row", "_item", "_n", (F.col("_at") - F.col("_offset")).alias("_start"))
             .distinct())
    # starts closer than the allowed edits belong to one stretch
    order = Window.partitionBy("_row", "_item").orderBy("_start")
    slack = F.ceil(F.col("_n") * max_edits).cast("long")
    fresh = F.coalesce(F.col("_start") - F.lag("_start").over(order) > slack, F.lit(True)).cast("long")
    groups = spans.withColumn("_new", fresh).withColumn("_group", F.sum("_new").over(order))
    stretches = groups.groupBy("_row", "_item", "_group").agg(F.min("_start").alias("_from"), F.max("_start").alias("_to"))
    verified = (stretches.join(known.select("_item", "_n", "_words"), "_item")
                .join(hit.select("_row", "_id", "_near", "_hashes"), "_row")
                .select("_id", "_item", "_n", "_words", "_from", "_to", "_near", "_hashes")
                .mapInArrow(_verify(max_edits), "_id long, _item long, edits long, item_words long, "
                                                "start_word long, end_word long"))
    best = (verified.groupBy("_id", "_item")
            .agg(F.min(F.struct("edits", "start_word", "end_word", "item_words")).alias("b")))
    return best.select(F.col("_id").alias(id_col), F.col("_item").alias(item_id_col), "b.edits", "b.item_words",
                       "b.start_word", "b.end_word")


def _verify(max_edits: float):
    def run(batches):
        names = ["_id", "_item", "edits", "item_words", "start_word", "end_word"]
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 2, 4, 5)]
            for i, (doc, item, n, low, high) in enumerate(zip(*columns)):
                words, places, hashes = (batch.column(c)[i].values.to_numpy() for c in (3, 6, 7))
                slack = int(max_edits * n)
                a, b = np.searchsorted(places, [low - slack - 1, high + n + slack + 1])
                edits, start, end = edit_span(words, hashes[a:b])
                if edits <= slack and end > start:
                    out.append((doc, item, edits, n, int(places[a + start]), int(places[a + end - 1]) + 1))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], names=names)
    return run


def clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that hold no copy of an item. Those without an id are judged by their text."""
    leaks = find(docs, items, id_col, text_col, **options).select(id_col).distinct()
    kept = docs.join(leaks, id_col, "left_anti").select(*docs.columns)
    unnamed = docs.where(F.col(id_col).isNull() & F.col(text_col).isNotNull())
    if unnamed.isEmpty():
        return kept
    texts = unnamed.select(F.xxhash64(text_col).alias("_text_key"), F.col(text_col).alias("_text_value"))
    leaks = find(texts, items, "_text_key", "_text_value", **options).select(F.col("_text_key").alias("_leak")).distinct()
    names = [f"_c{i}" for i in range(len(kept.columns))]
    where = dict(zip(kept.columns, names))
    safe = kept.toDF(*names)
    unsafe = F.col(where[id_col]).isNull() & (F.xxhash64(where[text_col]) == F.col("_leak"))
    return safe.join(leaks, unsafe, "left_anti").toDF(*kept.columns)
