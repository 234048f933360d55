"""Near-duplicate documents by HyperMinHash.

A text's set are its distinct word shingles (64-bit hashes). The sketch has
``REGISTERS`` buckets; a shingle falls into one by some of its bits, and of the
rest the smallest value of the bucket counts. A register keeps of it the count of
leading zeros and the ten bits after the first one: 16 bits in place of 64.

1. Texts with equal sets are one class, known by its smallest id.
2. Sketches are cut into bands of registers; classes that agree in a band are a
   bucket. The band is so short (``band_of``) that two sets at the threshold miss
   each other in all bands once in a million times at most.
3. In each bucket every class is paired with the smallest one only, so a group
   of any size gives one pair per member.
4. Pairs far below the threshold by the collision-corrected estimate go (five
   standard errors), the others are verified on the full sets.
5. Components of the links are formed. Members that aren't in the component of
   their bucket's smallest class ("strays") are then compared with the other
   classes of their buckets that lie in other components, by estimate and full
   sets, and components formed again. A link between two classes of a bucket
   has either both ends in the smallest class's component, or a stray at one
   end; so none that joins components is lost, and only strays cost more than
   one pair.

Verification streams: the members of a class's pairs pass by its set, in salted
parts of at most about ``GROUP`` members, so that no group is one task's.

Defined results: a text without words (or null) has an empty set and is linked
with nothing; rows with equal ids are one document; a null id is linked with
nothing; with fewer words than a shingle the whole text is one shingle.
"""

from __future__ import annotations

from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixtape.llm.components import components
from mixtape.llm.textscan import (ASCII_LOWER, BASE, NOT_SPACE, U64, Texts, gather, gram_starts, mix, ngrams,
                                  range_hashes, scan, slices)
from mixtape.session import shuffle_partitions, stage

REGISTERS = 128
REGISTER_BITS = 7
MANTISSA = 10
BAND = 5
#: Share of pairs at the threshold that may miss each other in all bands.
MISS = 1e-6
GROUP = 500


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, offsets): the distinct shingles of each text, sorted."""
    words = scan(texts, NOT_SPACE)
    hashes = range_hashes(texts.data, words.starts, words.ends, ASCII_LOWER)
    start = gram_starts(words, k)
    grams = ngrams(hashes, k)[start]
    text = words.text[start]
    counts = np.diff(words.first)
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            at = words.first[short]
            grams = np.concatenate([grams, ngrams(hashes[gather(at, np.full(len(at), n))], n)[::n]])
            text = np.concatenate([text, short])
    order = np.argsort(text, kind="stable")
    grams, text = grams[order], text[order]
    cut = np.searchsorted(text, np.arange(len(texts) + 1))
    sets = [np.unique(grams[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
    offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)
    return np.concatenate(sets) if sets else np.zeros(0, U64), offsets


def sketches(shingles: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of registers per text: leading zeros + 1 in the upper six bits, then the
    mantissa; 0 is an empty bucket."""
    n = len(offsets) - 1
    least = np.full(n * REGISTERS, np.iinfo(np.uint64).max, U64)
    text = np.repeat(np.arange(n), np.diff(offsets))
    value = mix(shingles)
    np.minimum.at(least, text * REGISTERS + (value & U64(REGISTERS - 1)).astype(np.int64), value >> U64(REGISTER_BITS))
    full = least != np.iinfo(np.uint64).max
    width = 64 - REGISTER_BITS
    zeros = (width - np.frexp(least.astype(np.float64))[1]).clip(0, 61)
    mantissa = (least << (zeros + REGISTER_BITS + 1).astype(U64)) >> U64(64 - MANTISSA)
    register = ((zeros + 1) << MANTISSA) + mantissa.astype(np.int64)
    return np.where(full, register, 0).astype(np.uint16).reshape(n, REGISTERS)


def bands(registers: np.ndarray, band: int = BAND) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all bands that aren't empty. Empty registers count as a value: two
    sets agree in them as often as in others, or more."""
    n = registers.shape[1] // band
    parts = registers[:, :n * band].reshape(len(registers), n, band).astype(U64)
    key = np.broadcast_to(np.arange(1, n + 1, dtype=U64), parts.shape[:2]).copy()
    for i in range(band):
        key = (key ^ (key >> U64(31))) * BASE + parts[:, :, i]
    row, column = np.nonzero(parts.any(axis=2))
    return row, mix(key)[row, column]


def band_of(percent: int) -> int:
    """The longest band, ``BAND`` at most, with which pairs at the threshold miss each other in
    all bands in a share of ``MISS`` or less; 1 if none is short enough."""
    return next((b for b in range(BAND, 1, -1) if (1 - (percent / 100) ** b) ** (REGISTERS // b) <= MISS), 1)


def estimate(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(Jaccard estimate, buckets that it rests on) of sketch rows: the share of equal
    registers, less those that different sets of these sizes agree in by chance."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    small, large = np.minimum(size_a, size_b), np.maximum(np.maximum(size_a, size_b), 1)
    ratio = small / large
    # expected chance collisions of HyperMinHash for sets much larger than the sketch
    chance = 0.169919487159739 * 2.0 ** (REGISTER_BITS - MANTISSA) * 4 * ratio / (1 + ratio) ** 2
    return np.clip((same - chance) / np.maximum(used, 1), 0, 1), used


def passing(a, b, size_a, size_b, share: float) -> np.ndarray:
    """Whether the pairs may reach the share: sizes allow it, and so does the estimate
    with five standard errors (and the weight of one bucket) to spare."""
    guess, used = estimate(a, b, size_a, size_b)
    spare = 5 * sqrt(share * (1 - share)) / np.sqrt(np.maximum(used, 1)) + 1 / np.maximum(used, 1)
    fits = np.minimum(size_a, size_b) >= share * np.maximum(size_a, size_b) - 1e-9
    return fits & (guess >= share - spare)


SKETCH = "_id long, n_shingles long, _d1 long, _d2 long, _registers binary"


def sketch(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(_id, n_shingles, digest of the set, registers) per row; stored."""
    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                shingles, offsets = shingle_sets(texts, k)
                digests = []
                for salt in (1, 2):
                    sums = np.zeros(len(shingles) + 1, U64)
                    np.cumsum(mix(shingles + U64(salt)), out=sums[1:])
                    digests.append(pa.array((sums[offsets[1:]] - sums[offsets[:-1]]).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(offsets)), *digests,
                     pa.array([r.tobytes() for r in sketches(shingles, offsets)], pa.binary())],
                    names=["_id", "n_shingles", "_d1", "_d2", "_registers"])

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    return stage(rows.mapInArrow(run, SKETCH), "sketches")


def buckets(classes: DataFrame, band: int) -> DataFrame:
    """(key, id, leader) of the members of all buckets with two classes or more; stored."""
    def run(batches):
        for batch in batches:
            registers = _registers(batch.column(1))
            row, key = bands(registers, band)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), pa.array(key.view(np.int64))],
                                             names=["id", "key"])

    keys = classes.select("id", "_registers").mapInArrow(run, "id long, key long")
    groups = (keys.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("_last"))
              .where(F.col("leader") < F.col("_last")).drop("_last"))
    return stage(keys.join(groups, "key"), "buckets")


def _registers(column: pa.Array) -> np.ndarray:
    if not len(column):
        return np.zeros((0, REGISTERS), np.uint16)
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def estimated(pairs: DataFrame, classes: DataFrame, share: float) -> DataFrame:
    """The pairs (a, b) whose estimates don't rule them out."""
    def run(batches):
        for batch in batches:
            a, b = (_registers(batch.column(i)) for i in (2, 3))
            n, m = (batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5))
            keep = pa.array(np.flatnonzero(passing(a, b, n, m, share)))
            yield pa.RecordBatch.from_arrays([batch.column(i).take(keep) for i in (0, 1)], names=["a", "b"])

    left = classes.select(F.col("id").alias("a"), F.col("_registers").alias("_ra"), F.col("n_shingles").alias("_na"))
    right = classes.select(F.col("id").alias("b"), F.col("_registers").alias("_rb"), F.col("n_shingles").alias("_nb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "_ra", "_rb", "_na", "_nb")
            .mapInArrow(run, "a long, b long"))


def texts_in(bucket: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text) of the classes of buckets; stored, so that both verifications move only these."""
    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    wanted = bucket.select(F.col("id").alias("_id")).distinct()
    return stage(rows.join(wanted, "_id", "left_semi"), "bucket-texts")


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union on the full sets, and
    their overlap."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("_parts"))
    members = pairs.join(sizes, "a").select(
        F.col("b").alias("_id"), "a", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int").alias("_part"))
    heads = sizes.select(F.col("a").alias("_id"), "a", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    # a class id has one text; other texts of an equal id have other sets
    roles = (members.withColumn("_head", F.lit(False)).unionByName(heads.withColumn("_head", F.lit(True)))
             .groupBy("_id").agg(F.collect_list(F.struct("a", "_part", "_head")).alias("_roles")))
    met = texts.join(roles, "_id").select("_id", "_text", F.explode("_roles").alias("r")).select(
        "r.a", "r._part", "r._head", "_id", "_text")

    def run(batches):
        now, head = None, np.zeros(0, U64)
        for batch in batches:
            for rows, slice_texts in slices(batch, "_text"):
                shingles, offsets = shingle_sets(slice_texts, k)
                out = []
                for i, (a, part, is_head, b) in enumerate(zip(*(rows.column(c).to_pylist() for c in range(4)))):
                    own = shingles[offsets[i]:offsets[i + 1]]
                    if is_head:
                        # several texts under one id: their sets are one document's
                        head = np.union1d(head, own) if now == (a, part) else own
                        now = (a, part)
                        continue
                    both = len(np.intersect1d(head, own, assume_unique=True))
                    if 100 * both >= percent * (len(head) + len(own) - both):
                        out.append((a, b, both))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)],
                                                     names=["a", "b", "overlap"])

    n = shuffle_partitions(texts.sparkSession)
    dealt = met.repartition(n, "a", "_part").sortWithinPartitions("a", "_part", F.desc("_head"))
    # a text that is there more than once gives its link more than once
    return dealt.mapInArrow(run, "a long, b long, overlap long").groupBy("a", "b").agg(F.max("overlap").alias("overlap"))


def groups(docs: DataFrame, k: int = 5, percent: int = 80, band: int | None = None, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, n_shingles, class_id, n_links, component_id, kept) per row of ``docs``. ``n_links``
    counts the links of the row's class that were verified to join components."""
    sketched = sketch(docs, k, id_col, text_col)
    keyed = sketched.where((F.col("n_shingles") > 0) & F.col("_id").isNotNull())
    of_set = keyed.groupBy("_d1", "_d2", "n_shingles").agg(
        F.min("_id").alias("id"), F.first("_registers").alias("_registers"))
    of_set = stage(of_set, "classes")
    classes = of_set.select("id", "n_shingles", "_registers")
    bucket = buckets(classes, band or band_of(percent))
    star = bucket.where("id <> leader").select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct()
    share = percent / 100
    tried = stage(estimated(star, classes, share), "star-pairs")
    texts = texts_in(bucket, docs, id_col, text_col)
    links = stage(verified(tried, texts, k, percent), "star-links")
    # rows of one id with different sets are one document
    same = (keyed.select("_id", "_d1", "_d2", "n_shingles").distinct()
            .join(of_set.select("_d1", "_d2", "n_shingles", F.col("id").alias("_class")), ["_d1", "_d2", "n_shingles"]))
    several = (same.groupBy("_id").agg(F.min("_class").alias("a"), F.max("_class").alias("_last"))
               .where(F.col("a") < F.col("_last")))
    versions = stage(same.join(several, "_id").where("_class <> a").select("a", F.col("_class").alias("b")).distinct(),
                     "versions")
    first = components(links.select("a", "b").unionByName(versions))
    more = stage(_stray_links(bucket, first, texts, k, percent), "stray-links")
    all_links = links.unionByName(more)
    last = components(all_links.select("a", "b").unionByName(versions))
    degree = (all_links.select(F.col("a").alias("_class")).unionByName(all_links.select(F.col("b").alias("_class")))
              .groupBy("_class").agg(F.count(F.lit(1)).alias("n_links")))
    facts = (of_set.select("_d1", "_d2", "n_shingles", F.col("id").alias("_class"))
             .join(degree, "_class", "left")
             .join(last.withColumnRenamed("node", "_class"), "_class", "left"))
    whole = sketched.select("_id", "_d1", "_d2", "n_shingles").join(facts, ["_d1", "_d2", "n_shingles"], "left")
    linked = (F.col("n_shingles") > 0) & F.col("_id").isNotNull()
    of = F.when(linked, F.coalesce("component", "_class")).otherwise(F.col("_id"))
    return whole.select(
        F.col("_id").alias(id_col), "n_shingles", F.when(linked, F.col("_class")).otherwise(F.col("_id")).alias("class_id"),
        F.when(linked, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        of.alias("component_id"), F.col("_id").eqNullSafe(of).alias("kept"))


def _stray_links(bucket: DataFrame, found: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Verified pairs (a, b, overlap) of a stray and another class of its buckets in another
    component. Buckets with one smallest class are met as one. Their strays lie in parts
    of about ``GROUP``; the classes stream past each part and are estimated and verified
    there, so pairs that fail are never rows."""
    label = found.select(F.col("node").alias("id"), F.col("component").alias("_c"))
    of_leader = found.select(F.col("node").alias("leader"), F.col("component").alias("_l"))
    members = bucket.where("id <> leader").select("leader", "id").distinct()
    marked = (members.join(label, "id", "left").join(of_leader, "leader", "left")
              .withColumn("_c", F.coalesce("_c", "id")).withColumn("_l", F.coalesce("_l", "leader")))
    marked = stage(marked.select("leader", "id", "_c", (F.col("_c") != F.col("_l")).alias("_stray")), "marked-members")
    parts = marked.where("_stray").groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("_parts"))
    met = marked.join(parts, "leader")
    heads = met.where("_stray").select(
        F.col("id").alias("_id"), "leader", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int").alias("_part"),
        F.lit(True).alias("_head"), "_c")
    others = met.select(F.col("id").alias("_id"), "leader", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
                        .alias("_part"), F.lit(False).alias("_head"), "_c")
    rows = texts.join(heads.unionByName(others), "_id").select("leader", "_part", "_head", "_id", "_c", "_text")

    def run(batches):
        now, held = None, Held()
        for batch in batches:
            for part_rows, slice_texts in slices(batch, "_text"):
                shingles, offsets = shingle_sets(slice_texts, k)
                registers = sketches(shingles, offsets)
                out = []
                columns = zip(*(part_rows.column(c).to_pylist() for c in range(5)))
                for i, (leader, part, is_head, doc, component) in enumerate(columns):
                    own = shingles[offsets[i]:offsets[i + 1]]
                    if now != (leader, part):
                        now, held = (leader, part), Held()
                    if is_head:
                        held.add(doc, component, own, registers[i])
                    else:
                        out += held.links(doc, component, own, registers[i], percent)
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)],
                                                     names=["a", "b", "overlap"])

    n = shuffle_partitions(bucket.sparkSession)
    dealt = rows.repartition(n, "leader", "_part").sortWithinPartitions("leader", "_part", F.desc("_head"))
    return dealt.mapInArrow(run, "a long, b long, overlap long").groupBy("a", "b").agg(
        F.max("overlap").alias("overlap"))


class Held:
    """Sets and sketches of the strays of one part, to compare others with."""

    def __init__(self):
        self.rows: list[tuple] = []
        self.table = None

    def add(self, doc: int, component: int, own: np.ndarray, registers: np.ndarray) -> None:
        self.rows.append((doc, component, own, registers))
        self.table = None

    def links(self, doc: int, component: int, own: np.ndarray, registers: np.ndarray,
              percent: int) -> list[tuple[int, int, int]]:
        if not self.rows:
            return []
        if self.table is None:
            docs, components, sets, sketched = zip(*self.rows)
            size = np.array([len(s) for s in sets])
            self.table = (np.array(docs), np.array(components), np.concatenate(sets), np.cumsum(size) - size, size,
                          np.stack(sketched))
        docs, components, values, start, size, sketched = self.table
        near = np.flatnonzero(components != component)
        near = near[passing(sketched[near], registers[None, :], size[near], len(own), percent / 100)]
        if not len(near):
            return []
        mine = values[gather(start[near], size[near])]
        at = np.minimum(np.searchsorted(own, mine), len(own) - 1)
        both = np.add.reduceat((own[at] == mine).astype(np.int64), np.cumsum(size[near]) - size[near])
        linked = 100 * both >= percent * (size[near] + len(own) - both)
        return [(min(doc, d), max(doc, d), n) for d, n in zip(docs[near[linked]].tolist(), both[linked].tolist())]


def drop_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", **options) -> DataFrame:
    """One document of each component: the one with the smallest id."""
    keep = groups(docs, k, percent, id_col=id_col, **options).where("kept").select(
        F.col(id_col).alias("_kept")).distinct()
    return docs.join(keep, docs[id_col].eqNullSafe(keep["_kept"]), "left_semi")
