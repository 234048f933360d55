"""License scan by diagonal voting.

Rolling hashes of k words of every text are joined to the places of the same
k-grams in the templates. A match at word p of a text and word t of a template
votes for the diagonal p - t; a copy of the template puts all its votes on one
diagonal, and every word lost or gained shifts the rest to a neighbouring one.
Votes are summed per (text, template, diagonal), neighbouring diagonals merge,
and each merged span is verified word by word: the longest common subsequence
with the template must hold ``MIN_SHARE`` of the template's words.

How long a gram is follows from the template's length and that share: with as many
words changed, lost or gained as may be missing, some run of that many words
stands as it was (``gram``), so no such copy stays without a vote.

A phrase is a template of one gram (k is its length), so each of its places is
a diagonal of its own and isn't merged; verified means all its words are there.

The templates are a parameter of the operator and few; their grams go to every
task, which sends on only matching places with the words around them.

Defined results: a null or wordless text has 0 words and places, empty labels
and score 0; repeated rows get equal results (each its own); an empty table
gives an empty result; a copy across two texts isn't one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from mixtape.llm.hits import lists, near
from mixtape.llm.templates import PASSAGES, PHRASES
from mixtape.llm.textscan import (ASCII_LOWER, WORD_BYTES, Texts, gram_starts, ngrams, range_hashes, scan, slices,
                                  texts_of)
from mixtape.session import stage

MIN_SHARE = 0.75


def word_hashes(texts: Texts):
    words = scan(texts, WORD_BYTES)
    return words, range_hashes(texts.data, words.starts, words.ends, ASCII_LOWER)


def missing(template_words: int, min_share: float) -> int:
    """Words of a template that a copy may lack; also how many it may lose or gain."""
    return int(template_words * (1 - min_share) + 1e-9)


def gram(template_words: int, min_share: float) -> int:
    """Words per gram: m edits leave m + 1 runs with all other words, and the longest has the mean
    at least."""
    m = missing(template_words, min_share)
    return -(-(template_words - m) // (m + 1))


class Templates:
    """The word hashes of each template and the places of its grams."""

    def __init__(self, phrases: list[tuple[str, str]], passages: list[tuple[str, str]], min_share: float = MIN_SHARE):
        self.min_share = min_share
        rows = [(text, label, True) for text, label in phrases] + [(t, label, False) for t, label in passages]
        words, hashes = word_hashes(texts_of(pa.array([r[0] for r in rows], pa.string())))
        self.words = [hashes[a:b] for a, b in zip(words.first[:-1], words.first[1:])]
        self.labels = [r[1] for r in rows]
        self.base = [r[2] for r in rows]
        # a phrase is one gram, whatever its length
        self.size = [len(w) if b else gram(len(w), min_share) for w, b in zip(self.words, self.base)]
        self.places = [(int(g), i, at, k) for i, (w, k) in enumerate(zip(self.words, self.size)) if k
                       for at, g in enumerate(ngrams(w, k))]
        self.sizes = sorted({k for k in self.size if k})
        self.grams = {k: np.unique(np.array([g for g, _, _, n in self.places if n == k], np.uint64))
                      for k in self.sizes}
        self.longest = max(map(len, self.words), default=0)

    def apart(self, template: int) -> int:
        """How far two diagonals of one copy may lie apart; a single gram has one diagonal."""
        n = len(self.words[template])
        return 0 if self.base[template] or n == 1 else max(2, missing(n, self.min_share))

    def matches(self, words, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number, gram hash, k) of all places where a template's gram stands."""
        at, found, size = [], [], []
        for k in self.sizes:
            start = gram_starts(words, k)
            grams = ngrams(hashes, k)[start]
            known = self.grams[k]
            low = np.zeros(1 << 16, bool)
            low[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
            maybe = np.flatnonzero(low[(grams & np.uint64(0xFFFF)).astype(np.int64)])
            hit = maybe[np.isin(grams[maybe], known)]
            at.append(start[hit])
            found.append(grams[hit])
            size.append(np.full(len(hit), k))
        at, found, size = (np.concatenate(x) for x in (at, found, size))
        order = np.argsort(at, kind="stable")
        return at[order], found[order], size[order]


def spans(docs: DataFrame, templates: Templates, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, places): one row (_row, id, n_words, ...) per text, and a row (_row,
    template, label, base, start_word, end_word, share) per verified place."""
    spark = docs.sparkSession
    reach = templates.longest + max(2, missing(templates.longest, templates.min_share))

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                words, hashes = word_hashes(texts)
                at, found, size = templates.matches(words, hashes)
                around = near(words, at, reach, reach)
                n, first = len(texts), words.first
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(np.diff(first)),
                     lists(at - first[words.text[at]], words.text[at], n), lists(found, words.text[at], n),
                     lists(size, words.text[at], n),
                     lists(around - first[words.text[around]], words.text[around], n),
                     lists(hashes[around], words.text[around], n)],
                    names=["_id", "n_words", "_at", "_grams", "_sizes", "_near", "_hashes"])

    rows = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    scanned = rows.mapInArrow(run, f"_id {kind}, n_words long, _at array<long>, _grams array<long>, "
                                   "_sizes array<long>, _near array<long>, _hashes array<long>")
    scanned = stage(scanned.withColumn("_row", F.monotonically_increasing_id()), "license-grams")
    signed = [(g - (1 << 64) if g >> 63 else g, i, at, k, templates.apart(i)) for g, i, at, k in templates.places]
    table = spark.createDataFrame(signed, "_gram long, template int, _t long, _k long, _apart long")
    grams = scanned.select("_row", F.explode(F.arrays_zip("_at", "_grams", "_sizes")).alias("g")).select(
        "_row", F.col("g._at").alias("_p"), F.col("g._grams").alias("_gram"), F.col("g._sizes").alias("_k"))
    # votes per diagonal; the template table is the size of the templates
    votes = (grams.join(F.broadcast(table), ["_gram", "_k"])
             .groupBy("_row", "template", "_apart", (F.col("_p") - F.col("_t")).alias("_diagonal"))
             .agg(F.count(F.lit(1)).alias("_votes"), F.min("_p").alias("_from"), F.max(F.col("_p") + F.col("_k")).alias("_to")))
    order = Window.partitionBy("_row", "template").orderBy("_diagonal")
    fresh = F.coalesce(F.col("_diagonal") - F.lag("_diagonal").over(order) > F.col("_apart"), F.lit(True)).cast("long")
    merged = (votes.withColumn("_new", fresh).withColumn("_span", F.sum("_new").over(order))
              .groupBy("_row", "template", "_span")
              .agg(F.sum("_votes").alias("votes"), F.min("_diagonal").alias("_low"), F.max("_diagonal").alias("_high")))
    found = (merged.join(scanned.select("_row", "_near", "_hashes"), "_row")
             .select("_row", "template", "votes", "_low", "_high", "_near", "_hashes")
             .mapInArrow(_verify(templates), "_row long, template int, label string, base boolean, "
                                                        "start_word long, end_word long, share double"))
    return scanned, found


def common(template: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(words in common in order, first and end place in ``text`` of the words used)."""
    # lengths and the matched places of one longest common subsequence
    table = np.zeros((len(template) + 1, len(text) + 1), np.int32)
    for i, word in enumerate(template):
        diagonal = table[i, :-1] + (text == word)
        table[i + 1, 1:] = np.maximum.accumulate(np.maximum(diagonal, table[i, 1:]))
    i, j, used = len(template), len(text), []
    while i and j:
        if table[i, j] == table[i - 1, j]:
            i -= 1
        elif table[i, j] == table[i, j - 1]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            used.append(j)
    return len(used), used[-1] if used else 0, used[0] + 1 if used else 0


def _verify(templates: Templates):
    names = ["_row", "template", "label", "base", "start_word", "end_word", "share"]
    kinds = [pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.float64()]

    def run(batches):
        for batch in batches:
            out = []
            columns = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for i, (row, template, low, high) in enumerate(zip(*columns)):
                words = templates.words[template]
                extra = templates.apart(template)
                places, hashes = (batch.column(c)[i].values.to_numpy().view(np.uint64) for c in (5, 6))
                places = places.astype(np.int64)
                a, b = np.searchsorted(places, [low - extra, high + len(words) + extra])
                same, start, end = common(words, hashes[a:b])
                share = same / len(words)
                if share >= (1 if templates.base[template] else templates.min_share):
                    out.append((row, template, templates.labels[template], templates.base[template],
                                int(places[a + start]), int(places[a + end - 1]) + 1, share))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], names=names)
    return run


def label(docs: DataFrame, phrases: list[tuple[str, str]] | None = None,
          passages: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text",
          min_share: float = MIN_SHARE) -> DataFrame:
    """One row per document: words, places of phrases, labels of phrases and of all, and
    the largest verified share as score."""
    templates = Templates(PHRASES if phrases is None else phrases, PASSAGES if passages is None else passages, min_share)
    scanned, found = spans(docs, templates, id_col, text_col)
    base = F.col("base")
    facts = found.groupBy("_row").agg(
        F.count(F.when(base, 1)).alias("n_base"),
        F.min(F.when(base, F.col("start_word"))).alias("first_word"),
        F.max(F.when(base, F.col("start_word"))).alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(base, F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("labels"),
        F.max("share").alias("score"))
    return (scanned.select("_row", F.col("_id").alias(id_col), "n_words").join(facts, "_row", "left").select(
        id_col, "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score")))
