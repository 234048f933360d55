"""Toxicity by a factorization machine over hashed terms.

    score = sigmoid(b + sum_i w_i + 1/2 sum_f ((sum_i v_if)^2 - sum_i v_if^2))

over the distinct terms i of a text. The factors v let a pair of terms say more
than either (an insult beside the mention of a group), which additive weights
can't. Terms are 64-bit hashes of lower-cased words and of their first letters
(so that inflected and compound forms share evidence). The model's terms are
those in ``MIN_TEXTS`` training texts or more whose presence and the label
depend on each other (likelihood ratio of ``MIN_GAIN`` or more): a term that
says nothing would only be learnt by heart. So the model's size is bounded by
the training sample, and as terms are known by their whole hash, no other word
shares their weights.

The model is fitted on at most ``MAX_TRAIN`` labelled rows, those with the
smallest hashes of their ids, on the driver; features, candidates and scores of
all rows are computed in tasks. Fitting is deterministic: rows and terms are in
a fixed order.

Defined results: a null or wordless text gets the score of no terms; rows
without a label aren't learnt from; a label table with several rows of one id
counts the largest label; without any labelled row the score is 0; repeated rows
get equal scores; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from mixtape.llm.textscan import ASCII_LOWER, WORD_BYTES, Texts, range_hashes, scan, slices
from mixtape.session import stage

#: Labelled rows that the model is fitted on, at most.
MAX_TRAIN = 20_000
MIN_TEXTS = 3
#: Twice the log likelihood ratio; chance exceeds it once in a thousand terms.
MIN_GAIN = 10.83
PREFIXES = (4, 5)
FACTORS = 4
THRESHOLD = 0.3


def terms(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text number, term) pairs: words and prefixes of longer words. With repeats."""
    words = scan(texts, WORD_BYTES)
    whole = range_hashes(texts.data, words.starts, words.ends, ASCII_LOWER)
    docs, found = [words.text], [whole]
    for n in PREFIXES:
        long = np.flatnonzero(words.ends - words.starts > n)
        head = range_hashes(texts.data, words.starts[long], words.starts[long] + n, ASCII_LOWER)
        docs.append(words.text[long])
        found.append(head + np.uint64(n))
    return np.concatenate(docs), np.concatenate(found)


def distinct(docs: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, value) pairs in order of both."""
    order = np.lexsort((values, docs))
    d, v = docs[order], values[order]
    first = np.ones(len(d), bool)
    first[1:] = (d[1:] != d[:-1]) | (v[1:] != v[:-1])
    return d[first], v[first]


@dataclass
class Model:
    vocabulary: np.ndarray
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def pairs(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, term number) pairs of known terms."""
        docs, found = terms(texts)
        if not len(found) or not len(self.vocabulary):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(self.vocabulary, found), len(self.vocabulary) - 1)
        known = self.vocabulary[at] == found
        return distinct(docs[known], at[known])

    def margin(self, docs: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        out = np.full(n, self.bias) + np.bincount(docs, self.weights[term], n)
        for f in range(self.factors.shape[1]):
            v = self.factors[term, f]
            out += 0.5 * (np.bincount(docs, v, n) ** 2 - np.bincount(docs, v * v, n))
        return out

    def score(self, texts: Texts) -> np.ndarray:
        docs, term = self.pairs(texts)
        return 1 / (1 + np.exp(-np.clip(self.margin(docs, term, len(texts)), -30, 30)))


def gains(texts_with: np.ndarray, toxic_with: np.ndarray, texts: int, toxic: int) -> np.ndarray:
    """Twice the log likelihood ratio of presence against label, per term."""
    table = [toxic_with, texts_with - toxic_with, toxic - toxic_with, texts - toxic - texts_with + toxic_with]
    rows = [texts_with, texts_with, texts - texts_with, texts - texts_with]
    columns = [toxic, texts - toxic, toxic, texts - toxic]
    out = np.zeros(len(texts_with))
    for seen, row, column in zip(table, rows, columns):
        expected = row * column / texts
        out += 2 * seen * np.log(np.where(seen > 0, seen, 1) / np.where(seen > 0, expected, 1))
    return out


def vocabulary_of(counts: list[tuple[int, int, int]], texts: int, toxic: int, min_texts: int = MIN_TEXTS,
                  min_gain: float = MIN_GAIN) -> np.ndarray:
    """The terms to learn from (term, texts with it, toxic texts with it) rows."""
    if not counts:
        return np.zeros(0, np.uint64)
    term, n, hits = (np.array(x, np.int64) for x in zip(*counts))
    keep = (n >= min_texts) & (gains(n.astype(float), hits.astype(float), texts, toxic) >= min_gain)
    return np.sort(term[keep].view(np.uint64))


def fit(vocabulary: np.ndarray, known: list[np.ndarray], labels: list[int], factors: int = FACTORS,
        epochs: int = 60, batch: int = 64, rate: float = 0.2, decay: float = 2e-5, seed: int = 11) -> Model:
    """Logistic loss, adaptive gradients, on texts given as term numbers of the vocabulary."""
    if not labels:
        return Model(vocabulary, -30.0, np.zeros(len(vocabulary)), np.zeros((len(vocabulary), factors)))
    labels = np.array(labels, float)
    rng = np.random.default_rng(seed)
    base = (labels.sum() + 0.5) / (len(labels) + 1)
    model = Model(vocabulary, float(np.log(base / (1 - base))), np.zeros(len(vocabulary)),
                  rng.normal(0, 0.01, (len(vocabulary), factors)))
    sum_w, sum_v, sum_b = np.full(len(vocabulary), 1e-4), np.full((len(vocabulary), factors), 1e-2), 1e-4
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            sizes = np.array([len(known[i]) for i in part])
            docs, term = np.repeat(np.arange(len(part)), sizes), np.concatenate([known[i] for i in part])
            p = 1 / (1 + np.exp(-np.clip(model.margin(docs, term, len(part)), -30, 30)))
            error = (p - labels[part]) / len(part)
            sum_b += error.sum() ** 2
            model.bias -= rate * error.sum() / np.sqrt(sum_b)
            if not len(term):
                continue
            used, slot = np.unique(term, return_inverse=True)
            grad = np.bincount(slot, error[docs], len(used)) + decay * model.weights[used]
            sum_w[used] += grad ** 2
            model.weights[used] -= rate * grad / np.sqrt(sum_w[used])
            for f in range(factors):
                v = model.factors[term, f]
                whole = np.bincount(docs, v, len(part))
                grad = np.bincount(slot, error[docs] * (whole[docs] - v), len(used)) + decay * model.factors[used, f]
                sum_v[used, f] += grad ** 2
                model.factors[used, f] -= 0.1 * rate * grad / np.sqrt(sum_v[used, f])
    return model


def learn(docs: DataFrame, labels: DataFrame, learnable: Column | None = None, max_train: int = MAX_TRAIN,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", **options) -> Model:
    """A model of the labels; ``learnable`` is a condition on ``_id``. Terms are counted in
    tasks; the driver gets the counts of terms that pass ``MIN_TEXTS`` and the known
    terms of at most ``max_train`` texts."""
    marked = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label")).where(
        F.col("_label").isNotNull() & F.col("_id").isNotNull())
    if learnable is not None:
        marked = marked.where(learnable)
    chosen = (marked.groupBy("_id").agg(F.max("_label").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_train))

    def features(batches):
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                d, t = distinct(*terms(texts))
                cut = np.searchsorted(d, np.arange(len(texts) + 1))
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1),
                     pa.array([t[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["_id", "_label", "_terms"])

    texts = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    kind = texts.schema["_id"].dataType.simpleString()
    # the chosen ids are max_train rows at most; repeats of an id may still give more texts
    found = texts.join(F.broadcast(chosen), "_id").select("_id", "_label", "_text").mapInArrow(
        features, f"_id {kind}, _label int, _terms binary")
    first = found.orderBy(F.xxhash64("_id"), "_id", "_terms").limit(max_train)
    sample = stage(first, "toxicity-sample")

    def count(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                label, every = part.column(0).to_numpy(), part.column(1).to_pylist()
                seen, which, n = np.unique(np.frombuffer(b"".join(every), np.uint64), return_inverse=True,
                                           return_counts=True)
                hits = np.bincount(which, np.repeat(label, [len(t) // 8 for t in every]), len(seen))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen.view(np.int64)), pa.array(n), pa.array(hits.astype(np.int64))],
                    names=["term", "n", "hits"])

    size = sample.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_label"), F.lit(0)).alias("hits")).first()
    counts = (sample.select("_label", "_terms").mapInArrow(count, "term long, n long, hits long")
              .groupBy("term").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
              .where((F.col("n") >= MIN_TEXTS) & (F.col("hits") * size["n"] != F.col("n") * size["hits"])).toArrow())
    vocabulary = vocabulary_of(list(zip(*(counts.column(c).to_pylist() for c in ("term", "n", "hits")))),
                               size["n"], size["hits"])

    def known(batches):
        for batch in batches:
            rows = []
            for raw in batch.column(1).to_pylist():
                t = np.frombuffer(raw, np.uint64)
                at = np.searchsorted(vocabulary, t)
                at[at == len(vocabulary)] = 0
                rows.append(at[vocabulary[at] == t].astype(np.int32).tobytes() if len(vocabulary) else b"")
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary()), batch.column(2)],
                                             names=["_label", "_known", "_order"])

    rows = (sample.select("_label", "_terms", F.xxhash64("_id", "_terms").alias("_order"))
            .mapInArrow(known, "_label int, _known binary, _order long").toArrow().sort_by("_order"))
    return fit(vocabulary, [np.frombuffer(r, np.int32).astype(np.int64) for r in rows.column("_known").to_pylist()],
               rows.column("_label").to_pylist(), **options)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity") -> DataFrame:
    """``docs`` with the score of each whole text. The model's size is bounded by its sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rest = docs.drop(score_col)
    names = [f"_c{i}" for i in range(len(rest.columns))]
    out = rest.toDF(*names).withColumn("_text", F.coalesce(F.col(names[rest.columns.index(text_col)]), F.lit("")))

    def run(batches):
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(shared.value.score(texts))],
                                                 names=[*names, "_score"])

    kinds = [f"{n} {f.dataType.simpleString()}" for n, f in zip(names, rest.schema.fields)]
    return out.mapInArrow(run, ", ".join([*kinds, "_score double"])).toDF(*rest.columns, score_col)


def held_out(id_col: Column) -> Column:
    """The fold that isn't learnt from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
