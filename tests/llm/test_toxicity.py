import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from mixtape.llm import queries, toxicity
from mixtape.llm.textscan import texts_of


def test_query_columns_and_fold(spark, sf_smoke, documents):
    got = {r.doc_id: r for r in queries.QUERIES["op8_toxicity"](spark, sf_smoke).collect()}
    assert sorted(got) == [d for d, _ in documents]
    for doc, r in got.items():
        assert r.held_out == (zlib.crc32(str(doc).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    rows = queries.QUERIES["op8_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic == 1]
    clean = [r.predicted for r in rows if r.toxic == 0]
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.02


def fit(texts, labels, **options):
    docs, found = toxicity.distinct(*toxicity.terms(texts_of(pa.array(texts))))
    counts = {}
    for d, t in zip(docs.tolist(), found.tolist()):
        n, hits = counts.get(t, (0, 0))
        counts[t] = n + 1, hits + labels[d]
    signed = [(int(np.uint64(t).view(np.int64)), n, h) for t, (n, h) in counts.items()]
    vocabulary = toxicity.vocabulary_of(signed, len(texts), sum(labels), min_gain=options.pop("min_gain", 10.83))
    known = [np.flatnonzero(np.isin(vocabulary, found[docs == i])) for i in range(len(texts))]
    return toxicity.fit(vocabulary, known, labels, **options)


def test_a_pair_of_terms_can_say_what_neither_says_alone():
    rng = random.Random(0)
    texts, labels = [], []
    for _ in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = ["insult"] * a + ["group"] * b + rng.choices(["red", "blue", "sun", "rain"], k=3)
        texts.append(" ".join(words))
        labels.append(int(a and b))
    scores = fit(texts, labels, epochs=60).score(texts_of(pa.array(["insult group", "insult red", "group red", "red sun"])))
    assert scores[0] > 0.8 and max(scores[1:]) < 0.3
    additive = fit(texts, labels, epochs=60, factors=0).score(texts_of(pa.array(["insult group", "insult red"])))
    assert scores[0] - scores[1] > additive[0] - additive[1]


def test_margin_is_the_sum_over_pairs():
    rng = np.random.default_rng(0)
    model = toxicity.Model(np.arange(6, dtype=np.uint64), 0.3, rng.normal(size=6), rng.normal(size=(6, 3)))
    docs, term = np.array([0, 0, 0, 2, 2]), np.array([1, 4, 5, 0, 1])
    expected = []
    for d in range(3):
        mine = term[docs == d]
        pairs = sum(model.factors[i] @ model.factors[j] for i in mine for j in mine if i < j)
        expected.append(0.3 + model.weights[mine].sum() + pairs)
    assert np.allclose(model.margin(docs, term, 3), expected)


def test_odd_rows(spark, frame):
    words = ["good day to you all", "you stupid fool", "nice rain today", "stupid stupid thing"]
    rows = [(i, words[i % 4]) for i in range(80)] + [(200, None), (201, ""), (None, "stupid"), (3, words[3]), (202, "x " * 90_000 + "stupid")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(200, None), (None, 1), (5, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.learn(frame(rows), labels)
    out = toxicity.score(frame(rows).withColumn("_score", F.lit(1)), model, score_col="score")
    assert out.columns == [c for c in frame(rows).columns if c != "score"] + ["_score", "score"]
    got = out.select("doc_id", "text", "score").collect()
    assert len(got) == len(rows)
    assert all((r.score > 0.5) == ("stupid" in (r.text or "")) for r in got)
    assert toxicity.score(frame([]), model).count() == 0
    blank = toxicity.learn(frame(rows), labels.where("false"))
    assert toxicity.score(frame(rows), blank).agg(F.max("toxicity")).first()[0] < 1e-9


def test_learning_is_bounded_and_repeatable(spark, frame):
    rows = [(i, f"word{i % 7} text{i % 5} " + ("vile " if i % 3 == 0 else "")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    a = toxicity.learn(frame(rows, extra=False), labels, max_train=120)
    b = toxicity.learn(frame(rows, extra=False).repartition(5), labels.repartition(2), max_train=120)
    assert a.vocabulary.tolist() == b.vocabulary.tolist() and np.allclose(a.weights, b.weights)
