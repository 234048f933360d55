import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from mixtape.llm import neardup, queries
from mixtape.llm.components import components
from mixtape.llm.textscan import texts_of

import pyarrow as pa
from tests.llm import brute


def check(df, rows, k, percent):
    expected = brute.near_duplicates([(d, t) for d, t in rows if d is not None], k, percent)
    got = neardup.groups(df, k, percent).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.component_id, r.kept) == expected[r.doc_id], r
    return got


def test_query_on_the_smallest_data(spark, sf_smoke, documents):
    expected = brute.near_duplicates(documents, 3, 85)
    got = queries.QUERIES["op10_near_duplicates"](spark, sf_smoke).collect()
    texts = dict(documents)
    assert {r.doc_id: (r.component_id, r.kept) for r in got} == expected
    assert all(r.n_shingles == len(brute.shingles(texts[r.doc_id], 3)) for r in got)


def test_query_against_sql(spark, sf_smoke, duck):
    got = queries.QUERIES["op10_near_duplicates"](spark, sf_smoke)
    result = duck.execute(queries.ORACLE["op10_near_duplicates"])
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(result.fetchall())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        i = rng.randrange(len(words))
        words[i:i + 1] = rng.choice([[f"w{rng.randrange(9999)}"], [], [words[i], f"v{rng.randrange(9999)}"]])
    return " ".join(words)


def test_chains_strays_and_odd_rows(spark, frame, monkeypatch):
    monkeypatch.setattr(neardup, "GROUP", 3)
    rng = random.Random(2)
    rows = [(None, "a b c d e f g h"), (None, "a b c d e f g h"), (900, None), (901, ""), (902, " \n"), (903, "one"),
            (904, "ONE"), (905, "one two"), (906, "two one"), (907, "x " * 50), (908, "X " * 70)]
    for g in range(6):
        base = [f"t{g}_{rng.randrange(400)}" for _ in range(rng.choice([8, 40, 150]))]
        rows += [(100 * g + i, edited(rng, base, rng.randrange(1 + len(base) // 6))) for i in range(25)]
    rng.shuffle(rows)
    check(frame(rows), rows, 3, 85)
    check(frame(rows), rows, 5, 80)


def test_one_id_with_several_texts(frame):
    rows = [(5, "a b c d e f"), (5, "p q r s t u"), (1, "a b c d e f"), (2, "p q r s t u"), (5, "a b c d e f"), (9, "z")]
    check(frame(rows), rows, 3, 85)


def test_empty_table(frame):
    assert neardup.groups(frame([])).count() == 0
    assert neardup.drop_duplicates(frame([])).count() == 0


def test_drop_keeps_columns_and_rows(frame):
    rows = [(3, "a b c d e f g"), (1, "a b c d e f g"), (4, None), (None, "q"), (8, "k l m n o p")]
    out = neardup.drop_duplicates(frame(rows))
    assert sorted((r.doc_id for r in out.collect()), key=str) == [1, 4, 8, None]
    assert out.columns == frame(rows).columns


@pytest.mark.parametrize("share", [0.3, 0.6, 0.85])
def test_estimate_is_near_the_truth(share):
    rng = np.random.default_rng(0)
    errors = []
    for n in (60, 400, 3000):
        both = int(n * share)
        values = rng.integers(0, 1 << 62, 2 * n - both).astype(np.uint64)
        a, b = np.unique(values[:n]), np.unique(values[n - both:])
        true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = (neardup.sketches(s, np.array([0, len(s)])) for s in (a, b))
        guess, used = neardup.estimate(x, y, np.array([len(a)]), np.array([len(b)]))
        errors.append(abs(guess[0] - true) * np.sqrt(used[0]))
        if share == 0.85:
            keys = [set(neardup.bands(s)[1].tolist()) for s in (x, y)]
            assert keys[0] & keys[1]
    assert max(errors) < 4 * 0.5


def test_sketch_ignores_repeats_and_order():
    texts = texts_of(pa.array(["a b c d a b c d", "a b c d a b c", "A b c D a b c d a b c d"]))
    sets, offsets = neardup.shingle_sets(texts, 3)
    rows = [sets[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 4


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(300, 301), (301, 300), (7, 7)]
    edges += [(rng.randrange(500, 600), rng.randrange(500, 600)) for _ in range(60)]
    parent = {x: x for e in edges for x in e if e[0] != e[1]}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r.node: r.component for r in got.collect()} == {x: root(x) for x in parent}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_links_are_counted_between_classes(frame):
    rows = [(1, "a b c d e f g h i j"), (2, "a b c d e f g h i j"), (3, "a b c d e f g h i k"), (4, "z y x w")]
    got = {r.doc_id: (r.class_id, r.n_links) for r in neardup.groups(frame(rows), 1, 80).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (3, 1), 4: (4, 0)}
    assert neardup.groups(frame(rows), 1, 80).where(F.col("kept")).count() == 2


def test_pairs_at_the_threshold_rarely_miss_all_bands():
    from mixtape.llm import neardup
    assert neardup.band_of(85) == neardup.BAND
    for percent in (80, 85, 90):
        band = neardup.band_of(percent)
        assert (1 - (percent / 100) ** band) ** (neardup.REGISTERS // band) <= 1e-6
