import random

import numpy as np
import pytest

from mixtape.llm import decontamination as dc
from mixtape.llm import queries
from tests.llm import brute


@pytest.fixture(scope="module")
def items(duck):
    return duck.execute("select item_id, text from benchmark").fetchall()


def test_query_finds_what_brute_force_finds(spark, sf_smoke, documents, items):
    got = {(r.doc_id, r.item_id): r.edits for r in queries.QUERIES["op1_decontamination"](spark, sf_smoke).collect()}
    words = [(i, brute.plain_words(t)) for i, t in items]
    for doc, text in documents:
        mine = brute.plain_words(text)
        known = set(mine)
        for item, its in words:
            # an item with few of its words in the text is further away than allowed
            if sum(w in known for w in its) < (1 - dc.MAX_EDITS) * len(its):
                assert (doc, item) not in got
                continue
            n = brute.edits(its, mine)
            assert got.get((doc, item)) == (n if n <= int(dc.MAX_EDITS * len(its)) else None)


def test_edited_copies_reach_the_target(spark, documents, items, frame):
    rng = random.Random(3)
    vocabulary = [w for _, t in documents for w in brute.plain_words(t)][:5000]
    rows, expected = [], {}
    for rate in (0, 0.1, 0.2):
        for item, text in items:
            words = brute.plain_words(text)
            for _ in range(int(rate * len(words))):
                i, kind = rng.randrange(len(words)), rng.randrange(3)
                words[i:i + (kind != 1)] = [rng.choice(vocabulary)] if kind < 2 else []
            doc = len(rows)
            rows.append((doc, " ".join(rng.choices(vocabulary, k=rng.randrange(200)) + words
                                       + rng.choices(vocabulary, k=30))))
            expected[doc] = item
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.find(frame(rows), table).collect()}
    assert len(got & set(expected.items())) >= dc.TARGET * len(expected)
    assert got <= set(expected.items())


def test_edited_copies_of_the_shortest_items_reach_the_target(spark, frame):
    rng = random.Random(4)
    items, rows = [], []
    for i in range(600):
        n = rng.choice([8, 10])
        words = [f"w{rng.randrange(10**9)}" for _ in range(n)]
        items.append((i, " ".join(words)))
        for at in rng.sample(range(n), int(dc.MAX_EDITS * n)):
            words[at] = f"w{rng.randrange(10**9)}"
        rows.append((i, " ".join(f"f{rng.randrange(10**9)}" for _ in range(rng.randrange(20))) + " " + " ".join(words)
                     + " " + " ".join(f"f{rng.randrange(10**9)}" for _ in range(20))))
    got = {(r.doc_id, r.item_id) for r in dc.find(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert all(a == b for a, b in got)
    # the target, less what 600 copies may be off
    assert len(got) >= 0.98 * len(rows)


def test_odd_rows(spark, frame):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    table = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "too short here"), (None, item),
                                   (5, item.upper() + " é")], "item_id long, text string")
    rows = [(1, None), (2, ""), (None, item), (4, "x " * 60_000 + item + " y" * 10), (5, item.replace(" ", " ,\n")),
            (5, item), (6, "too short here"), (7, item[:20])]
    got = sorted((r.doc_id, r.item_id, r.edits, r.start_word, r.end_word) for r in dc.find(frame(rows), table).collect())
    assert got == [(4, 1, 0, 60_000, 60_010), (4, 5, 1, 60_000, 60_010), (5, 1, 0, 0, 10), (5, 5, 1, 0, 10), (6, 4, 0, 0, 3)]
    rows += [(None, "nothing of the kind"), (None, None), (None, "")]
    kept = dc.clean(frame(rows), table)
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(
        [(i, t) for i, t in rows if i in (1, 2, 7) or i is None and t != item], key=str)
    few = dc.clean(frame(rows), table, min_words=4)
    assert sorted((r.doc_id for r in few.collect() if r.doc_id is not None)) == [1, 2, 6, 7]
    assert kept.columns == frame(rows).columns
    nothing = table.where("false")
    assert dc.find(frame(rows), nothing).count() == 0 and dc.find(frame([]), table).count() == 0


def test_several_places_and_the_best(spark, frame):
    words = [f"w{i}" for i in range(12)]
    worse = words[:5] + ["other"] + words[6:]
    table = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    text = " ".join(worse + ["gap"] * 9 + words + ["gap"] * 9 + words)
    got = dc.find(frame([(1, text)]), table).collect()
    assert [(r.edits, r.start_word, r.end_word) for r in got] == [(0, 21, 33)]


def test_edit_span_against_plain_rows():
    rng = np.random.default_rng(5)
    for _ in range(100):
        item, text = rng.integers(0, 4, 6), rng.integers(0, 4, int(rng.integers(0, 15)))
        n, a, b = dc.edit_span(item, text)
        assert n == brute.edits(item.tolist(), text.tolist())
        assert 0 <= a <= b <= len(text)


def test_walk_of_an_edited_copy_falls_back_into_step():
    rng = np.random.default_rng(1)
    same = 0
    for _ in range(200):
        words = rng.integers(1, 1 << 60, 40).astype(np.uint64)
        copy = np.delete(words, 3)
        for rep in range(8):
            a, _ = dc.signatures(words, np.arange(30), np.full(30, 40), rep)
            b, _ = dc.signatures(copy, np.arange(30), np.full(30, 39), rep)
            same += len(np.intersect1d(a, b)) > 15
    assert same > 1500


@pytest.mark.parametrize("max_edits", [0.0, 0.2, 0.34])
def test_short_items_against_brute_force(spark, frame, max_edits):
    """Items of one to seven words, in texts of few different words: nothing is lost."""
    rng = random.Random(11)
    items = [(i, " ".join(rng.choice("abcd") for _ in range(1 + i % 7))) for i in range(70)]
    rows = [(i, " ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 9)))) for i in range(150)]
    rows += [(1000 + i, "g " + text + " h") for i, text in items[:14]]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in dc.find(frame(rows), table, max_edits=max_edits).collect()}
    want = {}
    for doc, text in rows:
        for item, its in items:
            n = brute.edits(its.split(), text.split())
            if text and n <= int(max_edits * len(its.split())):
                want[doc, item] = n
    assert got == want and len({len(dict(items)[i].split()) for _, i in want}) == 7
    some = {(r.doc_id, r.item_id) for r in dc.find(frame(rows), table, max_edits=max_edits, min_words=5).collect()}
    assert some == {(d, i) for d, i in want if len(dict(items)[i].split()) >= 5}


def test_copies_of_short_and_long_items_in_one_text(spark, frame):
    seven = "one two three four five six seven"
    long = " ".join(f"w{i}" for i in range(20))
    table = spark.createDataFrame([(1, seven), (2, long), (3, "alpha")], "item_id long, text string")
    rows = [(1, f"x y {seven} z {long} alpha"), (2, seven.replace("four", "4")), (3, seven.replace("four", "4").replace("two", "2")), (4, "Alpha!")]
    got = sorted((r.doc_id, r.item_id, r.edits) for r in dc.find(frame(rows), table).collect())
    assert got == [(1, 1, 0), (1, 2, 0), (1, 3, 0), (2, 1, 1), (4, 3, 0)]


def test_repetitions_reach_the_target_or_raise():
    assert dc.plan_repetitions(0.99, 0.3, words=10) > 24
    assert dc.plan_repetitions(0.999, 0.2, words=10) > 24
    with pytest.raises(ValueError, match="repetitions find"):
        dc.plan_repetitions(0.99, 0.4, words=10, most=24)


def test_too_many_edits(spark, frame):
    table = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    with pytest.raises(ValueError, match="one half"):
        dc.find(frame([(1, "a")]), table, max_edits=0.5)
