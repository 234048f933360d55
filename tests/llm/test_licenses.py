import random

from mixtape.llm import licenses, queries
from mixtape.llm.templates import PASSAGES, PHRASES
from tests.llm import brute


def base(text):
    words = brute.plain_words(text)
    places, labels = [], set()
    for phrase, label in PHRASES:
        phrase = phrase.split()
        for i in range(len(words) - len(phrase) + 1):
            if words[i:i + len(phrase)] == phrase:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old, row = row, [0]
        for j, y in enumerate(b, 1):
            row.append(old[j - 1] + 1 if x == y else max(old[j], row[-1]))
    return row[-1]


def check(rows, got):
    texts = dict(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(r.labels)
    return {r.doc_id: r for r in got}


def test_query(spark, sf_smoke, documents):
    got = check(documents, queries.QUERIES["op4_licenses"](spark, sf_smoke).collect())
    assert len(got) == len(documents)
    # every label of the method has a passage that the text shares enough of
    for doc, text in documents:
        words = brute.plain_words(text)
        for label in set(filter(None, got[doc].labels.split(","))) - set(got[doc].base_labels.split(",")):
            assert any(longest_common(t, words) >= licenses.MIN_SHARE * len(t)
                       for t in (brute.plain_words(p) for p, name in PASSAGES if name == label))


def test_edited_notices_and_odd_rows(frame):
    rng = random.Random(1)
    filler = [f"w{i}" for i in range(300)]
    rows = [(1, "mit license MIT-License"), (2, None), (3, ""), (4, "cc by nc cc by nc by nc"), (5, "apache license version 2é"),
            (6, "w " * 70_000 + PASSAGES[1][0]), (7, "mit\x00license"), (8, PASSAGES[6][0][:30])]
    labels = {}
    for i, (text, label) in enumerate(PASSAGES):
        words = brute.plain_words(text)
        for _ in range(len(words) // 10):
            at, kind = rng.randrange(len(words)), rng.randrange(3)
            words[at:at + (kind != 1)] = [rng.choice(filler)] if kind < 2 else []
        rows.append((100 + i, " ".join(rng.choices(filler, k=rng.randrange(50)) + words + rng.choices(filler, k=20))))
        labels[100 + i] = label
    got = check(rows, licenses.label(frame(rows)).collect())
    assert all(label in got[doc].labels.split(",") for doc, label in labels.items())
    assert got[6].labels == "mit" and got[8].labels == "" and got[2].labels == got[3].labels == ""
    assert licenses.label(frame([])).count() == 0


def test_repeated_rows_and_null_ids(frame):
    rows = [(None, "mit license"), (None, "mit license"), (3, "mit license"), (3, "none")]
    got = sorted(((r.doc_id, r.n_base) for r in licenses.label(frame(rows)).collect()), key=str)
    assert got == [(3, 0), (3, 1), (None, 1), (None, 1)]


def edited(rng, words, edits, kinds=(0, 1, 2)):
    """Words changed, gained or lost at different places."""
    places = sorted(rng.sample(range(len(words)), edits), reverse=True)
    out = list(words)
    for at in places:
        kind = rng.choice(kinds)
        out[at:at + (kind != 1)] = [f"odd{rng.randrange(10**6)}"] if kind < 2 else []
    return out


def test_every_copy_within_the_share_is_found(frame):
    """As many words changed, gained or lost as may be missing, anywhere: no notice is lost."""
    rng = random.Random(8)
    rows, labels = [], {}
    for i, (text, label) in enumerate(PASSAGES):
        words = brute.plain_words(text)
        m = licenses.missing(len(words), licenses.MIN_SHARE)
        for n in range(40):
            some = edited(rng, words, m, (0,) if n < 10 else (0, 1, 2))
            doc = len(rows)
            rows.append((doc, " ".join([f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(30))] + some
                                       + [f"f{rng.randrange(10**6)}" for _ in range(rng.randrange(30))])))
            labels[doc] = label
        # evenly spread: the shortest runs that so many changes can leave
        step = len(words) / (m + 1)
        spread = [w if (j + 1) not in {round(step * k) for k in range(1, m + 1)} else "odd" for j, w in enumerate(words)]
        rows.append((len(rows), " ".join(spread)))
        labels[len(rows) - 1] = label
    rows += [(len(rows), "licensed under cc by2 nc 4.0"), (len(rows) + 1, "This work is XX under the GNU XX Public License version XX")]
    labels |= {len(rows) - 2: "cc-by-nc", len(rows) - 1: "gpl-3"}
    got = check(rows, licenses.label(frame(rows)).collect())
    assert [doc for doc, label in labels.items() if label not in got[doc].labels.split(",")] == []


def test_grams_follow_from_length_and_share():
    assert [licenses.gram(n, 0.75) for n in (1, 2, 4, 5, 7, 12, 60)] == [1, 2, 2, 2, 3, 3, 3]
    assert licenses.gram(20, 1.0) == 20 and licenses.gram(20, 0.9) == 6


def test_query_counts_the_phrases_of_its_contract(spark, tmp_path):
    """Base places are those of the whole phrase; a license by its bare name keeps its label."""
    rows = [(1, "mit license"), (2, "Under THE-MIT license, under the mit license"), (3, "under the mit mit license"), (4, None),
            (5, "under the mit licenses cc by nc by nc cc.by.nc"), (6, "Apache License, Version 2.0 under the mit\nlicense")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op4_licenses"](spark, str(tmp_path)).collect()}
    assert {i: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for i, r in got.items()} == {
        1: (2, 0, None, None, ""), 2: (8, 2, 0, 4, "mit"), 3: (5, 0, None, None, ""), 4: (0, 0, None, None, ""),
        5: (12, 2, 4, 9, "cc-by-nc"), 6: (9, 2, 0, 5, "apache-2,mit")}
    assert [got[i].labels for i in range(1, 7)] == ["mit", "mit", "mit", "", "cc-by-nc", "apache-2,mit"]
