import re

from mixtape.llm import quality, queries
from tests.llm import brute


def measures(text):
    text = text or ""
    words = brute.space_words(text)
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    covered = {p + j for places in seen.values() if len(places) > 1 for p in places for j in range(8)}
    lines = [x for x in text.split("\n") if brute.space_words(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_query_measures_and_base_rule(spark, sf_smoke, documents, duck):
    got = {r.doc_id: r for r in queries.QUERIES["op5_quality"](spark, sf_smoke).collect()}
    assert len(got) == len(documents)
    for doc, text in documents:
        m = measures(text)
        assert tuple(got[doc][n] for n in NAMES) == m
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        assert got[doc].base_failed == failed and not (failed and got[doc].kept)
    labels = duck.execute("select doc_id, quality from labels").fetchall()
    right = [got[d].kept == bool(q) for d, q in labels if not got[d].base_failed]
    assert sum(right) >= 0.95 * len(right)


def test_odd_rows(frame):
    line = "one two three four five six seven eight nine ten"
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, line + "\n" + line + "\n\n\n" + line), (5, "a " * 20_000),
            (None, "é x | <é>"), (7, " ".join(f"w{i}" for i in range(30_000)))]
    got = quality.judge(frame(rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        assert tuple(r[n] for n in NAMES) == measures(texts[r.doc_id])
    assert {r.doc_id for r in got if r.kept} == {7}
    assert quality.judge(frame([])).count() == 0


def test_estimated_accuracies_follow_the_votes():
    # rules 0 and 1 agree; rule 2 contradicts them half of the time
    patterns = [((1, 1, 0), 500), ((1, 1, 1), 100), ((1, 1, -1), 100), ((-1, -1, 0), 80), ((-1, -1, 1), 20), ((0, 0, -1), 5)]
    model = quality.fit(patterns)
    assert min(model.accuracy[:2]) > 0.95 and 0.3 < model.accuracy[2] < 0.7
    assert model == quality.fit(patterns[::-1])
    assert model.posterior((1, 1, -1)) > 0.9 and model.posterior((-1, -1, 1)) < 0.1
    assert quality.fit([]).accuracy == [] and quality.fit([((0, 0), 9)]).posterior((0, 0)) == 0.5


def test_the_column_is_the_model(spark, frame):
    rows = [(i, t) for i, t in enumerate(["word %d other text here " % i * 8 for i in range(30)] + ["###$$$ " * 40] * 4)]
    got = quality.judge(frame(rows, extra=False)).collect()
    votes = [f"vote_{r.name}" for r in quality.default_rules()]
    counts = {}
    for r in got:
        key = tuple(r[v] for v in votes)
        counts[key] = counts.get(key, 0) + 1
    model = quality.fit(list(counts.items()))
    assert all(abs(model.posterior([r[v] for v in votes]) - r.quality) < 1e-9 for r in got)
