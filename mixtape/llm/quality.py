"""Quality rules joined by weak supervision.

Each rule votes keep (1), drop (-1) or abstains (0). No rule is right always,
so instead of asking a document to pass all of them, expectation-maximisation
estimates from the votes alone how often each rule votes each way on good and
on bad documents, and the posterior probability of "good" decides.

The votes of m rules have 3^m patterns at most, so the counts per pattern are
a sufficient statistic of bounded size (2,187 rows for seven rules) whatever the
number of documents: they are counted over all rows in Spark, only the counts
reach the driver, and the fitted weights go back as literals of one column
expression. Only DataFrame functions run on the data.

Defined results: a null or blank text has no words, fails the base rule and
isn't kept; repeated rows get equal results; an empty table gives an empty
result. Repeats of word windows are found by 64-bit hashes within one text.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import exp, log

from pyspark.sql import Column, DataFrame, functions as F

from mixtape.session import stage

#: Fixed values of the base rule: white space, symbols, window length, limits.
SPACE = "[ \\t-\\r]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30


@dataclass(frozen=True)
class Rule:
    """Votes drop where ``drop`` holds, else keep where ``keep`` holds, else abstains."""
    name: str
    drop: Column | None = None
    keep: Column | None = None

    def vote(self) -> Column:
        no = F.lit(False)
        drop, keep = (F.coalesce(c, no) if c is not None else no for c in (self.drop, self.keep))
        return F.when(drop, -1).when(keep, 1).otherwise(0).cast("int")


def default_rules() -> list[Rule]:
    """Rules on the measures of ``features``. A junk rule speaks only where its own
    kind of junk is plain; two prose rules speak where a text looks ordinary."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    symbols = F.col("n_symbols") / words
    exclaims = F.col("n_exclaim") / words
    repeats = F.col("n_repeat_words") / words
    lines = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))
    capitals = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1))
    variety = F.col("n_distinct_words") / words
    poor = variety < F.least(F.lit(0.35), 8 / F.sqrt(words))
    return [
        Rule("symbols", drop=symbols > 0.15),
        Rule("shouting", drop=(capitals > 0.3) | (exclaims > 0.3)),
        Rule("repeats", drop=repeats > 0.2),
        Rule("lines", drop=lines > 0.3),
        Rule("variety", drop=poor),
        Rule("prose", keep=(symbols <= 0.02) & (exclaims <= 0.05) & (capitals <= 0.15) & (variety >= 0.5)),
        Rule("fresh", keep=(repeats <= 0.1) & (lines <= 0.1) & (symbols <= 0.02) & (exclaims <= 0.05) & ~poor),
    ]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measures of every whole text, one row per input row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    split = base.select(
        "_id", "_text",
        F.filter(F.split("_text", SPACE + "+"), lambda w: w != "").alias("_words"),
        F.filter(F.split("_text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")).alias("_lines"))
    counted = split.select(
        "_id", "_words",
        F.size("_words").cast("long").alias("n_words"),
        F.size(F.array_distinct("_words")).cast("long").alias("n_distinct_words"),
        F.length(F.translate("_text", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.length("_text") - F.length(F.translate("_text", "!", ""))).cast("long").alias("n_exclaim"),
        F.length(F.regexp_replace("_text", "[^\\p{Lu}]+", "")).cast("long").alias("n_upper"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"))
    last = F.size("_words") - (WINDOW - 1)
    windows = counted.withColumn("_w", F.when(last > 0, F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
        lambda i: F.xxhash64(F.slice("_words", i, WINDOW)))).otherwise(F.array().cast("array<bigint>")))
    repeated = windows.withColumn("n_repeat_words", _covered(F.col("_w")))
    return repeated.select(F.col("_id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines",
                           "n_repeat_words", "n_distinct_words", "n_exclaim", "n_upper", "n_lines")


def _covered(hashes: Column) -> Column:
    """Words inside windows whose hash occurs twice or more. Texts without a repeated
    window stop at the distinct count; the others sort (hash, position) once."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twins(s):
        return F.filter(s, lambda e, i: ((i > 0) & (F.get(s, F.greatest(i - 1, F.lit(0)))["h"] == e["h"]))
                        | F.coalesce(F.get(s, i + 1)["h"] == e["h"], F.lit(False)))

    # the sorted pairs are bound once as the only element of an array
    places = F.flatten(F.transform(F.array(pairs), lambda s: F.transform(twins(s), lambda e: e["i"])))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
    covered = F.aggregate(F.sort_array(places), start, lambda a, p: F.struct(
        (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).cast("long").alias("n"), p.alias("last")))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), covered["n"]).otherwise(F.lit(0).cast("long"))


@dataclass
class LabelModel:
    """``accuracy[j]``: how often the votes of rule j are right; an abstention says nothing."""
    balance: float
    accuracy: list[float]

    def log_odds(self, votes) -> float:
        return log(self.balance / (1 - self.balance)) + sum(
            v * log(a / (1 - a)) for v, a in zip(votes, self.accuracy))

    def posterior(self, votes) -> float:
        return 1 / (1 + exp(-self.log_odds(votes)))

    def posterior_column(self, votes: list[Column]) -> Column:
        s = F.lit(log(self.balance / (1 - self.balance)))
        for vote, a in zip(votes, self.accuracy):
            s = s + vote * F.lit(log(a / (1 - a)))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-s))


def fit(patterns: list[tuple[tuple[int, ...], int]], balance: float = 0.5, rounds: int = 100,
        right: float = 8.0, wrong: float = 2.0) -> LabelModel:
    """Expectation-maximisation over (votes, count) patterns.

    E: the posterior of "good" for each pattern. M: a rule's accuracy is the
    share of its votes that agree with the posteriors, with ``right`` and
    ``wrong`` added as prior votes (so that a rule starts better than chance and
    one that never speaks stays there). ``balance`` is the class prior; it isn't
    learnt, as junk rules that rarely meet would then be explained away by a
    large share of good documents. Same patterns, same model, in any order.
    """
    patterns = sorted(patterns)
    m = len(patterns[0][0]) if patterns else 0
    model = LabelModel(balance, [right / (right + wrong)] * m)
    for _ in range(rounds if patterns else 0):
        good = [model.posterior(votes) for votes, _ in patterns]
        accuracy = []
        for j in range(m):
            hits = right + sum(n * (g if votes[j] > 0 else 1 - g)
                               for (votes, n), g in zip(patterns, good) if votes[j])
            accuracy.append(hits / (right + wrong + sum(n for votes, n in patterns if votes[j])))
        moved = max(abs(x - y) for x, y in zip(accuracy, model.accuracy))
        model = LabelModel(balance, accuracy)
        if moved < 1e-9:
            break
    return model


def judge(docs: DataFrame, rules: list[Rule] | None = None, id_col: str = "doc_id",
          text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Measures, votes, ``quality`` (posterior), ``base_failed`` and ``kept`` per document."""
    rules = default_rules() if rules is None else rules
    votes = [f"vote_{r.name}" for r in rules]
    measured = features(docs, id_col, text_col)
    voted = stage(measured.withColumns({v: r.vote() for v, r in zip(votes, rules)}), "quality-votes")
    # 3^m rows at most
    counts = voted.groupBy(*votes).agg(F.count(F.lit(1)).alias("n")).collect()
    model = fit([(tuple(r[v] for v in votes), r["n"]) for r in counts])
    failed = ((F.col("n_words") < MIN_WORDS)
              | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    return (voted.withColumn("base_failed", failed)
            .withColumn("quality", model.posterior_column([F.col(v) for v in votes]))
            .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= threshold)))
