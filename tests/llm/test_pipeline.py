import corpus_pipeline
import pytest

import __spark_entry__ as entry
from mixtape.llm import decontamination, neardup, queries, repeats, toxicity
from tests.llm import brute
from tests.llm.test_repeats import brute as repeat_brute
from tests.llm.test_tokens import packed_right


@pytest.fixture(scope="module")
def stages(spark, sf_smoke, tmp_path_factory):
    """Input and output rows of every stage."""
    docs, out = spark.read.parquet(f"{sf_smoke}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        function(spark, docs, sf_smoke).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = docs, after
        docs = after
    return out


def rows(df):
    return sorted((r.doc_id, r.text) for r in df.collect())


def test_stages_keep_the_columns(stages, spark, sf_smoke):
    columns = spark.read.parquet(f"{sf_smoke}/documents.parquet").dtypes
    assert [name for name, _ in corpus_pipeline.STAGES] == list(stages)
    assert all(after.dtypes == columns for name, (_, after) in list(stages.items())[:-1])


def test_toxicity(stages, spark, sf_smoke):
    before, after = stages["toxicity"]
    model = toxicity.learn(before, spark.read.parquet(f"{sf_smoke}/labels.parquet"),
                           learnable=~toxicity.held_out(toxicity.F.col("_id")))
    kept = toxicity.score(before, model).where(f"toxicity < {toxicity.THRESHOLD}")
    assert rows(after) == rows(kept)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    kept = {d for d, (_, keep) in brute.near_duplicates(rows(before), 5, 80).items() if keep}
    assert rows(after) == [r for r in rows(before) if r[0] in kept]


def test_repeats(stages):
    before, after = stages["repeats"]
    expected = []
    for doc, _, gone, _, kept in repeat_brute(rows(before)):
        text = kept.decode("utf-8", "ignore")
        if not gone or text.strip(" "):
            expected.append((doc, text))
    got = rows(after)
    assert [d for d, _ in got] == sorted(d for d, _ in expected)
    # a character goes if all its bytes do, so at most its own bytes more stay than by bytes
    assert all(len(a) - len(b) <= 2 * 40 and (a == b or len(a) >= len(b)) for (_, a), (_, b) in zip(got, sorted(expected)))
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_decontamination(stages, duck):
    before, after = stages["decontamination"]
    items = [brute.plain_words(t) for (t,) in duck.execute("select text from benchmark").fetchall()]
    kept = []
    for doc, text in rows(before):
        words = brute.plain_words(text)
        known = set(words)
        leak = any(sum(w in known for w in i) >= 0.8 * len(i) and brute.edits(i, words) <= int(0.2 * len(i)) for i in items)
        if not leak:
            kept.append((doc, text))
    assert rows(after) == kept


def test_packing(stages):
    before, after = stages["packing"]
    got = after.collect()
    assert {r.doc_id for r in got} == {d for d, _ in rows(before)}
    assert packed_right([(r.sequence_id, r.offset, r.length) for r in got], 2048) == -(-sum(r.length for r in got) // 2048)


def test_run_and_registration(spark, sf_smoke, stages):
    out = corpus_pipeline.run(spark, sf_smoke)
    assert out.count() == stages["packing"][1].count()
    names = entry.queries()
    assert "pipeline" in names and [n for n in range(1, 11) if not any(q.startswith(f"op{n}_") for q in names)] == []
    assert set(queries.ORACLE) <= set(entry.oracle_sql())
    assert corpus_pipeline.ORACLE_SQL is None


def test_empty_documents(spark, sf_smoke):
    docs = spark.read.parquet(f"{sf_smoke}/documents.parquet").where("false")
    for _, function in corpus_pipeline.STAGES:
        assert function(spark, docs, sf_smoke).count() == 0
    assert neardup and repeats and decontamination


CLASHING = ("kept", "starts", "ends", "n_bytes", "_toxicity", "toxicity", "score", "_id", "_text", "_row", "_batch", "_doc0", "component_id")


def test_clashing_columns_and_rows_without_id(stages, spark, sf_smoke, duck):
    """Columns named like the operators' own come through unchanged, and a document without an
    id is judged like any other."""
    item = duck.execute("select text from benchmark order by length(text) desc limit 1").fetchone()[0]
    before = stages["decontamination"][0]
    own = before.select("doc_id", "text").limit(1).first()
    odd = before.limit(2).withColumn("doc_id", toxicity.F.lit(None).cast("long")).withColumn(
        "text", toxicity.F.when(toxicity.F.col("doc_id").isNull() & (toxicity.F.col("text") == own.text), item).otherwise("a plain text of no one"))
    wide = before.unionByName(odd)
    for name in CLASHING:
        wide = wide.withColumn(name, toxicity.F.concat(toxicity.F.lit(name), toxicity.F.col("doc_id").cast("string")))
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, wide, sf_smoke)
        assert out.dtypes == wide.dtypes
        for r in out.where("doc_id is not null").select("doc_id", *CLASHING).distinct().collect():
            assert all(r[c] == f"{c}{r.doc_id}" for c in CLASHING)
        if name == "decontamination":
            assert [r.text for r in out.where("doc_id is null").collect()] == ["a plain text of no one"]
            assert rows(out.where("doc_id is not null")) == rows(stages[name][1])
    assert corpus_pipeline.packed(spark, wide, sf_smoke).count() >= wide.count()
