"""A corpus pipeline over ``documents``: toxicity, near duplicates, repeated
passages, benchmark leaks, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before
kept; what it returns is written as Parquet and read again for the next. All
but the last return the columns of ``documents``; the last one returns the
pieces of the documents with their ids and their place in a sequence.

All stages take a null text as empty, keep each of several equal rows or judge them
alike unless they say otherwise, carry columns of any name along unread, and give
no rows for an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from mixtape.llm import decontamination, neardup, packing, repeats, toxicity
from mixtape.session import stage


#: Bytes of text that a task of the repeats stage holds, less than alone: other stages' memory stays.
BATCH = 6 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with column names that no operator gives to its own results, and those names."""
    names = {c: f"_doc{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns outside the held-out fold.
    Rows without an id are scored, not learnt from."""
    own, names = apart(docs)
    model = toxicity.learn(own, table(spark, sf_dir, "labels").withColumnRenamed("doc_id", names["doc_id"]),
                           learnable=~toxicity.held_out(F.col("_id")), id_col=names["doc_id"], text_col=names["text"])
    scored = toxicity.score(own, model, text_col=names["text"], score_col="_toxicity")
    return scored.where(F.col("_toxicity") < toxicity.THRESHOLD).select(*names.values()).toDF(*names)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8), the one with
    the smallest id; of equal rows one stays, and documents without words stay."""
    return neardup.drop_duplicates(docs, k=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that a document with a smaller id holds; texts that had
    nothing else go. ``n_chars`` counts what is left."""
    own, names = apart(docs)
    text, chars = F.col(names["text"]), F.col(names["n_chars"])
    cut = repeats.remove(own, id_col=names["doc_id"], text_col=names["text"], carry=own.columns, whole_characters=True,
                         batch_bytes=BATCH)
    changed = F.size("starts") > 0
    out = (cut.withColumn(names["text"], F.when(changed, F.col("kept").cast("string")).otherwise(text))
           .withColumn(names["n_chars"], F.when(changed, F.length(text).cast("long")).otherwise(chars)))
    return out.where(~changed | (F.trim(text) != "")).select(*names.values()).toDF(*names)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item; those without an id are judged by their text."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens at most."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0, capacity=2048)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_duplicates),
    ("repeats", without_repeats),
    ("decontamination", without_leaks),
    ("packing", packed),
]

#: The stages are models, sketches and searches, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
