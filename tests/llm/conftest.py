import duckdb
import pytest

import public_tokenizers

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "benchmark")


@pytest.fixture(scope="session")
def duck(sf_smoke):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_smoke}/{name}.parquet')")
    return con


@pytest.fixture(scope="session")
def documents(duck):
    """(doc_id, text) of the smallest data."""
    return duck.execute("select doc_id, text from documents order by doc_id").fetchall()


@pytest.fixture(scope="session")
def frame(spark):
    """A documents table from (doc_id, text) rows, with columns that clash with inner names."""
    def make(rows, extra=True):
        df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        if extra:
            from pyspark.sql import functions as F
            for name in ("_id", "_text", "_row", "id", "n_words", "length", "score", "key", "a", "b"):
                df = df.withColumn(name, F.lit("x"))
        return df
    return make


@pytest.fixture(scope="session")
def word_tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def byte_tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")
