"""The registered queries of the subpackage: one thin ``opN_<name>`` per
operator over its whole table, and ``pipeline``. ``ORACLE`` holds DuckDB SQL
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import public_tokenizers

from mixtape.llm import decontamination
from mixtape.llm import licenses
from mixtape.llm import neardup
from mixtape.llm import negatives
from mixtape.llm import oracle
from mixtape.llm import packing
from mixtape.llm import pieces
from mixtape.llm import planes
from mixtape.llm import quality
from mixtape.llm import repeats
from mixtape.llm import sharding
from mixtape.llm import toxicity
from mixtape.llm import warc
from mixtape.llm import whitening
from mixtape.llm.templates import BASE_PHRASES, NOTICES
from mixtape.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register("op1_decontamination")
def op1_decontamination(spark, sf_dir):
    return decontamination.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op2_id_planes")
def op2_id_planes(spark, sf_dir):
    folder = scratch_path(spark, "id-planes")
    manifest = planes.write(table(spark, sf_dir, "documents"), folder,
                            public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return planes.read(manifest, digest=planes.crc32).withColumnRenamed("ids_digest", "ids_crc32")


@register("op3_packing")
def op3_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        end_id=0, capacity=2048, carry=[F.crc32("ids").alias("ids_crc32")])


@register("op4_licenses")
def op4_licenses(spark, sf_dir):
    return licenses.label(table(spark, sf_dir, "documents"), BASE_PHRASES, NOTICES)


@register("op5_quality")
def op5_quality(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents"))


@register("op6_repeats")
def op6_repeats(spark, sf_dir):
    cut = repeats.remove(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                      F.size("starts").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@register("op7_warc", sql=oracle.WARC)
def op7_warc(spark, sf_dir):
    manifest = warc.write(table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))
    return warc.read(manifest, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op8_toxicity")
def op8_toxicity(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.learn(docs, labels, learnable=~toxicity.held_out(F.col("_id")))
    scored = toxicity.score(docs.select("doc_id", "text"), model, score_col="score")
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@register("op9_shards", sql=oracle.SHARDS)
def op9_shards(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents"), shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "row_number")


@register("op10_near_duplicates", sql=oracle.NEAR_DUPLICATES)
def op10_near_duplicates(spark, sf_dir):
    found = neardup.groups(table(spark, sf_dir, "documents"), k=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept", "class_id")


@register("op11_hard_negatives", sql=oracle.HARD_NEGATIVES)
def op11_hard_negatives(spark, sf_dir):
    noisy = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", noisy)
    return negatives.mine(rows, F.col("_id") % 100 == 0)


@register("op12_whitening")
def op12_whitening(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@register("op13_sentencepiece")
def op13_sentencepiece(spark, sf_dir):
    coded = pieces.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@register("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)
