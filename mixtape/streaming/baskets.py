"""Arriving basket requests -> recommendation envelopes, as a streaming query.

A request is one JSON line ``{"basket_id": .., "uri_list": "uri,uri,.."}``
dropped into a folder. Each micro-batch is recommended with the same batched
plan as ``recommend_new`` (no per-request driver loop), and its envelopes are
written to ``<sink>/epoch=<id>`` with overwrite, so a replayed epoch after a
failure rewrites the same folder instead of duplicating rows. What a batch
stores on the way is released with it. The stream's
checkpoint lives in the shared folder, so a restarted query resumes.
"""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, types as T

from mixtape.functions.text import explode_uri_list
from mixtape.operators import recommend as rec
from mixtape.session import scratch_scope

REQUEST = T.StructType([
    T.StructField("basket_id", T.LongType()),
    T.StructField("uri_list", T.StringType()),
])


def write_requests(requests: DataFrame, folder: str) -> str:
    """Write (basket_id, uri_list) rows as JSON-lines request files."""
    requests.select("basket_id", "uri_list").write.mode("append").json(folder)
    return folder


def recommend_batch(batch: DataFrame, model: ALSModel, index: DataFrame, existing: DataFrame,
                    by_id: DataFrame, k: int = rec.RECS_JOB) -> DataFrame:
    baskets = explode_uri_list(batch).select("basket_id", "pos", "track_uri")
    recs = rec.recommend_new(model, baskets, index, existing, k, by_id)
    return rec.envelope(recs, baskets)


def start(spark: SparkSession, source: str, sink: str, checkpoint: str, model: ALSModel,
          index: DataFrame, existing: DataFrame, by_id: DataFrame, k: int = rec.RECS_JOB,
          available_now: bool = True, max_files_per_trigger: int | None = None):
    """Start the streaming query; returns the ``StreamingQuery``."""
    reader = spark.readStream.schema(REQUEST)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.json(source)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        with scratch_scope(spark):
            out = recommend_batch(batch, model, index, existing, by_id, k)
            out.write.mode("overwrite").parquet(f"{sink}/epoch={epoch_id}")

    writer = (stream.writeStream.foreachBatch(handle)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="30 seconds")
    return writer.start()
