"""Dense, extendable id dictionary for item keys: (track string, id int).

Ids are dense from ``max existing id + 1`` in key order. The global order is
computed without a single-partition window: distinct new keys are range
partitioned and sorted within partitions and written together with their
partition number and position (one job, so the placement is fixed once
written), counted per partition, and each row gets ``offset of its partition
+ position inside it`` when the stored table is read. The offsets table has one
row per partition, so broadcasting it has a fixed bound.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixtape import schemas
from mixtape.session import scratch_path, shuffle_partitions, stage
from mixtape.sources.artefacts import read_parquet, write_parquet

INT_MAX = 2_147_483_647


def empty_index(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.INDEX)


def max_id(index: DataFrame) -> int:
    """Largest id of a dictionary; 0 for an empty one."""
    return int(index.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0])


def dense_ids(keys: DataFrame, key: str, start: int = 0,
              num_partitions: int | None = None) -> DataFrame:
    """Number distinct, non-null ``keys[key]`` as start+1, start+2, ... in key order."""
    spark = keys.sparkSession
    n = num_partitions or shuffle_partitions(spark)
    # the range sampler and the write both read the keys: store them once (a cached frame would
    # be dealt to the n ranges from shuffle-partition many parts, however few the keys)
    keys = stage(keys.select(key).where(F.col(key).isNotNull()), "dense-ids-keys")
    ranged = keys.repartitionByRange(n, key).sortWithinPartitions(key)
    # Partition number and position inside it are fixed in the same job that
    # writes them (monotonically_increasing_id = (partition << 33) + row
    # position; rows are sorted inside each range partition). A retried task
    # reads the same shuffle blocks with the same range bounds, so the written
    # values do not depend on which attempt wrote them.
    placed_path = scratch_path(spark, "dense-ids-placed")
    (ranged.select(key,
                   F.spark_partition_id().alias("_part"),
                   (F.monotonically_increasing_id()
                    - F.shiftleft(F.spark_partition_id().cast("long"), 33)).alias("_pos"))
           .write.mode("errorifexists").parquet(placed_path))
    placed = spark.read.parquet(placed_path)
    # one number per partition; as a constant of the plan, every reader of the dictionary gets the ids
    # by a projection of the stored rows
    counts = {r["_part"]: r["_n"] for r in placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).collect()}
    offsets = list(accumulate((counts.get(i, 0) for i in range(max(counts, default=0) + 1)), initial=start))
    if offsets[-1] > INT_MAX:
        raise OverflowError("track id exceeds int range")
    before = F.expr(f"array({', '.join(f'{n}L' for n in offsets)})")
    return placed.select(F.col(key), (F.element_at(before, F.col("_part") + 1) + F.col("_pos") + F.lit(1)).cast("int").alias("id"))


def new_keys(index: DataFrame, df: DataFrame, input_col: str = "track_uri") -> DataFrame:
    """Distinct non-null keys of ``df`` absent from the dictionary (left anti join)."""
    keys = df.select(F.col(input_col).alias("track")).where(F.col("track").isNotNull()).distinct()
    return keys.join(index.select("track"), "track", "left_anti")


def build_index(df: DataFrame, input_col: str = "track_uri",
                num_partitions: int | None = None) -> DataFrame:
    keys = df.select(F.col(input_col).alias("track")).distinct()
    return dense_ids(keys, "track", 0, num_partitions)


def extend_index(index: DataFrame, df: DataFrame, input_col: str = "track_uri",
                 num_partitions: int | None = None) -> DataFrame:
    """Append ids for keys of ``df`` not yet in ``index``; existing ids are kept."""
    start = max_id(index)
    added = dense_ids(new_keys(index, df, input_col), "track", start, num_partitions)
    return index.select("track", F.col("id").cast("int")).unionByName(added)


def is_new_key(index: DataFrame, keys: DataFrame, key_col: str = "track") -> DataFrame:
    """keys + boolean ``is_new`` (not present in the dictionary)."""
    known = index.select(F.col("track").alias("_k"), F.lit(False).alias("is_new"))
    return (keys.join(known, keys[key_col] == known["_k"], "left")
            .select(keys["*"], F.coalesce(F.col("is_new"), F.lit(True)).alias("is_new")))


def encode(df: DataFrame, index: DataFrame, input_col: str = "track_uri",
           output_col: str = "track_uri_index") -> DataFrame:
    """Attach the id of ``input_col`` (null when absent)."""
    idx = index.select(F.col("track").alias("_track"), F.col("id").alias(output_col))
    return (df.join(idx, df[input_col] == idx["_track"], "left")
              .select(df["*"], idx[output_col]))


def decode(df: DataFrame, index: DataFrame, id_col: str = "id",
           output_col: str = "track") -> DataFrame:
    """Attach the key of ``id_col`` (null when the id is unknown)."""
    idx = index.select(F.col("id").alias("_id"), F.col("track").alias(output_col))
    return (df.join(idx, df[id_col] == idx["_id"], "left")
              .select(df["*"], idx[output_col]))


def save_index(index: DataFrame, path: str, overwrite: bool = False) -> str:
    return write_parquet(index.select("track", F.col("id").cast("int")), path, overwrite)


def load_index(spark: SparkSession, path: str) -> DataFrame:
    return read_parquet(spark, path, schemas.INDEX)
