"""Joins whose keys may be few: one playlist may answer most baskets, one track be in most lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mixtape.session import shuffle_partitions

#: A key with more than this share of the rows is dealt in this many parts.
HEAVY_PARTS = 64


def join_dealt(left: DataFrame, right: DataFrame, key: str, spread: str, how: str = "inner", also: tuple[str, ...] = ()) -> DataFrame:
    """``left`` joined with ``right`` on ``key`` (and the columns ``also``). The keys above
    1 / HEAVY_PARTS of the left rows (HEAVY_PARTS at most) are met in parts drawn from the left
    column ``spread``, so no task gets all rows of one. ``left`` is read twice: it should be stored."""
    counts = left.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = left.agg(F.count(F.lit(1))).scalar()
    heavy = F.broadcast(counts.where((F.col("_n") * HEAVY_PARTS > total) & F.col(key).isNotNull())
                        .select(key, F.lit(HEAVY_PARTS).cast("long").alias("_parts")))
    parts = F.coalesce("_parts", F.lit(1).cast("long"))
    dealt = left.join(heavy, key, "left").withColumn("_part", F.pmod(F.xxhash64(spread), parts)).drop("_parts")
    dealt = dealt.repartition(shuffle_partitions(left.sparkSession), key, "_part")
    met = (right.join(heavy, key, "left")
           .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("_parts"))
    # by sorting: either side may be few bytes and many rows, so neither is broadcast
    return dealt.join(met.hint("merge"), [key, "_part", *also], how).drop("_part")
