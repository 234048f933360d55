"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a global number (dense, from 0, in the order of the id), the
number goes through a keyed permutation of 0..n-1, and the permuted place says
where the row lies: ``shard = place % shards`` and ``slot = place // shards``.
So shard row counts differ by one at most, the shuffle is reproducible from
(n, seed) alone, and anyone can compute the shard and slot of a row number
without looking at the data (``place_of``, and ``row_at`` for the inverse).

Only DataFrame functions run on the data: the round function is plain integer
arithmetic below 2^62, so Spark, SQL engines and Python give the same places.

Defined results: a null text has no bytes and the checksum of the empty
string; rows that agree in every sort column are interchangeable; null ids come
first; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window, functions as F

from mixtape.session import scratch_path, shuffle_partitions

PRIME = 2_147_483_647
ROUNDS = 4
#: Walks done inside one expression; rows that are still outside go round again.
WALKS = 8


def round_keys(seed: int) -> list[tuple[int, int, int]]:
    """(multiplier, addend, second addend) of each round, all in 1..PRIME-1."""
    keys, x = [], seed % PRIME + 1
    for _ in range(ROUNDS):
        row = []
        for _ in range(3):
            x = (x * 48_271 + 11) % PRIME
            row.append(x % (PRIME - 1) + 1)
        keys.append(tuple(row))
    return keys


def domain(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n as tight as a near-square allows: fewer than a values lie outside."""
    a = max(1, isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def _mix(x, key):
    a, c, d = key
    y = (x % PRIME * a + c) % PRIME
    return (y * y % PRIME + d) % PRIME


def _encrypt(x, a: int, b: int, keys, div):
    """One pass of the network on x = left * b + right; left in Z_a, right in Z_b."""
    left, right = div(x, b), x % b
    for i, key in enumerate(keys):
        if i % 2 == 0:
            left = (left + _mix(right, key)) % a
        else:
            right = (right + _mix(left, key)) % b
    return left * b + right


def place_of(row: int, n: int, seed: int) -> int:
    """The place of a row number, in plain Python."""
    a, b = domain(n)
    keys = round_keys(seed)
    x = row
    while True:
        x = _encrypt(x, a, b, keys, lambda v, d: v // d)
        if x < n:
            return x


def row_at(place: int, n: int, seed: int) -> int:
    """The row number at a place: the network run backwards, walking the same cycle."""
    a, b = domain(n)
    keys = round_keys(seed)
    x = place
    while True:
        left, right = divmod(x, b)
        for i, key in reversed(list(enumerate(keys))):
            if i % 2 == 0:
                left = (left - _mix(right, key)) % a
            else:
                right = (right - _mix(left, key)) % b
        x = left * b + right
        if x < n:
            return x


def walk(x: Column, n: int, seed: int) -> Column:
    """Up to WALKS passes over ``x``, stopping at the first value below n."""
    a, b = domain(n)
    keys = round_keys(seed)
    steps = F.sequence(F.lit(1), F.lit(WALKS - 1))
    return F.aggregate(steps, _encrypt(x, a, b, keys, _long_div), lambda acc, _: F.when(
        acc < n, acc).otherwise(_encrypt(acc, a, b, keys, _long_div)))


def _long_div(v: Column, d: int) -> Column:
    return F.call_function("div", v, F.lit(d).cast("long"))


def number_rows(rows: DataFrame, order: list[str], number_col: str = "row_number") -> DataFrame:
    """``rows`` with a dense long number from 0 in the order of the columns.

    The rows are range partitioned and sorted inside each partition and written
    once with their partition and position, so the numbers don't change when a
    task runs again. A value that many rows share spreads over partitions by
    their input positions, as equal rows are interchangeable.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "numbered-input")
    rows.withColumn("_tie", F.monotonically_increasing_id()).write.parquet(path)
    ranged = spark.read.parquet(path).repartitionByRange(shuffle_partitions(spark), *order, "_tie")
    placed_path = scratch_path(spark, "numbered")
    (ranged.sortWithinPartitions(*order, "_tie").drop("_tie")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_part").cast("long"), 33))
        .write.parquet(placed_path))
    placed = spark.read.parquet(placed_path)
    # one row per range partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
               .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")))
    return (placed.join(F.broadcast(offsets), "_part")
            .withColumn(number_col, F.col("_before") + F.col("_pos")).drop("_part", "_pos", "_before"))


def permute(rows: DataFrame, n: int, seed: int, number_col: str = "row_number") -> DataFrame:
    """``rows`` with ``place``, the permuted row number. The domain is so tight that a
    walk longer than WALKS is rare; such rows are walked on until none is left outside."""
    spark = rows.sparkSession
    placed = rows.withColumn("place", walk(F.col(number_col), n, seed))
    path = scratch_path(spark, "placed")
    placed.write.parquet(path)
    out = spark.read.parquet(path)
    while out.where(F.col("place") >= n).limit(1).count():
        path = scratch_path(spark, "placed")
        out.withColumn("place", F.when(F.col("place") < n, F.col("place"))
                       .otherwise(walk(F.col("place"), n, seed))).write.parquet(path)
        out = spark.read.parquet(path)
    return out


def shard(docs: DataFrame, shards: int = 24, seed: int = 2024, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, row_number, place, shard, slot), one row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"),
                       (F.octet_length(text) + 8).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = number_rows(rows, ["_id", "text_crc32", "size"])
    n = numbered.count()
    out = permute(numbered, n, seed) if n else numbered.withColumn("place", F.lit(0).cast("long"))
    return out.select(F.col("_id").alias(id_col), "size", "text_crc32", "row_number", "place",
                      (F.col("place") % shards).cast("int").alias("shard"),
                      _long_div(F.col("place"), shards).alias("slot"))
