"""Id dictionary as an append-only log of versions.

An extension writes only its new rows, to a partition of its own, and then one
small record: the number of the version, the ids it covers, its partition and
its key filter. The record is what makes a version exist; rows of an attempt
that fails, or that loses against another writer, have none and are never read.
Old rows are never written again. Readers follow the records, so a reader at
version v sees the rows of versions 1 to v whatever is written meanwhile.

    root/log/00000001.json ...      records, one per version
    root/rows/version=<name>/       (track, id), in hash buckets of the track
    root/filters/<name>/            blocks of 512 bits, 16 bits a key, 3 bits set for each

Rows lie in hash buckets, so a batch of keys is dealt to the buckets and joined
without moving the stored rows. Ahead of that join, a filter of the keys of
each version tells which keys of a batch can't be known: those skip the join. The
filters are tables of their own (2 bytes a key), so they are joined by Spark,
broadcast only if their stored size allows.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from mixtape.operators import index as idx
from mixtape.session import shuffle_partitions, stage
from mixtape.sources import artefacts

FILTER_BITS = 16      # per key
BLOCK_BITS = 512
WORDS = 8
BITS_SET = 3


@dataclass
class Extension:
    """What one extension did with a batch of distinct keys."""
    version: int        # the version that holds the batch
    batch: int          # distinct keys of the batch
    skipped: int        # of them, keys that no filter knew: they never met the stored rows
    checked: int        # keys that were joined with the stored rows
    added: int          # new ids


def _table(root: str) -> str:
    return "mixtape_" + hashlib.sha256(root.encode()).hexdigest()[:24]


def log(spark: SparkSession, root: str) -> list[dict]:
    """The records of all versions, the oldest first."""
    return artefacts.records(spark, f"{root.rstrip('/')}/log")


def _rows(spark: SparkSession, root: str, buckets: int) -> str:
    """The stored rows as a table of the session's catalog; name and layout follow from the folder."""
    name = _table(root)
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} (track STRING, id INT, version STRING) USING parquet PARTITIONED BY (version) "
                  f"CLUSTERED BY (track) SORTED BY (track) INTO {buckets} BUCKETS LOCATION '{root}/rows'")
        if spark.conf.get("spark.sql.catalogImplementation") == "hive":
            spark.catalog.recoverPartitions(name)       # the built-in catalog lists the folder instead
    return name


def read(spark: SparkSession, root: str, version: int | None = None, with_version: bool = False) -> DataFrame:
    """(track, id) at a version (default: the last); with ``with_version`` also the number of the
    version that added the row. A dictionary without versions is empty."""
    root = root.rstrip("/")
    taken = [r for r in log(spark, root) if version is None or r["version"] <= version]
    if not taken:
        empty = idx.empty_index(spark)
        return empty.withColumn("version", F.lit(0)) if with_version else empty
    name = _rows(spark, root, taken[0]["buckets"])
    spark.catalog.refreshTable(name)
    rows = spark.table(name).where(F.col("version").isin([r["name"] for r in taken]))
    if not with_version:
        return rows.select("track", "id")
    number = F.substring("version", 2, 8).cast("int")
    return rows.select("track", "id", number.alias("version"))


# --- key filters ------------------------------------------------------------------

def _place(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block")


def _bits(key: Column) -> list[Column]:
    """The bits of a key in its block."""
    h = F.xxhash64(key, F.lit(1))
    return [F.shiftrightunsigned(h, 9 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(BITS_SET)]


def build_filter(keys: DataFrame, n: int, key: str = "track") -> DataFrame:
    """(block, w0 .. w7): a filter of ``n`` keys in blocks of 512 bits."""
    blocks = max(1, -(-n * FILTER_BITS // BLOCK_BITS))
    one = F.lit(1).cast("long")

    def word(w: int) -> Column:
        set_ = [F.when(F.shiftright(b, 6) == w, F.call_function("shiftleft", one, b.bitwiseAND(F.lit(63)))).otherwise(F.lit(0).cast("long"))
                for b in _bits(F.col(key))]
        out = set_[0]
        for more in set_[1:]:
            out = out.bitwiseOR(more)
        return F.bit_or(out).alias(f"w{w}")

    return keys.groupBy(_place(F.col(key), blocks)).agg(*[word(w) for w in range(WORDS)])


def _known_by(keys: DataFrame, stored: DataFrame, blocks: int, flag: str, key: str = "track") -> DataFrame:
    """keys + ``flag``: False if the filter rules the key out."""
    words = F.array(*[F.col(f"w{w}") for w in range(WORDS)])
    met = keys.withColumn("block", _place(F.col(key), blocks)).join(stored, "block", "left")
    hit = F.col("w0").isNotNull()
    for b in _bits(F.col(key)):
        word = F.get(words, F.shiftright(b, 6))
        hit = hit & (F.call_function("shiftright", word, b.bitwiseAND(F.lit(63))).bitwiseAND(F.lit(1).cast("long")) == 1)
    return met.select(*keys.columns, F.coalesce(hit, F.lit(False)).alias(flag))


def _maybe_known(spark: SparkSession, root: str, keys: DataFrame, taken: list[dict]) -> DataFrame:
    """keys + ``_maybe``: whether the filter of any version lets the key through."""
    flagged = keys.withColumn("_maybe", F.lit(False))
    for record in taken:
        stored = spark.read.parquet(f"{root}/filters/{record['name']}")
        flagged = (_known_by(flagged, stored, record["blocks"], "_here")
                   .select(*keys.columns, (F.col("_maybe") | F.col("_here")).alias("_maybe")))
    return flagged


# --- extension and lookup --------------------------------------------------------------

def extend(spark: SparkSession, root: str, df: DataFrame, input_col: str = "track_uri", buckets: int | None = None,
           num_partitions: int | None = None, attempts: int = 5) -> Extension:
    """Gives ids to the keys of ``df`` that the dictionary doesn't hold, in key order from its
    largest id on, as its next version. Null keys get no id; a batch without new keys makes no
    version. If another writer publishes first, the batch is compared with its version too."""
    root = root.rstrip("/")
    keys = stage(df.select(F.col(input_col).cast("string").alias("track")).where(F.col(input_col).isNotNull()).distinct(),
                 "batch-keys")
    batch = keys.count()
    for _ in range(attempts):
        taken = log(spark, root)
        if taken:
            flagged = stage(_maybe_known(spark, root, keys, taken), "batch-filtered")
            sure = flagged.where(~F.col("_maybe")).select("track")
            check = flagged.where("_maybe").select("track")
            fresh = stage(sure.unionByName(check.join(read(spark, root), "track", "left_anti")), "new-keys")
            skipped = sure.count()
        else:
            fresh, skipped = keys, batch
        added = fresh.count()
        last = taken[-1] if taken else {"version": 0, "last_id": 0, "buckets": buckets or shuffle_partitions(spark)}
        out = Extension(last["version"], batch, skipped, batch - skipped, added)
        if not added:
            return out
        number = last["version"] + 1
        name = f"v{number:08d}-{uuid.uuid4().hex[:8]}"
        numbered = idx.dense_ids(fresh, "track", last["last_id"], num_partitions)
        (numbered.withColumn("version", F.lit(name)).repartition(last["buckets"], "track")
         .write.mode("append").format("parquet").partitionBy("version")
         .bucketBy(last["buckets"], "track").sortBy("track").saveAsTable(_rows(spark, root, last["buckets"])))
        blocks = max(1, -(-added * FILTER_BITS // BLOCK_BITS))
        build_filter(fresh, added).write.parquet(f"{root}/filters/{name}")
        record = {"version": number, "name": name, "first_id": last["last_id"] + 1, "last_id": last["last_id"] + added,
                  "rows": added, "blocks": blocks, "buckets": last["buckets"]}
        if artefacts.publish(spark, f"{root}/log/{number:08d}.json", record):
            out.version = number
            return out
    raise RuntimeError(f"other writers were first {attempts} times")


def lookup(spark: SparkSession, root: str, keys: DataFrame, key_col: str = "track", version: int | None = None) -> DataFrame:
    """keys + ``id`` (null if unknown): keys that no filter knows aren't joined with the stored rows."""
    root = root.rstrip("/")
    taken = [r for r in log(spark, root) if version is None or r["version"] <= version]
    if not taken:
        return keys.withColumn("id", F.lit(None).cast("int"))
    wide = keys.select(F.struct("*").alias("_row"), F.col(key_col).alias("track"))
    flagged = stage(_maybe_known(spark, root, wide, taken), "lookup-filtered")
    maybe = F.col("_maybe") & F.col("track").isNotNull()
    found = flagged.where(maybe).join(read(spark, root, version), "track", "left").select("_row.*", "id")
    rest = flagged.where(~maybe).select("_row.*", F.lit(None).cast("int").alias("id"))
    return found.unionByName(rest)


def versions(spark: SparkSession, root: str) -> DataFrame:
    """(version, rows, first_id, last_id) of the log: one row per extension."""
    found = [(r["version"], r["rows"], r["first_id"], r["last_id"]) for r in log(spark, root)]
    return spark.createDataFrame(found, "version int, n_rows long, first_id long, last_id long")


