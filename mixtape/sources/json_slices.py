"""Nested playlist slices as multi-line JSON documents (one document per file).

Reading uses an explicit schema: no inference pass, and only the fields the
model needs are materialised. A multi-line document cannot be split, so each
file is one scan task; many moderate files parallelise, one huge file does
not. ``repartition`` after the flatten spreads the rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixtape import schemas
from mixtape.session import stage


# glob of the documents written by ``write_slices`` under a folder
WRITTEN_GLOB = "slice=*/chunk=*/*.json"


def read_slices(spark: SparkSession, path: str | list[str], recursive: bool = False) -> DataFrame:
    reader = spark.read.schema(schemas.SLICE).option("multiLine", True)
    if recursive:
        # Descends into sub-folders; turns partition discovery off.
        reader = reader.option("recursiveFileLookup", True)
    return reader.json(path)


def flatten_slices(slices: DataFrame) -> DataFrame:
    """Documents -> one row per (playlist, track); empty/missing arrays drop out."""
    entries = slices.select(F.inline("playlists"))
    rows = entries.select("pid", F.inline("tracks"))
    return rows.select(F.col("pid").alias("playlist_id"), *schemas.TRACK.names)


def write_slices(rows: DataFrame, path: str, playlists_per_slice: int = 1000,
                 tracks_per_entry: int = 1000) -> str:
    """Write playlist-track rows as slice documents, one document per file.

    Every collected group is bounded: a playlist's rows are dealt to
    chunks of about ``tracks_per_entry`` tracks (its size is counted first; repeats
    of one track are dealt apart), each chunk is one playlist entry, and a document holds the
    entries of one chunk number for at most ``playlists_per_slice``
    consecutive playlist ids. Flattening gives back exactly the rows (an id may
    appear in several entries). Written with ``partitionBy`` so every document
    lands in its own folder and file.
    """
    fields = ["track_uri", "track_name", "artist_name", "album_name"]
    # stored with an id, so that a task that runs again deals its rows as before
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "slice-rows")
    sizes = rows.groupBy("playlist_id").agg(F.count(F.lit(1)).alias("_n"))
    chunks = F.greatest(F.ceil(F.col("_n") / tracks_per_entry), F.lit(1))
    chunked = (rows.join(sizes, "playlist_id")
               .withColumn("chunk", F.pmod(F.xxhash64(*fields, "_row"), chunks)))
    entries = (chunked.groupBy("playlist_id", "chunk")
               .agg(F.collect_list(F.struct(*fields)).alias("tracks"))
               .select(F.col("playlist_id").alias("pid"), "tracks", "chunk",
                       F.floor(F.col("playlist_id") / playlists_per_slice).alias("slice")))
    docs = (entries.groupBy("slice", "chunk")
            .agg(F.collect_list(F.struct("pid", "tracks")).alias("playlists")))
    (docs.repartition("slice", "chunk").write.mode("errorifexists")
         .partitionBy("slice", "chunk").json(path))
    return path
