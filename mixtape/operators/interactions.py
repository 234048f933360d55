"""Playlist-track rows -> user-item interactions; baskets; audits; routing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixtape import schemas
from mixtape.operators import dictionary
from mixtape.operators import index as idx
from mixtape.session import stage


def interactions(rows: DataFrame, index: DataFrame, input_col: str = "track_uri",
                 rows_distinct: bool = False) -> DataFrame:
    """rows.* + track_uri_index (left join) + rating = 1, distinct over all columns.

    A dictionary has unique keys, so the id is a function of the key and
    de-duplicating the rows before the join gives the same rows as after it;
    doing it first lets callers store the distinct rows once and skip it here
    (``rows_distinct=True``).
    """
    base = rows if rows_distinct else rows.distinct()
    return (idx.encode(base, index, input_col, "track_uri_index")
            .withColumn("rating", F.lit(1)))


def ingest(rows: DataFrame, index: DataFrame | None = None, input_col: str = "track_uri",
           num_partitions: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Flattened rows (+ optional existing dictionary) -> (interactions, dictionary).
    The distinct rows are stored, as the dictionary and the interactions both read them."""
    rows = stage(rows.distinct(), "ingest-rows")
    if index is None:
        index = idx.build_index(rows, input_col, num_partitions)
    else:
        index = idx.extend_index(index, rows, input_col, num_partitions)
    return interactions(rows, index, input_col, rows_distinct=True), index


def ingest_stored(spark: SparkSession, rows: DataFrame, root: str, input_col: str = "track_uri") -> DataFrame:
    """Flattened rows -> interactions, with the dictionary stored at ``root``: it is extended by
    what the rows bring, and its rows are joined in the buckets that they lie in."""
    rows = stage(rows.distinct(), "ingest-rows")
    dictionary.extend(spark, root, rows, input_col)
    return interactions(rows, dictionary.read(spark, root), input_col, rows_distinct=True)


def user_items(inter: DataFrame, user_col: str = "playlist_id",
               item_col: str = "track_uri_index", pairs_distinct: bool = False) -> DataFrame:
    """Distinct (user, item) pairs with a known id: the input of ALS and vectors.
    ``pairs_distinct``: no pair comes twice in ``inter``, so nothing is shuffled."""
    pairs = (inter.where(F.col(item_col).isNotNull())
             .select(F.col(user_col), F.col(item_col).cast("int").alias(item_col)))
    return pairs if pairs_distinct else pairs.distinct()


def catalog_rows(inter: DataFrame) -> DataFrame:
    return inter.select(*schemas.CATALOG_COLUMNS).distinct()


def basket_interactions(baskets: DataFrame, catalog: DataFrame, index: DataFrame,
                        basket_col: str = "basket_id") -> DataFrame:
    """Baskets (basket_id, track_uri) -> interaction rows of each basket.

    Keys are matched against catalog rows (unknown URIs drop out), then the id is
    attached and rating = 1, as for stored playlists. Baskets carry their own id.
    Baskets, catalog and dictionary are each made distinct before they meet, so the
    rows that come out are, and no task holds them all with their names.
    """
    wanted = baskets.select(basket_col, "track_uri").distinct()
    known = idx.encode(catalog.select(*schemas.CATALOG_COLUMNS).distinct(), index.select("track", "id").distinct(),
                       "track_uri", "track_uri_index")
    return (wanted.join(known, "track_uri")
            .select(basket_col, *schemas.CATALOG_COLUMNS, "track_uri_index").withColumn("rating", F.lit(1)))


def dup_audit(df: DataFrame, keys: tuple[str, ...] = ("playlist_id", "track_uri_index"),
              threshold: int = 2) -> DataFrame:
    """Key combinations occurring more than ``threshold`` times."""
    return df.groupBy(*keys).count().where(F.col("count") > threshold)


def split_known_new(baskets: DataFrame, existing: DataFrame, basket_col: str = "basket_id",
                    user_col: str = "playlist_id") -> DataFrame:
    """distinct basket ids + ``is_known`` (the id is an existing playlist id).

    One left join against the distinct existing ids marks every basket.
    """
    ids = baskets.select(basket_col).distinct()
    users = (existing.select(F.col(user_col).alias(basket_col)).distinct()
             .withColumn("is_known", F.lit(True)))
    return (ids.join(users, basket_col, "left")
               .select(basket_col, F.coalesce("is_known", F.lit(False)).alias("is_known")))
