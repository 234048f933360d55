"""Track catalog: build, page, key lookups, one row per id, text rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from mixtape import schemas
from mixtape.functions.text import track_text

# Rows per catalog page, maximum stored length of the name fields.
PAGE_SIZE = 100
NAME_LIMIT = 200

_NAME_FIELDS = ("track_name", "artist_name", "album_name")
_ORDER = ("track_uri", "track_name", "artist_name", "album_name")


def build_catalog(inter: DataFrame, max_len: int = NAME_LIMIT) -> DataFrame:
    """Distinct catalog rows; names are cut to ``max_len`` before the distinct."""
    cut = [F.substring(F.col(c), 1, max_len).alias(c) for c in _NAME_FIELDS]
    return inter.select(*cut, "track_uri").distinct()


def write_catalog(catalog: DataFrame, path: str) -> str:
    """Stored in URI order, so lookups of a URI or a range of them skip row groups."""
    (catalog.select(*schemas.CATALOG_COLUMNS).orderBy("track_uri")
     .write.mode("overwrite").parquet(path))
    return path


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.CATALOG).parquet(path)


def catalog_page(catalog: DataFrame, offset: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """One page in URI order (ties broken by the name fields)."""
    return catalog.orderBy(*_ORDER).offset(offset).limit(size)


def catalog_page_after(catalog: DataFrame, after: tuple | None = None,
                       size: int = PAGE_SIZE) -> DataFrame:
    """Keyset page: the ``size`` rows following the sort key ``after`` (the last
    row of the previous page as (uri, name, artist, album)); ``None`` = first page.

    Same rows as ``catalog_page`` at the matching offset, but each partition keeps
    only ``size`` rows however deep the page is (an OFFSET keeps offset + size).
    """
    rows = catalog
    if after is not None:
        key = F.struct(*[F.col(c) for c in _ORDER])
        last = F.struct(*[F.lit(v).alias(c) for c, v in zip(_ORDER, after)])
        rows = catalog.where(key > last)
    return rows.orderBy(*_ORDER).limit(size)


def track_by_uri(catalog: DataFrame, uri: str) -> DataFrame:
    """First catalog row of one URI (deterministic first: by names)."""
    return catalog.where(F.col("track_uri") == F.lit(uri)).orderBy(*_ORDER).limit(1)


def tracks_by_uri(catalog: DataFrame, uris: list[str]) -> DataFrame:
    """Catalog rows whose URI is in a driver-side list (one literal set)."""
    if not uris:
        return catalog.limit(0)
    return catalog.where(F.col("track_uri").isin(list(dict.fromkeys(uris))))


def tracks_for_requests(catalog: DataFrame, requests: DataFrame,
                        request_col: str = "basket_id") -> DataFrame:
    """Batched membership: (request, uri) rows -> catalog rows per request."""
    wanted = requests.select(request_col, "track_uri").distinct()
    return wanted.join(catalog, "track_uri").select(request_col, *schemas.CATALOG_COLUMNS)


def catalog_by_id(inter: DataFrame, id_col: str = "track_uri_index") -> DataFrame:
    """Exactly one catalog row per id: the smallest (name, artist, album, uri)."""
    best = F.min(F.struct(*_NAME_FIELDS, "track_uri")).alias("_t")
    return (inter.where(F.col(id_col).isNotNull())
            .groupBy(id_col).agg(best)
            .select(id_col, "_t.track_name", "_t.artist_name", "_t.album_name", "_t.track_uri"))


def with_text(catalog: DataFrame, out_col: str = "text") -> DataFrame:
    return catalog.withColumn(out_col, track_text())


def register_catalog(catalog: DataFrame, name: str = "tracks") -> str:
    """Expose the catalog as a temp view for SQL clients of the catalog queries."""
    catalog.createOrReplaceTempView(name)
    return name


def catalog_page_sql(spark: SparkSession, offset: int = 0, size: int = PAGE_SIZE,
                     view: str = "tracks") -> DataFrame:
    """The page query in SQL over the registered view (offset/size as literals
    of a parameterised statement)."""
    return spark.sql(
        f"SELECT * FROM {view} ORDER BY track_uri, track_name, artist_name, album_name "
        "LIMIT :size OFFSET :offset", args={"size": size, "offset": offset})
