"""Display text rows and comma-separated URI lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Fixed values of the display format: separator between fields of a text row,
# separator of a URI list, and the text printed for a missing field.
FIELD_SEPARATOR = ", "
LIST_SEPARATOR = ","
NULL_TEXT = "None"

TEXT_FIELDS = ("track_name", "artist_name", "album_name", "track_uri")


def track_text(*cols: str) -> Column:
    """"name, artist, album, uri" with missing fields printed as ``None``."""
    fields = cols or TEXT_FIELDS
    return F.concat_ws(FIELD_SEPARATOR, *[F.coalesce(F.col(c), F.lit(NULL_TEXT)) for c in fields])


def parse_track_text(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Text row -> 4 fields. The URI is taken after the last separator, album and
    artist before it, and the name is everything left (so a ", " inside a name
    survives). ``n_parts`` != 4 flags rows that did not have exactly 4 fields."""
    parts = F.split(F.col(text_col), FIELD_SEPARATOR, -1)
    n = F.size(parts)
    return (df.withColumn("_parts", parts)
              .select("*",
                      F.array_join(F.slice("_parts", 1, F.greatest(n - 3, F.lit(1))),
                                   FIELD_SEPARATOR).alias("track_name"),
                      F.when(n >= 4, F.element_at("_parts", -3)).alias("artist_name"),
                      F.when(n >= 3, F.element_at("_parts", -2)).alias("album_name"),
                      F.when(n >= 2, F.element_at("_parts", -1)).alias("track_uri"),
                      n.alias("n_parts"))
              .drop("_parts"))


def uri_list(col: str | Column) -> Column:
    """Array of URIs -> one comma-separated string."""
    return F.array_join(F.col(col) if isinstance(col, str) else col, LIST_SEPARATOR)


def explode_uri_list(df: DataFrame, list_col: str = "uri_list",
                     out_col: str = "track_uri") -> DataFrame:
    """Comma list -> one row per URI with its 0-based position; blanks dropped."""
    exploded = df.select(*[c for c in df.columns if c != list_col],
                         F.posexplode(F.split(F.col(list_col), LIST_SEPARATOR, -1))
                          .alias("pos", "_uri"))
    return (exploded.withColumn(out_col, F.trim("_uri")).drop("_uri")
                    .where(F.col(out_col) != ""))
