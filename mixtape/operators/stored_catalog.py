"""The catalog as a stored, ordered table with two indexes: pages by position, rows by substring.

Rows lie in catalog order (URI, then names) in parts of about ``PART_ROWS`` rows, one
file a part. A manifest holds the number of rows before each part, so a page at
any offset reads the parts that it touches and nothing before them (two files at
most while a page is no larger than a part).

A posting table holds, for every three consecutive characters of a name field
(lower case), the rows that have them. A substring of three characters or more
can only be in rows that have all of its own; the postings of its rarest ones
give the rows to fetch, by part, and only these are tested. Shorter terms and
regular expressions scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from mixtape import schemas
from mixtape.functions.predicates import all_of, contains_ci
from mixtape.operators.catalog import PAGE_SIZE
from mixtape.operators.search import FIELDS, track_name_like, track_search, track_search_contains
from mixtape.session import shuffle_partitions, stage

PART_ROWS = 100_000
GRAM = 3
#: Postings that are intersected for a term: its rarest.
GRAMS_USED = 4

_ORDER = ("track_uri", "track_name", "artist_name", "album_name")


@dataclass
class StoredCatalog:
    """An opened stored catalog. ``rows`` has the catalog columns, ``row`` (position from 0) and ``part``."""
    rows: DataFrame
    manifest: DataFrame         # (part, first_row, n_rows)
    grams: DataFrame            # (field, gram, row, part), by gram
    counts: DataFrame           # (field, gram, n)

    @property
    def catalog(self) -> DataFrame:
        return self.rows.select(*schemas.CATALOG_COLUMNS)


def write(catalog: DataFrame, path: str, part_rows: int = PART_ROWS) -> str:
    """Stores distinct catalog rows in order, with their manifest and postings."""
    spark = catalog.sparkSession
    parts = max(1, -(-catalog.count() // part_rows))
    # a range holds many parts: its bounds are drawn from rows that the driver samples, a number for each range
    ranges = min(parts, shuffle_partitions(spark))
    ordered = stage(catalog.select(*schemas.CATALOG_COLUMNS).repartitionByRange(ranges, *_ORDER).sortWithinPartitions(*_ORDER)
                    .withColumn("_id", F.monotonically_increasing_id())
                    .withColumn("_at", F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)))
                    .withColumn("_range", F.shiftright("_id", 33)).drop("_id"), "catalog-ranges")
    sizes = ordered.groupBy("_range").agg(F.count(F.lit(1)).alias("_s"))
    # the last part of a range takes what is left over: no part is short unless its range is
    number = F.least(F.floor(F.col("_at") / part_rows), F.greatest(F.floor(F.col("_s") / part_rows) - 1, F.lit(0)))
    placed = (ordered.join(F.broadcast(sizes), "_range").withColumn("_n", number)
              .withColumn("place", F.col("_at") - F.col("_n") * part_rows)
              .withColumn("part", F.col("_range") * (1 << 33) + F.col("_n"))
              .select(*schemas.CATALOG_COLUMNS, "place", "part").repartition("part"))
    placed.write.partitionBy("part").parquet(f"{path}/rows")
    # one row per part
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = _rows(spark, path).groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"))
    (counts.withColumn("first_row", F.coalesce(F.sum("n_rows").over(before), F.lit(0))).select("part", "first_row", "n_rows")
     .coalesce(1).write.parquet(f"{path}/manifest"))
    numbered = _numbered(spark, path)
    grams = numbered.select("row", "part", F.explode(F.array(*[
        F.struct(F.lit(f).alias("field"), F.lower(f).alias("text")) for f in FIELDS])).alias("_f"))
    grams = grams.select(F.col("_f.field").alias("field"), F.explode(_grams(F.col("_f.text"))).alias("gram"), "row", "part")
    grams.repartitionByRange("gram", "field", "row").sortWithinPartitions("gram", "field", "row").write.parquet(f"{path}/grams")
    (spark.read.parquet(f"{path}/grams").groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n"))
     .repartitionByRange("gram").sortWithinPartitions("gram").write.parquet(f"{path}/gram-counts"))
    return path


def read(spark: SparkSession, path: str) -> StoredCatalog:
    return StoredCatalog(_numbered(spark, path), spark.read.parquet(f"{path}/manifest"),
                         spark.read.parquet(f"{path}/grams"), spark.read.parquet(f"{path}/gram-counts"))


def _rows(spark: SparkSession, path: str) -> DataFrame:
    kinds = ", ".join(f"{f.name} string" for f in schemas.CATALOG)
    return spark.read.schema(f"{kinds}, place long, part long").parquet(f"{path}/rows")


def _numbered(spark: SparkSession, path: str) -> DataFrame:
    manifest = spark.read.parquet(f"{path}/manifest").select("part", "first_row")
    return (_rows(spark, path).join(F.broadcast(manifest), "part")
            .select(*schemas.CATALOG_COLUMNS, (F.col("first_row") + F.col("place")).alias("row"), "part"))


def _grams(text: Column) -> Column:
    """The distinct runs of three characters; none in shorter (or null) texts."""
    n = F.length(text) - (GRAM - 1)
    return F.when(n >= 1, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.substr(text, i, F.lit(GRAM))))) \
        .otherwise(F.array().cast("array<string>"))


# --- pages -------------------------------------------------------------------------

def page(stored: StoredCatalog, offset: int = 0, size: int = PAGE_SIZE) -> DataFrame:
    """One page in catalog order, from the parts that it touches."""
    last = offset + size
    touched = stored.manifest.where((F.col("first_row") < last) & (F.col("first_row") + F.col("n_rows") > offset))
    parts = [r["part"] for r in touched.select("part").collect()]       # two, unless pages are larger than parts
    if not parts:
        return stored.catalog.limit(0)
    rows = stored.rows.where(F.col("part").isin(parts) & (F.col("row") >= offset) & (F.col("row") < last))
    return rows.orderBy("row").limit(size).select(*schemas.CATALOG_COLUMNS)


# --- substrings ----------------------------------------------------------------------

def _indexable(terms: dict[str, str]) -> dict[str, list[str]]:
    """Per field the runs of three characters of its term, lowered as the exact test does."""
    low = {f: t.lower() for f, t in terms.items() if t}
    return {f: sorted({t[i:i + GRAM] for i in range(len(t) - GRAM + 1)}) for f, t in low.items() if len(t) >= GRAM}


def candidates(stored: StoredCatalog, terms: dict[str, str]) -> DataFrame | None:
    """(row, part) of the rows that have the rarest runs of all terms; None if no term has any."""
    wanted = _indexable(terms)
    if not wanted:
        return None
    keys = F.lit(False)
    for field, grams in wanted.items():
        keys = keys | ((F.col("field") == field) & F.col("gram").isin(grams))
    # at most one row per run of the terms
    counts = {(r["field"], r["gram"]): r["n"] for r in stored.counts.where(keys).collect()}
    chosen = []
    for field, grams in wanted.items():
        if any((field, g) not in counts for g in grams):
            return stored.grams.select("row", "part").limit(0)
        chosen += [(field, g) for g in sorted(grams, key=lambda g: (counts[field, g], g))[:GRAMS_USED]]
    keys = F.lit(False)
    for field, gram in chosen:
        keys = keys | ((F.col("field") == field) & (F.col("gram") == gram))
    return (stored.grams.where(keys).groupBy("row", "part").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == len(chosen)).select("row", "part"))


def narrowed(stored: StoredCatalog, terms: dict[str, str]) -> DataFrame:
    """The catalog rows that have to be tested for the terms: all of them if no term is long enough."""
    found = candidates(stored, terms)
    rows = stored.rows if found is None else stored.rows.join(found, ["part", "row"], "left_semi")
    return rows.select(*schemas.CATALOG_COLUMNS)


def name_like(stored: StoredCatalog, text: str) -> DataFrame:
    """``search.track_name_like`` on the narrowed rows."""
    return track_name_like(narrowed(stored, {"track_name": text}), text)


def search(stored: StoredCatalog, track_name: str = "", artist_name: str = "", album_name: str = "", regex: bool = False) -> DataFrame:
    """``search.track_search`` on the narrowed rows; a regular expression scans."""
    terms = dict(zip(FIELDS, (track_name, artist_name, album_name)))
    rows = stored.catalog if regex else narrowed(stored, terms)
    return track_search(rows, track_name, artist_name, album_name, regex)


def search_contains(stored: StoredCatalog, track_name: str = "", artist_name: str = "", album_name: str = "",
                    regex: bool = False) -> DataFrame:
    """``search.track_search_contains`` on the narrowed rows; a regular expression scans."""
    terms = dict(zip(FIELDS, (track_name, artist_name, album_name)))
    rows = stored.catalog if regex else narrowed(stored, terms)
    return track_search_contains(rows, track_name, artist_name, album_name, regex)


def search_tiered(hot: DataFrame, stored: StoredCatalog, track_name: str = "", artist_name: str = "", album_name: str = "") -> DataFrame:
    """``search.track_search_tiered`` with the stored catalog as second tier."""
    first = track_search_contains(hot, track_name, artist_name, album_name)
    return first if not first.isEmpty() else search(stored, track_name, artist_name, album_name)


def report(stored: StoredCatalog, terms: dict[str, str]) -> DataFrame:
    """(n_rows, n_tested, n_found) of one conjunctive search: rows of the catalog, rows that the
    postings left to test, rows found."""
    tested = narrowed(stored, terms)
    preds = [contains_ci(f, t) for f, t in terms.items() if t]
    hit = F.coalesce(all_of(preds), F.lit(False)) if preds else F.lit(False)
    counted = tested.agg(F.count(F.lit(1)).alias("n_tested"), F.count(F.when(hit, 1)).alias("n_found"))
    both = (stored.manifest.select("n_rows", F.lit(0).alias("n_tested"), F.lit(0).alias("n_found"))
            .unionByName(counted.withColumn("n_rows", F.lit(0))))
    return both.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", "n_tested", "n_found")])
