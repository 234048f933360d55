"""Per-(session, data folder) artefacts shared by the registered queries.

Only artefacts that are costly and deterministic to rebuild are memoised: the
stored dictionaries, rows, catalog and vectors, and fitted models.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from mixtape.operators import catalog as cat
from mixtape.operators import dictionary
from mixtape.operators import factors as fac
from mixtape.operators import index as idx
from mixtape.operators import interactions as inter
from mixtape.operators import neighbors as nb
from mixtape.operators import stored_catalog
from mixtape.operators import vectors as vec
from mixtape.session import scratch_path, stage
from mixtape.sources import testview as tv

_CONTEXTS: dict[tuple[str, str], "Context"] = {}

ALS_SEED = 42
CATALOG_PART_ROWS = 350
LSH_SEED = 7


def _pairs(uris: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct (playlist, id): a URI has one id, so distinct URIs of a playlist give distinct pairs."""
    return inter.user_items(inter.interactions(uris, index, rows_distinct=True), pairs_distinct=True)


class Context:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    # whole data -----------------------------------------------------------
    @cached_property
    def rows(self) -> DataFrame:
        return tv.playlist_tracks(self.spark, self.sf_dir)

    @cached_property
    def distinct_rows(self) -> DataFrame:
        """Distinct playlist-track rows, stored once (lines are read once, for ``uris``)."""
        return stage(tv.with_names(self.spark, self.sf_dir, self.uris), "distinct-rows")

    @cached_property
    def uris(self) -> DataFrame:
        """Distinct (playlist, URI), stored once: what the dictionary and the pairs need of the rows."""
        return stage(tv.distinct_playlist_uris(self.spark, self.sf_dir), "uris")

    @cached_property
    def index(self) -> DataFrame:
        return idx.build_index(self.uris)

    @cached_property
    def interactions(self) -> DataFrame:
        return inter.interactions(self.distinct_rows, self.index, rows_distinct=True)

    @cached_property
    def pairs(self) -> DataFrame:
        """Distinct (playlist, id) pairs, stored once, read by ALS, kNN and the vectoriser. A cached
        frame would keep shuffle-partition many parts in every read and hold memory that ALS needs."""
        return stage(_pairs(self.uris, self.index), "pairs")

    @cached_property
    def catalog(self) -> DataFrame:
        """The catalog, stored once in URI order; lookups, pages and searches read it."""
        path = scratch_path(self.spark, "catalog")
        return cat.read_catalog(self.spark, cat.write_catalog(cat.build_catalog(self.interactions), path))

    @cached_property
    def stored_catalog(self) -> stored_catalog.StoredCatalog:
        """The catalog with its page and substring indexes; parts so small that pages cross them."""
        path = scratch_path(self.spark, "stored-catalog")
        stored_catalog.write(self.catalog, path, part_rows=CATALOG_PART_ROWS)
        return stored_catalog.read(self.spark, path)

    @cached_property
    def vectors(self) -> DataFrame:
        """Sparse 0/1 vectors of all playlists, stored once."""
        return stage(vec.sparse_vectors(self.pairs), "vectors")

    @cached_property
    def lsh(self):
        return nb.fit_lsh(self.vectors, seed=LSH_SEED)

    # first dictionary + extensions ------------------------------------------
    @property
    def new_rows(self) -> DataFrame:
        """Everything after the first dictionary."""
        return tv.playlist_tracks(self.spark, self.sf_dir, since=tv.DICTIONARY_CUTOFFS[0])

    @cached_property
    def dictionary(self) -> tuple[str, list[dictionary.Extension]]:
        """(folder of the stored dictionary, what each of its three extensions did)."""
        root = scratch_path(self.spark, "dictionary")
        first, second = tv.DICTIONARY_CUTOFFS
        batches = [tv.playlist_tracks(self.spark, self.sf_dir, until=first),
                   tv.playlist_tracks(self.spark, self.sf_dir, since=first, until=second),
                   tv.playlist_tracks(self.spark, self.sf_dir, since=second)]
        return root, [dictionary.extend(self.spark, root, rows) for rows in batches]

    # history / incoming split for recommendation ----------------------------
    @property
    def history_rows(self) -> DataFrame:
        return tv.playlist_tracks(self.spark, self.sf_dir, until=tv.HISTORY_CUTOFF)

    @cached_property
    def history_distinct_rows(self) -> DataFrame:
        return stage(tv.with_names(self.spark, self.sf_dir, self.history_uris), "history-rows")

    @cached_property
    def history_uris(self) -> DataFrame:
        return stage(tv.distinct_playlist_uris(self.spark, self.sf_dir, until=tv.HISTORY_CUTOFF), "history-uris")

    @cached_property
    def history_index(self) -> DataFrame:
        return idx.build_index(self.history_uris)

    @cached_property
    def history(self) -> DataFrame:
        return inter.interactions(self.history_distinct_rows, self.history_index, rows_distinct=True)

    @cached_property
    def history_pairs(self) -> DataFrame:
        return stage(_pairs(self.history_uris, self.history_index), "history-pairs")

    @cached_property
    def history_vectors(self) -> DataFrame:
        """Sparse 0/1 vectors of the history playlists, stored once (the
        existing-users matrix that LSH fits and searches)."""
        return stage(vec.sparse_vectors(self.history_pairs), "history_vectors")

    @cached_property
    def history_lsh(self):
        """Random-projection LSH fitted on the stored history vectors."""
        return nb.fit_lsh(self.history_vectors, seed=LSH_SEED)

    @cached_property
    def model(self):
        return fac.fit_als(self.pairs, seed=ALS_SEED)

    @cached_property
    def history_model(self):
        return fac.fit_als(self.history_pairs, seed=ALS_SEED)


def context(spark: SparkSession, sf_dir: str) -> Context:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _CONTEXTS:
        _CONTEXTS[key] = Context(spark, sf_dir)
    return _CONTEXTS[key]
