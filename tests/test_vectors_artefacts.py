"""Pivot matrix (A6, X3, P8, M6), arrays vs vectors, reuse-or-build artefacts (S11),
empty guard (F11), SQL view over the catalog (S8)."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from mixtape.operators import catalog as cat
from mixtape.operators import vectors as vec
from mixtape.session import scratch_path
from mixtape.sources import artefacts


def _ui(spark):
    rows = [(1, 1), (1, 3), (2, 2), (3, 1), (3, 2), (3, 3)]
    return spark.createDataFrame([(u, i, 1) for u, i in rows],
                                 "playlist_id bigint, track_uri_index int, rating int")


def test_pivot_equals_densified_sparse_vectors(spark):
    ui = _ui(spark)
    wide = vec.pivot_matrix(ui)
    assert wide.columns == ["playlist_id", "1", "2", "3", "features"]
    dense = {r.playlist_id: r.f for r in wide.select("playlist_id", vector_to_array("features").alias("f")).collect()}
    sparse = {r.playlist_id: r.f[1:] for r in vec.sparse_vectors(ui, 4).select(
        "playlist_id", vector_to_array("features").alias("f")).collect()}
    assert dense == sparse


def test_pivot_to_the_columns_of_another_matrix(spark):
    small = spark.createDataFrame([(9, 2, 1), (9, 2, 3), (8, 7, 1)], "playlist_id bigint, track_uri_index int, rating int")
    out = vec.pivot_matrix(small, [1, 2, 3, 4])
    assert out.columns == ["playlist_id", "1", "2", "3", "4", "features"]
    rows = {r.playlist_id: (r["1"], r["2"], r["3"], r["4"]) for r in out.collect()}
    assert rows == {9: (0, 3, 0, 0), 8: (0, 0, 0, 0)}


def test_pivot_values_follow_the_engines_limit(spark):
    many = spark.range(50).select(F.lit(1).cast("bigint").alias("playlist_id"),
                                  F.col("id").cast("int").alias("track_uri_index"), F.lit(1).alias("rating"))
    assert len(vec.pivot_matrix(many, assemble=False).columns) == 51
    old = spark.conf.get("spark.sql.pivotMaxValues")
    try:
        spark.conf.set("spark.sql.pivotMaxValues", 10)
        with pytest.raises(ValueError):
            vec.pivot_matrix(many)
        assert len(vec.pivot_matrix(many, list(range(50)), assemble=False).columns) == 51
    finally:
        spark.conf.set("spark.sql.pivotMaxValues", old)


def test_summary_of_dense_and_sparse_vectors(spark):
    from pyspark.ml.linalg import Vectors
    rows = [(1, Vectors.dense([0.0, 2.0, 0.0, 1.0, 0.0])), (2, Vectors.dense([0.0] * 5)), (3, Vectors.sparse(9, [4], [3.0]))]
    df = spark.createDataFrame(rows, ["k", "v"]).select("k", vec.vector_summary("v").alias("s"))
    got = {r.k: tuple(r.s) for r in df.collect()}
    assert got == {1: (2, 1, 3, 4, 3.0, 5), 2: (0, None, None, 0, 0.0, 5), 3: (1, 4, 4, 4, 3.0, 9)}


def test_arrays_and_out_of_range(spark):
    ui = _ui(spark)
    arr = {r.playlist_id: (list(r.indices), list(r.values)) for r in vec.user_item_arrays(ui).collect()}
    assert arr[3] == ([1, 2, 3], [1.0, 1.0, 1.0])
    assert vec.out_of_range(ui, 3).count() == 2


def _build(spark, calls, n=5):
    def build():
        calls.append(1)
        return spark.range(n).withColumnRenamed("id", "x")
    return build


def _values(df):
    return sorted(r.x for r in df.collect())


def test_load_or_build_reuses(spark):
    path, calls = scratch_path(spark, "t-artefact"), []
    first = artefacts.load_or_build_frame(spark, path, _build(spark, calls))
    again = artefacts.load_or_build_frame(spark, path, _build(spark, calls))
    assert _values(first) == _values(again) == list(range(5))
    assert len(calls) == 1
    assert artefacts.path_exists(spark, path) and not artefacts.path_exists(spark, path + "-nope")


def test_half_written_folder_is_rebuilt(spark):
    """A build that fails while or after writing leaves no version."""
    path, calls = scratch_path(spark, "t-artefact"), []

    def broken(df, folder):
        df.write.parquet(folder)
        raise OSError("disk full")

    with pytest.raises(OSError):
        artefacts.load_or_build(spark, path, _build(spark, calls), broken, spark.read.parquet)
    assert artefacts.path_exists(spark, path) and artefacts.current(spark, path) is None
    assert _values(artefacts.load_or_build_frame(spark, path, _build(spark, calls))) == list(range(5))
    assert len(calls) == 2


def test_changed_inputs_are_not_reused(spark):
    source, path, calls = scratch_path(spark, "t-source"), scratch_path(spark, "t-artefact"), []
    spark.range(3).write.parquet(source)

    def made_from(**parameters):
        return artefacts.fingerprint(spark.read.parquet(source), **parameters)

    one = made_from(k=5)
    assert one == made_from(k=5) != made_from(k=6)
    for mark in (one, one, made_from(k=6), made_from(k=6)):
        artefacts.load_or_build_frame(spark, path, _build(spark, calls), made_from=mark)
    assert len(calls) == 2
    spark.range(4).write.mode("append").parquet(source)
    assert made_from(k=6) != made_from(k=5) != one
    artefacts.load_or_build_frame(spark, path, _build(spark, calls), made_from=made_from(k=6))
    assert len(calls) == 3 and [v["version"] for v in artefacts.versions(spark, path)] == [1, 2, 3]


def test_reader_keeps_its_version(spark):
    path, calls = scratch_path(spark, "t-artefact"), []
    old = artefacts.load_or_build_frame(spark, path, _build(spark, calls, 3))
    new = artefacts.load_or_build_frame(spark, path, _build(spark, calls, 7), reuse=False)
    assert _values(old) == list(range(3)) and _values(new) == list(range(7))
    assert _values(artefacts.load_or_build_frame(spark, path, _build(spark, calls, 9))) == list(range(7))
    gone = artefacts.release(spark, path)
    assert len(gone) == 1 and _values(artefacts.load_or_build_frame(spark, path, _build(spark, calls, 9))) == list(range(7))


def test_second_publisher_uses_the_first(spark):
    path, calls = scratch_path(spark, "t-artefact"), []

    def build():
        if not calls:
            calls.append("outer")
            artefacts.load_or_build_frame(spark, path, _build(spark, calls, 2))
        return spark.range(8).withColumnRenamed("id", "x")

    assert _values(artefacts.load_or_build_frame(spark, path, build)) == [0, 1]
    assert len(artefacts.versions(spark, path)) == 1


def test_publish_once(spark):
    path = scratch_path(spark, "t-records") + "/1.json"
    assert artefacts.publish(spark, path, {"a": 1}) and not artefacts.publish(spark, path, {"a": 2})
    assert artefacts.records(spark, path.rsplit("/", 1)[0]) == [{"a": 1}]


def test_empty_guard_and_sql_view(spark):
    c = spark.createDataFrame([("b", "x", "y", "u:2"), ("a", "x", "y", "u:1")],
                              "track_name string, artist_name string, album_name string, track_uri string")
    assert c.where("track_name = 'zzz'").isEmpty()
    cat.register_catalog(c, "t_tracks")
    assert [r.track_uri for r in cat.catalog_page_sql(spark, 1, 1, view="t_tracks").collect()] == ["u:2"]
