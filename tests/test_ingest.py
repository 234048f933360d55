"""Nested JSON slices, flatten, interactions, audits."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from mixtape.operators import interactions as inter
from mixtape.operators import vectors as vec
from mixtape.sources import json_slices


def _write(docs):
    root = tempfile.mkdtemp(prefix="slices-")
    for i, doc in enumerate(docs):
        sub = os.path.join(root, f"sub{i % 2}")
        os.makedirs(sub, exist_ok=True)
        with open(os.path.join(sub, f"playlists.slice.{i}.json"), "w") as fh:
            json.dump(doc, fh, indent=2)   # multi-line documents
    return root


def _t(uri, name="n", artist="a", album="b"):
    return {"track_uri": uri, "track_name": name, "artist_name": artist, "album_name": album,
            "duration_ms": 1}


DOCS = [
    {"info": {"x": 1}, "playlists": [
        {"pid": 1, "name": "p1", "tracks": [_t("u:1"), _t("u:2"), _t("u:1"), _t("u:1")]},
        {"pid": 2, "tracks": []},                 # empty array: dropped
        {"pid": 3},                               # missing tracks: dropped
        {"pid": 4, "tracks": [_t("u:2", name="Hello, Goodbye"), _t("u:2", name="hello, goodbye")]},
    ]},
    {"playlists": []},                            # empty file: nothing
    {"playlists": [{"pid": 5, "tracks": [_t(None), _t("u:3")]}]},   # null key
]


def test_flatten_glob_and_recursive(spark):
    root = _write(DOCS)
    flat = json_slices.flatten_slices(json_slices.read_slices(spark, root, recursive=True))
    glob = json_slices.flatten_slices(json_slices.read_slices(spark, f"{root}/*/playlists.slice.*.json"))
    rows = sorted(flat.collect(), key=str)
    assert rows == sorted(glob.collect(), key=str)
    assert sorted({r.playlist_id for r in rows}) == [1, 4, 5]
    assert len(rows) == 4 + 2 + 2


def test_ingest_interactions_and_audits(spark):
    root = _write(DOCS)
    flat = json_slices.flatten_slices(json_slices.read_slices(spark, root, recursive=True))
    ui, index = inter.ingest(flat)
    assert sorted((r.track, r.id) for r in index.collect()) == [("u:1", 1), ("u:2", 2), ("u:3", 3)]
    rows = ui.collect()
    # distinct over all columns keeps the two spellings (Q4) and the null key row
    assert len([r for r in rows if r.playlist_id == 4]) == 2
    assert [r.track_uri_index for r in rows if r.track_uri is None] == [None]
    pairs = inter.user_items(ui)
    assert pairs.where("playlist_id = 4").count() == 1
    # audits over the raw rows with ids
    raw = idx_encode(flat, index)
    assert [tuple(r) for r in inter.dup_audit(raw, threshold=2).collect()] == [(1, 1, 3)]
    strict = sorted(tuple(r) for r in inter.dup_audit(raw, threshold=1).collect())
    assert strict == [(1, 1, 3), (4, 2, 2)]
    # vectors from the de-duplicated pairs never repeat an index (Q3, Q4)
    v = {r.playlist_id: r.features for r in vec.sparse_vectors(pairs, 4).collect()}
    assert list(v[1].indices) == [1, 2] and list(v[4].indices) == [2] and list(v[5].indices) == [3]


def idx_encode(rows, index):
    from mixtape.operators import index as idx
    return idx.encode(rows, index)


def test_write_slices_roundtrip(spark):
    rows = spark.createDataFrame(
        [(7, "u:1", "a", "b", "c"), (7, "u:2", "a", "b", "c"), (9, "u:1", "a", "b", "c")],
        "playlist_id bigint, track_uri string, track_name string, artist_name string, album_name string")
    from mixtape.session import scratch_path
    path = json_slices.write_slices(rows, scratch_path(spark, "t-slices"), playlists_per_slice=1)
    back = json_slices.flatten_slices(json_slices.read_slices(spark, path, recursive=True))
    assert sorted(back.collect()) == sorted(rows.collect())
    # a big playlist is split over several bounded entries and documents
    big = spark.range(50).selectExpr("7L as playlist_id", "concat('u:', id % 20) as track_uri",
                                     "'a' as track_name", "'b' as artist_name", "'c' as album_name")
    path = json_slices.write_slices(big, scratch_path(spark, "t-slices-big"), tracks_per_entry=8)
    docs = json_slices.read_slices(spark, path, recursive=True)
    sizes = [len(p.tracks) for d in docs.collect() for p in d.playlists]
    assert len(sizes) > 1 and sum(sizes) == 50
    back = json_slices.flatten_slices(json_slices.read_slices(spark, f"{path}/{json_slices.WRITTEN_GLOB}"))
    assert sorted(back.collect()) == sorted(big.collect())


def test_split_known_new_and_baskets(spark):
    existing = spark.createDataFrame([(1, "u:1"), (2, "u:2")], "playlist_id bigint, track_uri string")
    baskets = spark.createDataFrame([(1, "u:9"), (3, "u:1"), (3, "u:2")], "basket_id bigint, track_uri string")
    got = {r.basket_id: r.is_known for r in inter.split_known_new(baskets, existing).collect()}
    assert got == {1: True, 3: False}
    catalog = spark.createDataFrame([("n1", "a", "b", "u:1"), ("n2", "a", "b", "u:2")],
                                    "track_name string, artist_name string, album_name string, track_uri string")
    index = spark.createDataFrame([("u:1", 1)], "track string, id int")
    rows = inter.basket_interactions(baskets, catalog, index).collect()
    assert sorted((r.basket_id, r.track_uri, r.track_uri_index) for r in rows) == [
        (3, "u:1", 1), (3, "u:2", None)]          # unknown catalog URI u:9 drops out
    assert F  # keep import used


def test_repeats_of_one_track_are_written_in_several_entries(spark):
    rows = spark.range(200).select(F.lit(1).cast("bigint").alias("playlist_id"), F.lit("u:1").alias("track_uri"),
                                   F.lit("a").alias("track_name"), F.lit("b").alias("artist_name"),
                                   F.lit("c").alias("album_name"))
    from mixtape.session import scratch_path
    path = json_slices.write_slices(rows, scratch_path(spark, "t-slices-repeats"), tracks_per_entry=8)
    slices = json_slices.read_slices(spark, path, recursive=True)
    sizes = [r[0] for r in slices.select(F.explode("playlists").alias("p")).select(F.size("p.tracks")).collect()]
    assert sum(sizes) == 200 and max(sizes) <= 32
    assert json_slices.flatten_slices(slices).count() == 200


def test_chunks_come_from_stored_row_ids(spark, monkeypatch):
    from mixtape.session import scratch_path
    stored = []

    def stage(df, name):
        stored.append(real(df, name))
        return stored[-1]

    real = getattr(json_slices, "stage", None)
    monkeypatch.setattr(json_slices, "stage", stage, raising=False)
    rows = spark.range(50).select(F.lit(1).cast("bigint").alias("playlist_id"), F.lit("u:1").alias("track_uri"),
                                  F.lit("a").alias("track_name"), F.lit("b").alias("artist_name"),
                                  F.lit("c").alias("album_name"))
    path = json_slices.write_slices(rows, scratch_path(spark, "t-slices-stored"), tracks_per_entry=8)
    assert len(stored) == 1 and stored[0].select("_row").distinct().count() == 50
    assert json_slices.flatten_slices(json_slices.read_slices(spark, path, recursive=True)).count() == 50
