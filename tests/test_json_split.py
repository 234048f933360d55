"""Documents read in byte ranges against the whole-document reader."""

import json
import os
import random

import pytest

from mixtape.session import scratch_path
from mixtape.sources import json_slices, json_split

NAMES = ["plain", 'quo"te', "br}ace", "{open", "back\\slash", 'mix\\"}{][', "nul\u0000", "é日😀", "", '"', "}}}", '\\', '"playlists": [', "],}"]


def folder(spark, documents):
    path = scratch_path(spark, "t-json").removeprefix("file:")
    os.makedirs(path)
    for i, text in enumerate(documents):
        with open(f"{path}/slice.{i}.json", "w", encoding="utf-8") as f:
            f.write(text)
    return path


def document(seed, playlists, tracks=6, **dump):
    rnd = random.Random(seed)

    def track(i):
        out = {"pos": i, "track_uri": f"u:{rnd.randrange(50)}", "track_name": rnd.choice(NAMES),
               "artist_name": rnd.choice(NAMES), "album_name": rnd.choice(NAMES)}
        if rnd.random() < 0.2:
            out["extra"] = {"a": [{"b": rnd.choice(NAMES)}], "c": {}}
        if rnd.random() < 0.1:
            del out["artist_name"]
        items = list(out.items())
        rnd.shuffle(items)
        return dict(items)

    def playlist(i):
        items = [("name", rnd.choice(NAMES)), ("pid", i), ("tracks", [track(j) for j in range(rnd.randrange(tracks))]),
                 ("owners", [{"tracks": 1}, {"x": "}"}]), ("none", None)]
        rnd.shuffle(items)
        return dict(items)

    root = [("info", {"version": "v}1", "playlists": [{"pid": -1, "tracks": [{"track_uri": "no"}]}], "o": {"p": {}}}),
            ("others", [{"pid": -2, "tracks": [{"track_uri": "no"}]}, {}]), ("playlists", [playlist(i) for i in range(playlists)]),
            ("note", rnd.choice(NAMES)), ("more", [[{"pid": -3, "tracks": [{"track_uri": "no"}]}]])]
    rnd.shuffle(root)
    return json.dumps(dict(root), **dump)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def expected(documents):
    """By Python's reader; the fields of the model only."""
    out = []
    for text in documents:
        for p in json.loads(text)["playlists"]:
            out += [(p["pid"], *(t.get(f) for f in ("track_uri", "track_name", "artist_name", "album_name"))) for t in p["tracks"]]
    return sorted(out, key=str)


@pytest.fixture(params=[700, 5000])
def range_bytes(spark, request):
    keys = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "0"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield request.param
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("dump", [{}, {"indent": 1, "separators": ("\n,\t", "  :\r\n ")}, {"ensure_ascii": False, "separators": (",", ":")}])
def test_any_layout(spark, range_bytes, dump):
    documents = [document(seed, 40, **dump) for seed in range(2)] + ['{"playlists": []}', '{"playlists":[{"pid":7,"tracks":[]}]}\n\n']
    path = folder(spark, documents)
    assert rows(json_split.flatten_documents(spark, path)) == expected(documents)
    starts = json_split.ranges(spark, path).collect()
    if range_bytes < 5000:
        assert len(starts) > 2 * len(documents)
        assert any(r.inside for r in json_split.ranges(spark, path).collect()) or len(starts) < 20


def test_same_as_the_document_reader(spark, range_bytes):
    documents = [document(9, 30)]
    path = folder(spark, documents)
    whole = json_slices.flatten_slices(json_slices.read_slices(spark, path))
    assert rows(json_split.flatten_documents(spark, path)) == rows(whole)
    split = json_split.flatten_documents(spark, f"{path}/*.json")
    assert rows(split) == rows(whole)


def test_a_playlist_longer_than_ranges(spark, range_bytes):
    documents = [document(3, 3, tracks=400)]
    path = folder(spark, documents)
    assert rows(json_split.flatten_documents(spark, path, recursive=True)) == expected(documents)


def test_one_document_is_several_tasks(spark):
    table = spark.range(3000).selectExpr("id % 100 as playlist_id", "concat('u:', id) as track_uri", "'a}\"b' as track_name",
                                         "'b' as artist_name", "cast(null as string) as album_name")
    path = json_split.write_document(table, scratch_path(spark, "t-document"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        text = spark.read.text(path)
        assert len(text.inputFiles()) == 1
        assert json_split._text(spark, path, False).rdd.getNumPartitions() >= 4
        assert rows(json_split.flatten_documents(spark, path)) == rows(table)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)


def test_written_document_passes_lines_on(spark, monkeypatch):
    """A playlist without id lies between commas like any other; the lines are stored by many tasks
    before the one that writes the document."""
    table = spark.createDataFrame([(p, f"u:{p}", "n", "a", "b") for p in (None, 1, 2, 3)],
                                  "playlist_id long, track_uri string, track_name string, artist_name string, album_name string")
    stored, plain = [], json_split.stage
    monkeypatch.setattr(json_split, "stage", lambda df, name: stored.append(name) or plain(df, name))
    path = json_split.write_document(table, scratch_path(spark, "t-null")).removeprefix("file:")
    assert stored == ["document-lines"]
    [file] = [f for f in os.listdir(path) if f.startswith("part-")]
    with open(f"{path}/{file}", encoding="utf-8") as f:
        found = json.load(f)
    assert sorted(str(p.get("pid")) for p in found["playlists"]) == ["1", "2", "3", "None"]
    empty = json_split.write_document(table.limit(0), scratch_path(spark, "t-empty"))
    assert rows(json_split.flatten_documents(spark, empty)) == []
