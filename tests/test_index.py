"""Dense id dictionary: order, extension, nulls, types, persistence."""

import random
import string

from pyspark.sql import Window, functions as F

from mixtape.operators import index as idx
from mixtape.session import scratch_path


def _keys(spark, keys, col="track_uri"):
    return spark.createDataFrame([(k,) for k in keys], f"{col} string")


def test_dense_ids_equal_global_window(spark):
    rnd = random.Random(3)
    keys = ["".join(rnd.choice(string.ascii_letters + ":/0123456789") for _ in range(rnd.randint(1, 12)))
            for _ in range(3000)]
    df = _keys(spark, keys + keys[:500])
    built = {r.track: r.id for r in idx.build_index(df, num_partitions=7).collect()}
    expected = (df.select(F.col("track_uri").alias("track")).distinct()
                .select("track", F.row_number().over(Window.orderBy("track")).alias("id")))
    assert built == {r.track: r.id for r in expected.collect()}
    assert sorted(built.values()) == list(range(1, len(set(keys)) + 1))


def test_extend_keeps_ids_and_appends_in_order(spark):
    first = idx.build_index(_keys(spark, ["b", "d", "a"]))
    grown = idx.extend_index(first, _keys(spark, ["c", "a", "e", "c"]))
    got = {r.track: r.id for r in grown.collect()}
    assert got == {"a": 1, "b": 2, "d": 3, "c": 4, "e": 5}
    assert dict(grown.dtypes)["id"] == "int"          # Q5: no widening to bigint


def test_extend_empty_index_and_null_keys(spark):
    empty = idx.empty_index(spark)
    assert idx.max_id(empty) == 0                      # Q6: max of empty is 0, not null
    grown = idx.extend_index(empty, _keys(spark, ["x", None, "y", None]))
    assert sorted((r.track, r.id) for r in grown.collect()) == [("x", 1), ("y", 2)]  # Q2
    again = idx.extend_index(grown, _keys(spark, [None, "x"]))
    assert again.count() == 2


def test_roundtrip_and_enforced_schema(spark):
    built = idx.build_index(_keys(spark, ["it's", "a", "b,c"]))
    path = scratch_path(spark, "test-index")
    idx.save_index(built, path)
    loaded = idx.load_index(spark, path)
    assert dict(loaded.dtypes) == {"track": "string", "id": "int"}
    assert sorted(loaded.collect()) == sorted(built.collect())
    # quote in a key: column expressions, no SQL text (Q7)
    hit = idx.encode(_keys(spark, ["it's", "zzz"]), loaded).collect()
    assert {r.track_uri: r.track_uri_index for r in hit} == {"it's": 3, "zzz": None}


def test_encode_decode_identity(spark):
    keys = [f"part:{i}" for i in range(50)]
    built = idx.build_index(_keys(spark, keys))
    enc = idx.encode(_keys(spark, keys), built)
    dec = idx.decode(enc, built, "track_uri_index", "back")
    assert all(r.back == r.track_uri for r in dec.collect())
    flags = {r.track: r.is_new for r in idx.is_new_key(built, _keys(spark, ["part:1", "nope"], "track")).collect()}
    assert flags == {"part:1": False, "nope": True}
