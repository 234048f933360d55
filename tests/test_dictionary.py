"""The dictionary as a log of versions: ids, snapshots, filters, failed and competing writers."""

import os
import random

import pytest
from pyspark.sql import functions as F

from mixtape.operators import dictionary
from mixtape.operators import index as idx
from mixtape.session import scratch_path
from mixtape.sources import artefacts


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "track_uri string")


def ids(df):
    rows = df.collect()
    assert len({r.track for r in rows}) == len(rows)
    return {r.track: r.id for r in rows}


def local(path):
    return path.removeprefix("file:")


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(local(path)) for f in names if f.endswith(".parquet")}


def test_versions_and_snapshots(spark):
    root = scratch_path(spark, "dictionary")
    assert dictionary.read(spark, root).count() == 0
    first = dictionary.extend(spark, root, keys(spark, ["b", "d", None, "a", "b"]), buckets=3)
    assert (first.version, first.batch, first.added) == (1, 3, 3)
    before = files(f"{root}/rows")
    second = dictionary.extend(spark, root, keys(spark, ["c", "a", "e", None]))
    third = dictionary.extend(spark, root, keys(spark, ["A", "it's", "e"]))
    assert (second.version, second.added, third.version, third.added) == (2, 2, 3, 2)
    want = {"a": 1, "b": 2, "d": 3, "c": 4, "e": 5, "A": 6, "it's": 7}
    assert ids(dictionary.read(spark, root)) == want
    assert ids(dictionary.read(spark, root, version=1)) == {k: v for k, v in want.items() if v <= 3}
    assert ids(dictionary.read(spark, root, version=2)) == {k: v for k, v in want.items() if v <= 5}
    assert {r.track: r.version for r in dictionary.read(spark, root, with_version=True).collect()} == {
        "a": 1, "b": 1, "d": 1, "c": 2, "e": 2, "A": 3, "it's": 3}
    assert dict(dictionary.read(spark, root).dtypes) == {"track": "string", "id": "int"}
    assert sorted(tuple(r) for r in dictionary.versions(spark, root).collect()) == [(1, 3, 1, 3), (2, 2, 4, 5), (3, 2, 6, 7)]
    # nothing that was there has been written again
    after = files(f"{root}/rows")
    assert all(after[f] == t for f, t in before.items()) and len(after) > len(before)


def test_nothing_new(spark):
    root = scratch_path(spark, "dictionary")
    assert dictionary.extend(spark, root, keys(spark, [None])).version == 0
    assert dictionary.log(spark, root) == []
    dictionary.extend(spark, root, keys(spark, ["x", "y"]))
    again = dictionary.extend(spark, root, keys(spark, ["y", None, "x"]))
    assert (again.version, again.batch, again.added, again.skipped) == (1, 2, 0, 0)
    assert len(dictionary.log(spark, root)) == 1


def test_equals_one_dictionary_at_a_time(spark):
    """Three batches, as extend_index does on plain frames."""
    rnd = random.Random(4)
    batches = [[f"k{rnd.randrange(4000)}" for _ in range(2000)] for _ in range(3)]
    root = scratch_path(spark, "dictionary")
    plain = idx.empty_index(spark)
    for batch in batches:
        known = set(ids(plain))
        done = dictionary.extend(spark, root, keys(spark, batch))
        plain = idx.extend_index(plain, keys(spark, batch))
        fresh = set(batch) - known
        assert (done.batch, done.added, done.checked) == (len(set(batch)), len(fresh), done.batch - done.skipped)
        assert done.skipped <= len(fresh)               # a known key is never skipped
        assert done.skipped >= 0.95 * len(fresh)        # and new ones nearly always
    assert ids(dictionary.read(spark, root)) == ids(plain)


def test_filter_never_loses_a_key(spark):
    present = [f"key {i}" for i in range(5000)]
    absent = [f"other {i}" for i in range(5000)]
    own = spark.createDataFrame([(k,) for k in present], "track string")
    blocks = -(-len(present) * dictionary.FILTER_BITS // dictionary.BLOCK_BITS)
    stored = dictionary.build_filter(own, len(present))
    asked = spark.createDataFrame([(k,) for k in present + absent + [None]], "track string")
    got = {r.track: r.hit for r in dictionary._known_by(asked, stored, blocks, "hit").collect()}
    assert all(got[k] for k in present)
    assert sum(got[k] for k in absent) < 0.02 * len(absent)


def test_lookup(spark):
    root = scratch_path(spark, "dictionary")
    asked = spark.createDataFrame([(1, "b"), (2, "zz"), (3, None), (4, "b"), (5, "c")], "n int, track string")
    assert {r.n: r.id for r in dictionary.lookup(spark, root, asked).collect()} == dict.fromkeys(range(1, 6))
    dictionary.extend(spark, root, keys(spark, ["a", "b"]))
    dictionary.extend(spark, root, keys(spark, ["c"]))
    got = dictionary.lookup(spark, root, asked)
    assert got.columns == ["n", "track", "id"]
    assert {r.n: r.id for r in got.collect()} == {1: 2, 2: None, 3: None, 4: 2, 5: 3}
    assert {r.n: r.id for r in dictionary.lookup(spark, root, asked, version=1).collect()} == {1: 2, 2: None, 3: None, 4: 2, 5: None}


def test_failed_writer_leaves_nothing(spark, monkeypatch):
    root = scratch_path(spark, "dictionary")
    dictionary.extend(spark, root, keys(spark, ["a", "b"]))
    with monkeypatch.context() as m:
        m.setattr(artefacts, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            dictionary.extend(spark, root, keys(spark, ["c", "d"]))
    assert ids(dictionary.read(spark, root)) == {"a": 1, "b": 2}     # its rows are there, its record isn't
    dictionary.extend(spark, root, keys(spark, ["d", "e"]))
    assert ids(dictionary.read(spark, root)) == {"a": 1, "b": 2, "d": 3, "e": 4}


def test_second_of_two_writers_compares_again(spark, monkeypatch):
    root = scratch_path(spark, "dictionary")
    dictionary.extend(spark, root, keys(spark, ["a"]))
    publish, other = artefacts.publish, []

    def late(spark_, path, record):
        if not other:       # meanwhile another writer publishes the same number
            other.append(1)
            dictionary.extend(spark, root, keys(spark, ["c", "x"]))
        return publish(spark_, path, record)

    monkeypatch.setattr(artefacts, "publish", late)
    done = dictionary.extend(spark, root, keys(spark, ["b", "c"]))
    assert (done.version, done.added) == (3, 1)
    assert ids(dictionary.read(spark, root)) == {"a": 1, "c": 2, "x": 3, "b": 4}


def test_stored_rows_are_not_moved(spark):
    """Without broadcasts, a join on the key deals the batch to the stored buckets."""
    root = scratch_path(spark, "dictionary")
    dictionary.extend(spark, root, keys(spark, [f"k{i}" for i in range(300)]), buckets=4)
    dictionary.extend(spark, root, keys(spark, [f"k{i}" for i in range(200, 500)]))
    batch = keys(spark, [f"k{i}" for i in range(100)])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = idx.encode(batch, dictionary.read(spark, root))
        assert joined.where(F.col("track_uri_index").isNotNull()).count() == 100
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.split("Initial Plan")[0].count("Exchange hashpartitioning(track_uri") == 1
        assert "Exchange hashpartitioning(_track" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
