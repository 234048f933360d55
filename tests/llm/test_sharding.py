import zlib
from collections import Counter

import pytest

from mixtape.llm import oracle, queries, sharding


@pytest.mark.parametrize("n", [1, 2, 3, 10, 24, 97, 1000])
def test_permutation_and_its_inverse(n):
    places = [sharding.place_of(i, n, 5) for i in range(n)]
    assert sorted(places) == list(range(n))
    assert [sharding.row_at(p, n, 5) for p in places] == list(range(n))
    if n > 50:
        assert sum(abs(a - b) == 1 for a, b in zip(places, places[1:])) < 5
        assert places != [sharding.place_of(i, n, 6) for i in range(n)]


def test_large_numbers_stay_in_range():
    n = 10 ** 13 + 37
    for i in (0, 1, n // 2, n - 1):
        assert sharding.row_at(sharding.place_of(i, n, 9), n, 9) == i


def test_query_against_sql(spark, sf_smoke, duck):
    got = queries.QUERIES["op9_shards"](spark, sf_smoke)
    result = duck.execute(oracle.SHARDS)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(result.fetchall())


def test_odd_rows(frame):
    rows = [(5, "b"), (None, "x"), (5, "a"), (5, "a"), (1, None), (2, ""), (9, "é" * 50_000)]
    got = sharding.shard(frame(rows), shards=3).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == sorted(
        ((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    assert sorted(r.row_number for r in got) == list(range(len(rows)))
    by_number = sorted(got, key=lambda r: r.row_number)
    assert [r.doc_id for r in by_number] == [None, 1, 2, 5, 5, 5, 9]
    for r in got:
        assert r.place == sharding.place_of(r.row_number, len(rows), 2024)
        assert (r.shard, r.slot) == (r.place % 3, r.place // 3)
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1
    assert sharding.shard(frame([])).count() == 0


def test_one_id_in_a_third_of_the_rows(frame):
    rows = [(7, "same")] * 300 + [(i, str(i)) for i in range(1000, 1600)]
    got = sharding.shard(frame(rows, extra=False), shards=24).collect()
    assert sorted(r.row_number for r in got) == list(range(900))
    for s in range(24):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots))) and len(slots) in (37, 38)
