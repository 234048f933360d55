"""Stored catalog: pages by position and searches by postings, against sorts and scans."""

import random

import pytest

from mixtape import schemas
from mixtape.operators import catalog as cat
from mixtape.operators import search, stored_catalog
from mixtape.session import scratch_path

WORDS = ["ring", "Blue", "a", "of", "İstanbul", "日本語", "100%", "x_y", "Straße", "ring ring", "", "RINGS", "No. 1"]


@pytest.fixture(scope="module")
def table(spark):
    rnd = random.Random(1)

    def name():
        return None if rnd.random() < 0.05 else " ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 4)))

    rows = {(name(), name(), name(), f"u:{rnd.randrange(300)}") for _ in range(600)}
    return spark.createDataFrame(sorted(rows, key=str), schemas.CATALOG).repartition(5).persist()


@pytest.fixture(scope="module")
def stored(spark, table):
    path = scratch_path(spark, "t-catalog")
    stored_catalog.write(table, path, part_rows=130)
    return stored_catalog.read(spark, path)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_rows_and_manifest(table, stored):
    assert rows(stored.catalog) == rows(table)
    ordered = [tuple(r) for r in table.orderBy("track_uri", "track_name", "artist_name", "album_name").collect()]
    assert [tuple(r)[:4] for r in stored.rows.orderBy("row").collect()] == ordered
    parts = [tuple(r) for r in stored.manifest.orderBy("part").collect()]
    assert sum(n for _, _, n in parts) == len(ordered) and parts[0][1] == 0
    assert all(a[1] + a[2] == b[1] for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("offset, size", [(0, 100), (7, 1), (100, 100), (430, 100), (550, 100), (599, 5), (10_000, 100), (0, 1000), (3, 0)])
def test_pages(table, stored, offset, size):
    page = stored_catalog.page(stored, offset, size)
    assert [tuple(r) for r in page.collect()] == [tuple(r) for r in cat.catalog_page(table, offset, size).collect()]


def test_deep_page_reads_two_files_at_most(spark, stored):
    for offset in (0, 250, 480):
        page = stored_catalog.page(stored, offset, 100)
        page.collect()
        scans = [n for n in _scans(page) if "part" in n[0]]
        assert scans and all(count <= 2 for _, count in scans)


def _scans(df):
    """(metadata, files read) of each scan of the executed plan."""
    plan, out = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName() == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in node.nodeName():
            return walk(node.plan())
        if node.nodeName().startswith("Scan"):
            metrics = node.metrics()
            out.append((node.simpleString(1000), int(metrics.apply("numFiles").value())))
        for i in range(node.children().size()):
            walk(node.children().apply(i))

    walk(plan)
    return [(text, n) for text, n in out if "place" in text]


@pytest.mark.parametrize("term", ["ring", "RING", "ing r", "ring ring", "rings", "a", "of", "bl", "%", "_", "100%", "x_y", "İst", "i̇st", "日本語", "本語",
                                  "straße", "STRASSE", "zzz", "g  r", " ", "   ", "No. 1", "ringringring", "\\", "ri"])
def test_same_rows_as_a_scan(table, stored, term):
    assert rows(stored_catalog.name_like(stored, term)) == rows(search.track_name_like(table, term))


@pytest.mark.parametrize("terms", [("ring", "blue", ""), ("", "", ""), ("ring", "a", "of"), ("a", "b", ""), ("", "", "rings"), ("zzz", "ring", ""),
                                   ("ring ring", "ring ring", "ring")])
def test_several_fields(table, stored, terms):
    assert rows(stored_catalog.search(stored, *terms)) == rows(search.track_search(table, *terms))
    assert rows(stored_catalog.search_contains(stored, *terms)) == rows(search.track_search_contains(table, *terms))
    assert rows(stored_catalog.search(stored, *terms, regex=True)) == rows(search.track_search(table, *terms, regex=True))


def test_report(table, stored):
    n = table.count()
    seen = stored_catalog.report(stored, {"track_name": "ring ring"}).first()
    found = search.track_name_like(table, "ring ring").count()
    assert seen.n_rows == n and found == seen.n_found <= seen.n_tested < n / 2
    assert stored_catalog.report(stored, {"track_name": "of"}).first().n_tested == n
    assert tuple(stored_catalog.report(stored, {"track_name": "qqqq"}).first()) == (n, 0, 0)


def test_two_tiers(table, stored):
    hot = cat.catalog_page(table, 0, 20)
    assert rows(stored_catalog.search_tiered(hot, stored, "İstanbul")) == rows(search.track_search_tiered(hot, table, "İstanbul"))
    assert rows(stored_catalog.search_tiered(table.limit(0), stored, "ring")) == rows(search.track_search(table, "ring"))


def test_empty_catalog(spark, table):
    path = scratch_path(spark, "t-catalog-empty")
    stored_catalog.write(table.limit(0), path)
    empty = stored_catalog.read(spark, path)
    assert stored_catalog.page(empty, 0).count() == 0
    assert stored_catalog.name_like(empty, "ring").count() == 0 == stored_catalog.name_like(empty, "r").count()
