"""Catalog build/page/lookups, search semantics, text rows, URI lists
(C8, L1, F3-F8, X1, X4-X7, Q12, Q17-Q20)."""

from pyspark.sql import functions as F

from mixtape.functions import text as txt
from mixtape.operators import catalog as cat
from mixtape.operators import search

SCHEMA = "track_name string, artist_name string, album_name string, track_uri string"


def _catalog(spark):
    rows = [
        ("Hello, Goodbye", "The Beatles", "Magical Mystery Tour", "u:1"),
        ("100% Pure", "Band_One", "Live (2001)", "u:2"),
        ("pure love", "band two", "Studio", "u:3"),
        (None, "Nobody", "Unknown", "u:4"),
        ("Ring of Fire", "Johnny", "At Folsom", "u:5"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_cut_before_distinct(spark):
    a, b = "x" * 200 + "A", "x" * 200 + "B"          # equal in the first 200 chars
    inter = spark.createDataFrame([(a, "ar", "al", "u:1"), (b, "ar", "al", "u:1")], SCHEMA)
    out = cat.build_catalog(inter).collect()
    assert len(out) == 1 and len(out[0].track_name) == 200


def test_page_and_lookups(spark):
    c = _catalog(spark)
    page = [r.track_uri for r in cat.catalog_page(c, offset=1, size=2).collect()]
    assert page == ["u:2", "u:3"]
    assert cat.track_by_uri(c, "u:5").collect()[0].track_name == "Ring of Fire"
    assert cat.track_by_uri(c, "nope").count() == 0
    assert sorted(r.track_uri for r in cat.tracks_by_uri(c, ["u:1", "u:3", "u:1", "x"]).collect()) == ["u:1", "u:3"]
    assert cat.tracks_by_uri(c, ["u:1"]).count() == 1          # one-element list (Q7)
    assert cat.tracks_by_uri(c, []).count() == 0


def test_search_is_literal_and_case_insensitive(spark):
    c = _catalog(spark)
    uris = lambda df: sorted(r.track_uri for r in df.collect())
    assert uris(search.track_name_like(c, "%")) == ["u:2"]       # % is a character
    assert uris(search.track_search(c, artist_name="_")) == ["u:2"]
    assert uris(search.track_search(c, album_name="(")) == ["u:2"]
    assert uris(search.track_search(c, track_name="PURE")) == ["u:2", "u:3"]
    assert uris(search.track_search(c, track_name="pure", artist_name="two")) == ["u:3"]
    assert uris(search.track_search(c)) == []                    # all blank -> nothing
    assert uris(search.track_search_contains(c)) == ["u:1", "u:2", "u:3", "u:4", "u:5"]
    # null name: false when searched, true when that field is blank
    assert uris(search.track_search_contains(c, track_name="o")) == ["u:1", "u:3", "u:5"]
    assert uris(search.track_search_contains(c, artist_name="nobody")) == ["u:4"]
    assert uris(search.track_search(c, track_name="r.ng", regex=True)) == ["u:5"]


def test_tiered_search_hit_and_fallback(spark):
    full = _catalog(spark)
    hot = cat.catalog_page(full, 0, 2)                          # u:1, u:2
    hit = search.track_search_tiered(hot, full, track_name="pure")
    assert sorted(r.track_uri for r in hit.collect()) == ["u:2"]  # found in the first tier only
    fallback = search.track_search_tiered(hot, full, track_name="ring")
    assert [r.track_uri for r in fallback.collect()] == ["u:5"]
    none = search.track_search_tiered(hot, full, track_name="zzz")
    assert none.count() == 0


def test_a_hit_in_the_first_tier_does_not_read_the_second(spark):
    hot = _catalog(spark).limit(2)
    full = _catalog(spark).withColumn("track_name", F.raise_error(F.lit("read")).cast("string"))
    assert [r.track_uri for r in search.track_search_tiered(hot, full, track_name="pure").collect()] == ["u:2"]


def test_text_rows_roundtrip_with_comma_in_name(spark):
    c = cat.with_text(_catalog(spark))
    texts = {r.track_uri: r.text for r in c.collect()}
    assert texts["u:1"] == "Hello, Goodbye, The Beatles, Magical Mystery Tour, u:1"
    assert texts["u:4"] == "None, Nobody, Unknown, u:4"
    parsed = {r.track_uri: r for r in txt.parse_track_text(c.select("text")).collect()}
    assert parsed["u:1"].track_name == "Hello, Goodbye" and parsed["u:1"].n_parts == 5
    assert parsed["u:1"].artist_name == "The Beatles"
    assert parsed["u:5"].n_parts == 4 and parsed["u:5"].album_name == "At Folsom"


def test_uri_list_explode(spark):
    df = spark.createDataFrame([(1, "u:1,u:2, u:3"), (2, "it's"), (3, "")], "basket_id int, uri_list string")
    got = sorted((r.basket_id, r.pos, r.track_uri) for r in txt.explode_uri_list(df).collect())
    assert got == [(1, 0, "u:1"), (1, 1, "u:2"), (1, 2, "u:3"), (2, 0, "it's")]


def test_keyset_page_equals_offset_page(spark):
    c = _catalog(spark)
    first = cat.catalog_page_after(c, None, 2).collect()
    last = first[-1]
    after = (last.track_uri, last.track_name, last.artist_name, last.album_name)
    nxt = [r.track_uri for r in cat.catalog_page_after(c, after, 2).collect()]
    assert nxt == [r.track_uri for r in cat.catalog_page(c, offset=2, size=2).collect()]


def test_catalog_by_id_one_row_per_id(spark):
    """Two spellings of one id give one deterministic catalog row (Q13)."""
    rows = spark.createDataFrame(
        [(1, "b name", "x", "y", "u:1", 1), (2, "a name", "x", "y", "u:1", 1),
         (3, "z", "x", "y", "u:2", 2), (4, "q", "x", "y", "u:3", None)],
        "playlist_id bigint, track_name string, artist_name string, album_name string, "
        "track_uri string, track_uri_index int")
    got = {r.track_uri_index: r.track_name for r in cat.catalog_by_id(rows).collect()}
    assert got == {1: "a name", 2: "z"}
