import gzip
import hashlib
import io

import pytest

from mixtape.llm import oracle, queries, warc
from mixtape.session import scratch_path


def test_query_against_sql(spark, sf_smoke, duck):
    got = queries.QUERIES["op7_warc"](spark, sf_smoke)
    result = duck.execute(oracle.WARC)
    names = [d[0] for d in result.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(tuple(r[n] for n in names) for r in got.collect()) == sorted(result.fetchall())


@pytest.fixture(scope="module")
def rows():
    # a payload that itself is an archive, with members that mustn't be taken for records
    inner = warc.record(9, "http://inner/", b"x" * 50, hashlib.sha1(b"x" * 50).hexdigest(), 50, None)
    trap = "".join(chr(b) if b < 128 else "?" for b in inner) * 5 + "\x1f\x8b\x08" * 500
    big = "é" * 200_000
    return [(1, "http://a/ b\r\nX: y", "p" * 2000), (2, None, "p" * 2000), (5, "u", "p" * 2000), (3, "u", "short"),
            (4, "u", "short"), (6, "u", None), (7, "u", ""), (8, "u", trap), (None, "u", "q" * 1000), (10, "u", "q" * 1000),
            (11, "u", big), (11, "u", big), (12, "u", "WARC/1.1\r\n\r\n")]


def expected(rows):
    last = {}
    for page, _, html in rows:
        if len((html or "").encode()) >= 1000:
            last[html] = max(last.get(html, -1), -1 if page is None else page)
    out = []
    for page, _, html in rows:
        raw = (html or "").encode()
        to = last.get(html)
        revisit = to is not None and page != to
        out.append((page, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", to if revisit else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("split", [100, 4096, 1 << 22])
def test_round_trip_at_any_split(spark, rows, split):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    manifest = warc.write(pages, scratch_path(spark, "test-warc"))
    got = warc.read(manifest, split=split).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) \
        == expected(rows)
    payloads = {(r.page_id, bytes(r.payload).decode()) for r in got if r.record_type == "response"}
    assert payloads <= {(p, h or "") for p, _, h in rows}
    assert next(r.url for r in got if r.page_id == 1) == "http://a/%20b%0D%0AX:%20y"
    assert sum(r.records for r in manifest.collect()) == len(rows)


def test_archives_are_plain_gzip(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    for r in warc.write(pages, scratch_path(spark, "test-warc")).collect():
        with warc.blobs.open_file(r.file) as file:
            text = gzip.GzipFile(fileobj=io.BytesIO(file.read())).read()
        assert text.startswith(b"WARC/1.1\r\n") and text.count(b"WARC-Record-ID: ") >= r.records


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(pages, scratch_path(spark, "test-warc"))).count() == 0


def test_cut_archive_loses_only_the_cut_record(tmp_path, rows):
    raw = [warc.record(i, "u", b"payload %d" % i * 20, "0" * 40, 180, None) for i in range(3)]
    (tmp_path / "f").write_bytes(raw[0] + b"junk\x1f\x8b\x08junk" + raw[1] + raw[2][:-9])
    import pyarrow as pa
    with pa.OSFile(str(tmp_path / "f")) as file:
        places = [place for place, _, _ in warc.records_in(file, 0, 1 << 30)]
        assert places == [0, len(raw[0]) + 11]
        assert [p for p, _, _ in warc.records_in(file, 1, places[1])] == []
        assert [p for p, _, _ in warc.records_in(file, 1, places[1] + 1)] == [places[1]]
