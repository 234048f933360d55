"""WARC archives: writer with duplicate payloads as revisits, splittable reader.

Writer: one gzip member per record, one archive per task. Payload digests are
grouped on narrow rows (digest, id), so the payloads themselves only move once,
by record id, however many copies one payload has.

Reader: an archive is cut into byte ranges. The task of a range looks for the
gzip magic inside it, decodes the start of each candidate and takes it as a
record only if it begins with a WARC version line and inflates to a block of the
announced length (magic bytes inside compressed data fail this). A record
belongs to the range in which it starts; its task reads on past the range's end.

Defined results: a null payload is empty; a null url is empty; records of one
id and payload have the same role; records without an id count as smallest; no
rows give no archive.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixtape.llm import blobs
from mixtape.session import shuffle_partitions, stage

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
MIN_REVISIT = 1000
SPLIT = 4 << 20
WINDOW = 1 << 20
DATE = "2024-01-01T00:00:00Z"


def record(page_id, url: str, payload: bytes, digest: str, size: int, refers_to) -> bytes:
    """One record as a gzip member; with ``refers_to`` a revisit without the payload."""
    revisit = refers_to is not None
    http = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
            f"Content-Length: {size}\r\n\r\n").encode()
    block = http if revisit else http + payload
    lines = [f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: {record_id(page_id, digest)}",
             f"WARC-Target-URI: {re.sub(r'[\x00-\x20\x7f]', lambda m: f'%{ord(m[0]):02X}', url)}",
             f"WARC-Date: {DATE}",
             f"WARC-Payload-Digest: sha1:{digest}",
             f"X-Payload-Length: {size}"]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if revisit:
        lines += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                  f"WARC-Refers-To: {record_id(refers_to, digest)}", f"X-Refers-To-Page-Id: {refers_to}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    head = VERSION + "\r\n".join(lines).encode() + b"\r\n\r\n"
    gz = zlib.compressobj(6, zlib.DEFLATED, 31)
    return gz.compress(head + block + b"\r\n\r\n") + gz.flush()


def record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def roles(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html",
          min_revisit: int = MIN_REVISIT) -> DataFrame:
    """(_id, _digest, _refers_to) of the records that revisit another: of equal payloads
    of ``min_revisit`` bytes or more, all but those with the largest id."""
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    narrow = (pages.where(F.octet_length(payload) >= min_revisit)
              .select(F.col(id_col).cast("long").alias("_id"), F.sha1(payload.cast("binary")).alias("_digest")))
    groups = (narrow.groupBy("_digest").agg(F.max("_id").alias("_refers_to"), F.count(F.lit(1)).alias("_n"))
              .where(F.col("_n") > 1).drop("_n"))
    return (narrow.distinct().join(groups, "_digest")
            .where(~F.col("_id").eqNullSafe(F.col("_refers_to"))))


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
          payload_col: str = "html", min_revisit: int = MIN_REVISIT) -> DataFrame:
    """Writes one archive per task; returns the stored manifest (file, bytes, records)."""
    def put(batches):
        from pyspark import TaskContext
        uri, out, size, n = None, None, 0, 0
        for batch in batches:
            for page_id, url, payload, digest, to in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    uri, out = blobs.create(folder, f"pages-{TaskContext.get().partitionId():06d}.warc.gz")
                raw = record(page_id, url, payload, digest, len(payload), to)
                out.write(raw)
                size, n = size + len(raw), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [uri], "bytes": [size], "records": [n]})

    payload = F.coalesce(F.col(payload_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(url_col), F.lit("")).alias("_url"),
                        payload.alias("_payload"), F.sha1(payload).alias("_digest"))
    to = roles(pages, id_col, payload_col, min_revisit).withColumnRenamed("_id", "_to_id").withColumnRenamed(
        "_digest", "_to_digest")
    marked = rows.join(to, rows["_id"].eqNullSafe(to["_to_id"]) & (rows["_digest"] == to["_to_digest"]), "left")
    return stage(marked.select("_id", "_url", "_payload", "_digest", "_refers_to")
                 .mapInArrow(put, "file string, bytes long, records long"), "warc-manifest")


def records_in(file, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(place, headers, block) of the records that start at start..end - 1."""
    size = file.size()
    end = min(end, size)
    at = start
    while at < end:
        file.seek(at)
        # two bytes more, for a magic that starts just before the end of the window
        window = file.read(min(WINDOW, end - at) + 2)
        skip = window.find(MAGIC)
        if skip < 0 or at + skip >= end:
            at += max(1, len(window) - 2)
            continue
        at += skip
        got = member(file, at)
        if got is None:
            at += 1
            continue
        headers, block, length = got
        yield at, headers, block
        at += length


def member(file, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """(headers, block, compressed length) of the gzip member at a place, None if there
    is no whole WARC record."""
    file.seek(at)
    gz, plain, used = zlib.decompressobj(31), [], 0
    raw = file.read(4096)
    try:
        while raw:
            plain.append(gz.decompress(raw))
            used += len(raw)
            if len(plain) == 1 and not plain[0].startswith(b"WARC/1."):
                return None
            if gz.eof:
                break
            raw = file.read(1 << 16)
    except zlib.error:
        return None
    if not gz.eof:
        return None
    head, blank, rest = b"".join(plain).partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    length = headers.get("Content-Length", "")
    if not blank or not length.isdigit() or len(rest) != int(length) + 4:
        return None
    return headers, rest[:-4], used - len(gz.unused_data)


SCHEMA = ("file string, place long, record_type string, record_id string, page_id long, url string, "
          "payload_bytes long, payload_digest string, refers_to long, payload binary")


def read(archives: DataFrame, split: int = SPLIT, payloads: bool = True) -> DataFrame:
    """The records of the archives listed as (file, bytes): size and digest of the payload
    from the payload itself, or for a revisit from its headers."""
    def get(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with blobs.open_file(row["file"]) as file:
                    out, held = [], 0
                    for place, headers, block in records_in(file, row["begin"], row["begin"] + split):
                        out.append(_row(row["file"], place, headers, block, payloads))
                        held += len(block)
                        if held > WINDOW:
                            yield pa.RecordBatch.from_pylist(out, ARROW)
                            out, held = [], 0
                    if out:
                        yield pa.RecordBatch.from_pylist(out, ARROW)

    ranges = archives.select("file", F.explode(F.sequence(
        F.lit(0).cast("long"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("long"))).alias("begin"))
    spread = ranges.repartition(shuffle_partitions(archives.sparkSession), "file", "begin")
    return spread.mapInArrow(get, SCHEMA)


ARROW = pa.schema([("file", pa.string()), ("place", pa.int64()), ("record_type", pa.string()),
                   ("record_id", pa.string()), ("page_id", pa.int64()), ("url", pa.string()),
                   ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                   ("payload", pa.binary())])


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


def _row(file: str, place: int, headers: dict[str, str], block: bytes, payloads: bool) -> dict:
    kind = headers.get("WARC-Type")
    payload = block.partition(b"\r\n\r\n")[2] if kind == "response" else None
    told = headers.get("WARC-Payload-Digest", "").removeprefix("sha1:")
    digest = told if payload is None else hashlib.sha1(payload).hexdigest()
    if payload is not None and told and told != digest:
        raise ValueError(f"{file} at {place}: the payload doesn't have its digest")
    return {"file": file, "place": place, "record_type": kind, "record_id": headers.get("WARC-Record-ID"),
            "page_id": _number(headers.get("X-Page-Id")), "url": headers.get("WARC-Target-URI"),
            "payload_bytes": _number(headers.get("X-Payload-Length")) if payload is None else len(payload),
            "payload_digest": digest, "refers_to": _number(headers.get("X-Refers-To-Page-Id")),
            "payload": payload if payloads else None}
