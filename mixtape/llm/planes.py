"""Token-id files with bit-plane shuffling.

A file holds the ids of consecutive documents as fixed-size blocks. Each block
of unsigned 32-bit ids is transposed: either into byte planes (all lowest bytes,
then all second bytes, ...) or into bit planes (all lowest bits, ...), so that
the planes of small vocabularies are mostly zeros and the others are more
regular than the ids themselves. Every plane is compressed with zstandard on
its own. A footer holds the chunk index (ids per block, lengths of its planes)
and the documents (id, ids), so any range of ids is read by decoding only the
blocks that it touches, and of them only the planes that exist.

    file   = MAGIC, planes of block 0, planes of block 1, ..., footer, trailer
    footer = zstd of (header of 6 little-endian int64, plane lengths, ids per block,
             document ids, null marks, ids per document), all int64
    trailer = footer length as int64, MAGIC

Defined results: a null text is empty and gets only the end id; null document
ids sort first; repeated ids keep all their rows, in order of their texts;
no documents give no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window, functions as F

from mixtape.llm import blobs
from mixtape.llm.encoding import encoder
from mixtape.llm.textscan import Texts, slices
from mixtape.session import shuffle_partitions, stage

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16


def split_planes(ids: np.ndarray, plane: str) -> list[bytes]:
    """The planes of one block, lowest first, without the empty ones at the top."""
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    top = int(ids.max()) if len(ids) else 0
    if plane == "byte":
        return [raw[:, i].tobytes() for i in range(-(-top.bit_length() // 8))]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, i], bitorder="little").tobytes() for i in range(top.bit_length())]


def join_planes(planes: list[bytes], n: int, plane: str) -> np.ndarray:
    if plane == "byte":
        raw = np.zeros((n, 4), np.uint8)
        for i, p in enumerate(planes):
            raw[:, i] = np.frombuffer(p, np.uint8)
        return raw.reshape(-1).view("<u4")
    bits = np.zeros((n, 32), np.uint8)
    for i, p in enumerate(planes):
        bits[:, i] = np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little")
    return np.packbits(bits, axis=1, bitorder="little").reshape(-1).view("<u4")


class Writer:
    """Appends documents to an open stream, one block in memory at a time."""

    def __init__(self, stream, plane: str = "byte", block: int = BLOCK, level: int = 3):
        self.stream, self.plane, self.block = stream, plane, block
        self.zstd = zstandard.ZstdCompressor(level=level)
        self.open = np.zeros(0, np.uint32)
        self.planes: list[list[int]] = []
        self.sizes: list[int] = []
        self.doc_ids: list[int | None] = []
        self.doc_sizes: list[int] = []
        stream.write(MAGIC)

    def add(self, doc_ids: list, doc_sizes: list[int], ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.doc_sizes += doc_sizes
        ids = np.concatenate([self.open, ids.astype(np.uint32, copy=False)])
        full = len(ids) // self.block * self.block
        for at in range(0, full, self.block):
            self._put(ids[at:at + self.block])
        self.open = ids[full:]

    def _put(self, ids: np.ndarray) -> None:
        packed = [self.zstd.compress(p) for p in split_planes(ids, self.plane)]
        for p in packed:
            self.stream.write(p)
        self.planes.append([len(p) for p in packed])
        self.sizes.append(len(ids))

    def close(self) -> None:
        if len(self.open):
            self._put(self.open)
        lengths = np.array([len(x) for x in self.planes], np.int64)
        flat = np.array([x for p in self.planes for x in p], np.int64)
        nulls = np.array([i is None for i in self.doc_ids], np.int64)
        known = np.array([i or 0 for i in self.doc_ids], np.int64)
        header = np.array([len(self.sizes), len(flat), len(known), self.plane == "bit", self.block,
                           sum(self.doc_sizes)], np.int64)
        parts = [header, lengths, flat, np.array(self.sizes, np.int64), known, nulls,
                 np.array(self.doc_sizes, np.int64)]
        footer = self.zstd.compress(b"".join(p.astype("<i8").tobytes() for p in parts))
        self.stream.write(footer + struct.pack("<q", len(footer)) + MAGIC)
        self.stream.close()


class Reader:
    """Random access to a file by id range or document."""

    def __init__(self, file):
        self.file = file
        size = file.size()
        file.seek(size - 16)
        length, magic = struct.unpack("<q8s", file.read(16))
        if magic != MAGIC:
            raise ValueError("not a token-id file")
        file.seek(size - 16 - length)
        flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(file.read(length)), "<i8")
        blocks, planes, docs, bit, self.block, self.n_ids = (int(x) for x in flat[:6])
        self.plane = "bit" if bit else "byte"
        at = np.cumsum([6, blocks, planes, blocks, docs, docs, docs])
        self.n_planes, lengths, self.sizes, ids, nulls, self.doc_sizes = (
            flat[a:b] for a, b in zip(at[:-1], at[1:]))
        self.first_plane = np.concatenate([[0], np.cumsum(self.n_planes)])
        self.plane_at = len(MAGIC) + np.concatenate([[0], np.cumsum(lengths)])
        self.doc_ids = [None if x else int(i) for i, x in zip(ids, nulls)]
        self.doc_starts = np.concatenate([[0], np.cumsum(self.doc_sizes)])

    def _block(self, i: int) -> np.ndarray:
        a, b = self.first_plane[i], self.first_plane[i + 1]
        at = self.plane_at[a:b + 1]
        self.file.seek(int(at[0]))
        raw = self.file.read(int(at[-1] - at[0]))
        zstd = zstandard.ZstdDecompressor()
        planes = [zstd.decompress(raw[x - at[0]:y - at[0]]) for x, y in zip(at[:-1], at[1:])]
        return join_planes(planes, int(self.sizes[i]), self.plane)

    def ids(self, start: int, end: int) -> np.ndarray:
        """Ids start..end - 1 of the file."""
        if start >= end:
            return np.zeros(0, np.uint32)
        first = start // self.block
        got = np.concatenate([self._block(i) for i in range(first, (end - 1) // self.block + 1)])
        return got[start - first * self.block:end - first * self.block]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(document id, start in the file, ids) in order, a block in memory at a time."""
        have, at, block = np.zeros(0, np.uint32), 0, 0
        for doc, start, n in zip(self.doc_ids, self.doc_starts.tolist(), self.doc_sizes.tolist()):
            parts = [have[start - at:]]
            total = len(parts[0])
            while total < n:
                parts.append(self._block(block))
                total += len(parts[-1])
                block += 1
            have, at = np.concatenate(parts), start
            yield doc, start, have[:n]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids with the end id after each text."""
    n = len(offsets) - 1
    out = np.full(len(ids) + n, end_id, np.uint32)
    new = offsets + np.arange(n + 1)
    keep = np.ones(len(out), bool)
    keep[new[1:] - 1] = False
    out[keep] = ids
    return out, new


MANIFEST = "file string, part int, n_docs long, n_ids long"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
          text_col: str = "text", plane: str = "byte", block: int = BLOCK,
          files: int | None = None) -> DataFrame:
    """Writes the ids of all documents in ascending id order, a file per range of ids,
    and returns the stored manifest (file, part, n_docs, n_ids, start): file order is
    ``part`` and ``start`` counts the ids of all files before."""
    spark = docs.sparkSession

    def put(batches):
        from pyspark import TaskContext
        part, out, n_docs, n_ids = TaskContext.get().partitionId(), None, 0, 0
        for batch in batches:
            for rows, texts in slices(batch, "_text"):
                if out is None:
                    uri, stream = blobs.create(folder, f"ids-{part:06d}.planes")
                    out = Writer(stream, plane, block)
                ids, offsets = with_end(*encoder(tokenizer).encode(texts), end_id)
                out.add(rows.column(0).to_pylist(), np.diff(offsets).tolist(), ids)
                n_docs, n_ids = n_docs + rows.num_rows, n_ids + len(ids)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({
                "file": [uri], "part": pa.array([part], pa.int32()), "n_docs": [n_docs], "n_ids": [n_ids]})

    rows = docs.select(F.col(id_col).cast("long").alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    ranged = rows.repartitionByRange(files or shuffle_partitions(spark), "_id").sortWithinPartitions("_id", "_text")
    manifest = stage(ranged.mapInArrow(put, MANIFEST), "ids-manifest")
    # one row per file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read(manifest: DataFrame, digest: Callable[[np.ndarray], int] | None = None,
         id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) of every document, read back from the files;
    with ``digest``, a number made from the ids instead of the ids."""
    def get(batches):
        for batch in batches:
            for row in batch.to_pylist():
                with blobs.open_file(row["file"]) as file:
                    rows = []
                    for doc, start, ids in Reader(file).documents():
                        rows.append((doc, row["start"] + start, len(ids),
                                     digest(ids) if digest else ids.astype("<u4").tobytes()))
                        if len(rows) == 1000:
                            yield _rows(rows, id_col, digest)
                            rows = []
                    if rows:
                        yield _rows(rows, id_col, digest)

    kind = "ids_digest long" if digest else "ids binary"
    # a task per file
    return (manifest.select("file", "start").repartition(shuffle_partitions(manifest.sparkSession), "file")
            .mapInArrow(get, f"{id_col} long, start long, n_tokens long, {kind}"))


def _rows(rows: list[tuple], id_col: str, digest) -> pa.RecordBatch:
    ids, starts, sizes, values = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()),
         pa.array(values, pa.int64() if digest else pa.binary())],
        names=[id_col, "start", "n_tokens", "ids_digest" if digest else "ids"])


def crc32(ids: np.ndarray) -> int:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())
