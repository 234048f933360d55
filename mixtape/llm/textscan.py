"""Vectorised word scanning of Arrow text batches with numpy.

A batch of texts is one UTF-8 buffer with offsets, so words, their 64-bit
hashes and word n-grams of all its texts come from a few array passes. Words
never cross texts. Work goes in slices of about ``SLICE`` bytes (whole texts;
a longer text is a slice of its own) to bound the temporaries.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE = 1 << 19
U64 = np.uint64


def release() -> None:
    """Gives freed memory back to the system: a Python worker outlives its task, and what it
    holds on to counts against the executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


#: A value per byte, from a fixed rule.
BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15)) | U64(1)
BASE = U64(0xD6E8FEB86659FD93)
BASE_INVERSE = U64(pow(int(BASE), -1, 1 << 64))
NO_FOLD = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, other bytes as they are.
ASCII_LOWER = np.where((NO_FOLD >= 65) & (NO_FOLD <= 90), NO_FOLD + 32, NO_FOLD).astype(np.uint8)
#: Words between ASCII white space.
NOT_SPACE = ~np.isin(NO_FOLD, [32, 9, 10, 11, 12, 13])
#: Words of ASCII letters and digits and everything beyond ASCII.
WORD_BYTES = ((NO_FOLD >= 48) & (NO_FOLD <= 57)) | ((NO_FOLD >= 65) & (NO_FOLD <= 90)) \
    | ((NO_FOLD >= 97) & (NO_FOLD <= 122)) | (NO_FOLD >= 128)

_powers = (np.ones(1, U64), np.ones(1, U64))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i for i below n at least."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 2 * SLICE)
        up, down = np.full(size, BASE), np.full(size, BASE_INVERSE)
        up[0] = down[0] = 1
        _powers = np.cumprod(up), np.cumprod(down)
    return _powers


@dataclass
class Texts:
    """Texts as one buffer; text i is ``data[offsets[i]:offsets[i + 1]]``."""
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


def texts_of(column: pa.Array) -> Texts:
    """The buffer of a string or binary array; nulls are empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    o = o.astype(np.int64)
    b = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return Texts(b, o - o[0])


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Parts of a batch with about ``size`` bytes of text each, and their texts."""
    n = batch.num_rows
    if not n:
        return
    whole = texts_of(batch.column(batch.schema.get_field_index(column)))
    at = 0
    while at < n:
        to = int(np.searchsorted(whole.offsets, whole.offsets[at] + size, "right")) - 1
        to = min(n, max(to, at + 1))
        o = whole.offsets[at:to + 1]
        yield batch.slice(at, to - at), Texts(whole.data[o[0]:o[-1]], o - o[0])
        at = to
    release()


@dataclass
class Words:
    """Byte ranges of words, their text, and the first word of each text."""
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.starts)


def scan(texts: Texts, word_bytes: np.ndarray = NOT_SPACE) -> Words:
    """All maximal runs of word bytes, in order, none across two texts."""
    data, offsets = texts.data, texts.offsets
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Words(none, none, none, np.zeros(len(offsets), np.int64))
    inside = word_bytes[data]
    edge = np.empty(n + 1, bool)
    edge[0], edge[n] = inside[0], inside[n - 1]
    np.not_equal(inside[1:], inside[:-1], out=edge[1:n])
    bounds = np.flatnonzero(edge)
    # a text that starts inside a run cuts the run in two
    cuts = np.unique(offsets[1:-1])
    cuts = cuts[(cuts > 0) & (cuts < n)]
    cuts = cuts[inside[cuts] & inside[cuts - 1]]
    if len(cuts):
        bounds = np.sort(np.concatenate([bounds, cuts, cuts]), kind="stable")
    starts, ends = bounds[0::2], bounds[1::2]
    first = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(starts, ends, text, first)


class Hasher:
    """64-bit hashes of byte ranges (of the folded bytes), equal wherever equal ranges lie."""

    def __init__(self, data: np.ndarray, fold: np.ndarray = NO_FOLD):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, U64)
        np.cumsum(BYTE_VALUES[fold][data] * up[:len(data)], out=self.sums[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts] + (ends - starts).astype(U64))


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                 fold: np.ndarray = NO_FOLD) -> np.ndarray:
    return Hasher(data, fold)(starts, ends) if len(starts) else np.zeros(0, U64)


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of every k consecutive hashes, from each position where k remain."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = hashes[:n] * BASE + U64(k)
    for j in range(1, k):
        out = (out ^ (out >> U64(29))) * BASE + hashes[j:n + j]
    return mix(out)


def gram_starts(words: Words, k: int) -> np.ndarray:
    """Positions (word numbers) where a k-gram lies in one text."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text[:n] == words.text[k - 1:])


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indexes of the ranges, one after another."""
    total = int(lengths.sum())
    top = max(total, int((starts + lengths).max()) if len(starts) else 0)
    kind = np.int32 if top < 1 << 31 else np.int64
    ends = np.cumsum(lengths)
    out = np.repeat((starts - (ends - lengths)).astype(kind), lengths)
    out += np.arange(total, dtype=kind)
    return out


def joined(data: bytes | np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array over one buffer, without copying each value."""
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)),
                                              pa.py_buffer(data)]).cast(pa.binary())
