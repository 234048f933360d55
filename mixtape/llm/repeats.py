"""Removal of repeated passages with suffix arrays.

Every byte covered by a string of ``LENGTH`` bytes that also starts in a document
with a smaller id is removed. The windows of a text (its strings of that length)
are cut into runs: a window's anchor is the leftmost of its 16-byte grams with
the smallest hash, and consecutive windows with one anchor are a run. Equal
windows have equal anchors at equal places, so what can match lies in runs with
equal anchor grams, and only runs whose gram is in two documents can match.

1. Documents are dealt to batches by a hash. Each batch lists its grams, and
   the lists meet by gram: grams of two documents or more go back as shared.
2. Batches send their shared runs (equal ones once, under their smallest id) to
   shards by gram. A shard sorts the suffixes of its distinct runs by induced
   sorting, finds equal windows from the permuted common prefixes, and knows the
   smallest document of each window. A run that differs from all others of its
   gram too near the gram to share a window has nothing to sort against. Grams in more than ``HOT`` documents are dealt by the windows'
   common core as well, so that one frequent line isn't one shard's.
3. The windows that are in a smaller document go back to the batches, which cut
   the bytes.

So texts move once (their shuffle is read three times), runs about once more,
and neither pairs nor groups of documents are formed.

Defined results: null texts are empty; texts shorter than a window are kept
whole; matches don't cross documents; rows of one id don't remove each other's
text; null ids count as smaller than all others; an empty table gives an empty
result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from mixtape.llm.sais import common_prefixes, suffix_array
from mixtape.llm.textscan import BASE, BYTE_VALUES, SLICE, U64, Hasher, Texts, gather, mix, release

LENGTH = 50
GRAM = 16
#: Text bytes of a batch, about.
BATCH = 8 << 20
#: Shards per batch: what a shard sorts takes some fifty bytes of memory a byte.
SHARDS = 1
#: Documents of a gram beyond which its windows are dealt on their own, in this many parts:
#: their runs, of ``2 * LENGTH - GRAM`` bytes at most, would be more than a shard's bytes.
HOT = BATCH // SHARDS // (2 * LENGTH - GRAM)
HOT_PARTS = 4
NO_ID = -(1 << 63)
LOW48 = U64((1 << 48) - 1)


# --- the runs of a text ---------------------------------------------------------

class Runs:
    """Runs of all texts of one slice: first and last window, gram hash and content hash."""

    def __init__(self, texts: Texts, length: int = LENGTH):
        data, offsets = texts.data, texts.offsets
        self.data, self.length = data, length
        none = np.zeros(0, np.int64)
        self.first, self.last, self.anchor, self.text = none, none, none, none
        self.gram = np.zeros(0, U64)
        self.hasher = None
        if len(data) < length:
            return
        x = (BYTE_VALUES[data] >> U64(32)).astype(np.uint32)
        width = 1
        while width < GRAM:
            x = x[:-width] * np.uint32(0x9E3779B1 + 2 * width) + x[width:]
            width *= 2
        x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(13)
        # hash and place as one number: the smallest hash, of equals the leftmost
        key = (x.astype(U64) << U64(32)) | np.arange(len(x), dtype=U64)
        span, width = length - GRAM + 1, 1
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if span > width:
            key = np.minimum(key[:width - span], key[span - width:])
        valid = np.zeros(len(key) + 1, np.int8)
        long = np.flatnonzero(np.diff(offsets) >= length)
        np.add.at(valid, offsets[long], 1)
        np.add.at(valid, offsets[long + 1] - length + 1, -1)
        window = np.flatnonzero(np.cumsum(valid[:-1], dtype=np.int8))
        if not len(window):
            return
        anchor = (key[window] & U64(0xFFFFFFFF)).astype(np.int64)
        cut = np.flatnonzero(anchor[1:] != anchor[:-1]) + 1
        head = np.concatenate([[0], cut])
        self.first, self.anchor = window[head], anchor[head]
        self.last = window[np.append(cut, len(window)) - 1]
        self.text = np.searchsorted(offsets, self.first, "right") - 1
        self.hasher = Hasher(data)
        self.gram = self.hasher(self.anchor, self.anchor + GRAM)

    def __len__(self) -> int:
        return len(self.first)

    def parts(self, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(run, first window, last window, core hash) with hot runs cut by the place of the
        anchor in the window, at fixed bounds; the core hash of others is 0."""
        whole = np.flatnonzero(~hot)
        out = [(whole, self.first[whole], self.last[whole], np.zeros(len(whole), U64))]
        some = np.flatnonzero(hot)
        size = -(-(self.length - GRAM + 1) // HOT_PARTS)
        for part in range(HOT_PARTS if len(some) else 0):
            # windows whose anchor lies part * size .. (part + 1) * size - 1 bytes in
            most = np.minimum(self.last[some], self.anchor[some] - part * size)
            least = np.maximum(self.first[some], self.anchor[some] - (part + 1) * size + 1)
            keep = most >= least
            run, low, high = some[keep], least[keep], most[keep]
            core_from = self.anchor[run] - part * size
            core_to = self.anchor[run] - (part + 1) * size + 1 + self.length
            inside = (core_from >= low) & (core_to <= high + self.length)
            core = np.zeros(len(run), U64)
            core[inside] = self.hasher(core_from[inside], core_to[inside])
            # a part cut short by the text's end lacks some of the core: take what all its windows share
            core_from, core_to = np.maximum(core_from, high), np.minimum(core_to, low + self.length)
            out.append((run, low, high, core | U64(1)))
        return tuple(np.concatenate(x) for x in zip(*out))


def in_slices(ids: np.ndarray, packed: list[bytes]):
    """(number of the first document, texts) of about ``SLICE`` bytes each."""
    unzip = zstandard.ZstdDecompressor()
    held, size, at = [], 0, 0
    for i, raw in enumerate(packed):
        held.append(unzip.decompress(raw))
        size += len(held[-1])
        if size >= SLICE or i == len(packed) - 1:
            offsets = np.concatenate([[0], np.cumsum([len(t) for t in held])]).astype(np.int64)
            yield at, Texts(np.frombuffer(b"".join(held), np.uint8), offsets)
            at, held, size = i + 1, [], 0
    release()


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("_id").to_numpy()


def _bucket(gram: np.ndarray, n: int) -> np.ndarray:
    """Buckets by the upper 16 bits of a gram; the lower 48 tell grams of a bucket apart."""
    return (((gram >> U64(48)) * U64(n)) >> U64(16)).astype(np.int64)


def _pack48(values: np.ndarray) -> bytes:
    return np.ascontiguousarray((values & LOW48).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack48(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


# --- 1: shared grams ---------------------------------------------------------------

def _list_grams(buckets: int, length: int):
    """A batch's distinct grams by bucket, with how many documents have each."""
    def run(table: pa.Table) -> pa.Table:
        ids, grams, docs = _ids(table), [], []
        for at, texts in in_slices(ids, table.column("_zip").to_pylist()):
            runs = Runs(texts, length)
            grams.append(runs.gram)
            docs.append(ids[at + runs.text])
        grams, docs = np.concatenate(grams), np.concatenate(docs)
        order = np.lexsort((docs, grams))
        grams, docs = grams[order], docs[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (docs[1:] != docs[:-1])
        distinct, count = np.unique(grams[new], return_counts=True)
        bucket = _bucket(distinct, buckets)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        some = np.flatnonzero(np.diff(cut))
        batch = table.column("_batch")[0].as_py()
        return pa.table({
            "_bucket": pa.array(some, pa.int32()), "_batch": pa.array([batch] * len(some), pa.int32()),
            "_grams": pa.array([_pack48(distinct[cut[i]:cut[i + 1]]) for i in some], pa.binary()),
            "_docs": pa.array([count[cut[i]:cut[i + 1]].astype("<u4").tobytes() for i in some], pa.binary())})
    return run


def _share(hot: int):
    """Of the grams of a bucket, those in two documents or more, back to their batches."""
    def run(table: pa.Table) -> pa.Table:
        lists = [_unpack48(x) for x in table.column("_grams").to_pylist()]
        size = np.array([len(x) for x in lists])
        grams = np.concatenate(lists)
        docs = np.frombuffer(b"".join(table.column("_docs").to_pylist()), "<u4").astype(np.int64)
        _, which = np.unique(grams, return_inverse=True)
        total = np.bincount(which, docs).astype(np.int64)[which]
        keep, owner = total > 1, np.repeat(np.arange(len(lists)), size)
        cut = np.searchsorted(owner[keep], np.arange(len(lists) + 1))
        grams, warm = grams[keep], (total[keep] > hot).astype(np.uint8)
        return pa.table({
            "_batch": table.column("_batch"), "_bucket": table.column("_bucket"),
            "_grams": pa.array([_pack48(grams[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            "_hot": pa.array([warm[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})
    return run


class Shared:
    """The shared grams of a batch."""

    def __init__(self, table: pa.Table, buckets: int):
        self.buckets = buckets
        keys, hot = [np.zeros(0, U64)], [np.zeros(0, np.uint8)]
        for bucket, raw, warm in zip(*(table.column(c).to_pylist() for c in ("_bucket", "_grams", "_hot"))):
            keys.append(_unpack48(raw) | U64(bucket << 48))
            hot.append(np.frombuffer(warm, np.uint8))
        keys, hot = np.concatenate(keys), np.concatenate(hot)
        order = np.argsort(keys)
        self.keys, self.hot = keys[order], hot[order].astype(bool)

    def find(self, runs: Runs) -> tuple[np.ndarray, np.ndarray]:
        """(whether the gram of each run is shared, whether it is hot)."""
        if not len(self.keys) or not len(runs):
            return np.zeros(len(runs), bool), np.zeros(len(runs), bool)
        key = (runs.gram & LOW48) | (_bucket(runs.gram, self.buckets).astype(U64) << U64(48))
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        shared = self.keys[at] == key
        return shared, shared & self.hot[at]


# --- 2: equal windows ------------------------------------------------------------------

def _shared_parts(table: pa.Table, shared: Shared, length: int):
    """Of each slice: (first document, texts, text of each part, anchor, first window, last
    window, core hash, content hash)."""
    ids = _ids(table)
    for at, texts in in_slices(ids, table.column("_zip").to_pylist()):
        runs = Runs(texts, length)
        known, hot = shared.find(runs)
        run, low, high, core = runs.parts(hot)
        keep = known[run]
        run, low, high, core = run[keep], low[keep], high[keep], core[keep]
        content = runs.hasher(low, high + length) if len(run) else np.zeros(0, U64)
        yield at, texts, runs.text[run], runs.anchor[run], runs.gram[run], low, high, core, content


def _send_runs(buckets: int, shards: int, length: int):
    """A batch's distinct shared runs, a blob per shard."""
    def run(docs: pa.Table, lists: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows and lists.num_rows:
            ids = _ids(docs)
            for at, texts, text, anchor, gram, low, high, core, content in _shared_parts(
                    docs, Shared(lists, buckets), length):
                size = high + length - low
                shard = (mix(gram * BASE + core) % U64(shards)).astype(np.int32)
                rows.append((shard, content, ids[at + text], (anchor - low).astype(np.uint16), size.astype(np.uint16),
                             texts.data[gather(low, size)]))
        if not rows:
            return SENT.empty_table()
        shard, content, doc, anchor, size, data = (np.concatenate([r[i] for r in rows]) for i in range(6))
        del rows
        # of equal runs in the batch, the one of the smallest document
        order = np.lexsort((doc, content, shard))
        new = np.ones(len(order), bool)
        new[1:] = (shard[order][1:] != shard[order][:-1]) | (content[order][1:] != content[order][:-1])
        pick = order[new]
        start = np.cumsum(size, dtype=np.int64) - size
        cut = np.append(np.flatnonzero(np.diff(shard[pick], prepend=-1)), len(pick))
        pack, blobs = zstandard.ZstdCompressor(level=1), []
        for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
            part = pick[a:b]
            text = data[gather(start[part], size[part].astype(np.int64))]
            blobs.append(pack.compress(b"".join((np.int64(len(part)).tobytes(), doc[part].tobytes(), anchor[part].tobytes(),
                                                 size[part].tobytes(), text.tobytes()))))
        batch = docs.column("_batch")[0].as_py()
        return pa.table([pa.array(shard[pick][cut[:-1]]), pa.array(np.full(len(blobs), batch, np.int32)),
                         pa.array(blobs, pa.binary())], schema=SENT)
    return run


SENT = pa.schema([("_shard", pa.int32()), ("_batch", pa.int32()), ("_runs", pa.binary())])


def _received(table: pa.Table):
    """(documents, anchors, sizes, batches, text) of the runs that batches sent to a shard."""
    # what the group before held
    release()
    unpack, parts = zstandard.ZstdDecompressor(), []
    for batch, blob in zip(table.column("_batch").to_pylist(), table.column("_runs").to_pylist()):
        raw = unpack.decompress(blob)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        parts.append((np.frombuffer(raw, np.int64, n, 8), np.frombuffer(raw, np.uint16, n, 8 + 8 * n),
                      np.frombuffer(raw, np.uint16, n, 8 + 10 * n), np.full(n, batch, np.int32),
                      np.frombuffer(raw, np.uint8, -1, 8 + 12 * n)))
    return tuple(np.concatenate([p[i] for p in parts]) for i in range(5))


def _hashes(data: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(gram hash, content hash) of the runs, some at a time."""
    grams, contents = [np.zeros(0, U64)], [np.zeros(0, U64)]
    for a in range(0, len(start), 10_000):
        first, length, at = start[a], size[a:a + 10_000], anchor[a:a + 10_000]
        low = start[a:a + 10_000] - first
        hasher = Hasher(data[first:first + int(low[-1] + length[-1])])
        grams.append(hasher(low + at, low + at + GRAM))
        contents.append(hasher(low, low + length))
    return np.concatenate(grams), np.concatenate(contents)


#: Ranges of the bytes that a window has to the left of its gram, to look for partners.
REACH = 6


def with_partner(data: np.ndarray, start: np.ndarray, size: np.ndarray, anchor: np.ndarray, group: np.ndarray,
                 length: int) -> np.ndarray:
    """Which strings can share a window with another of their group. A shared window holds
    the anchor gram and ``length - GRAM`` bytes more, so many of them to the left and the
    rest to the right; for each of ``REACH`` ranges of the left share, both strings agree
    in the bytes that all windows of the range have."""
    more = length - GRAM
    hasher = Hasher(data)
    at = start + anchor
    end = start + size
    found = np.zeros(len(start), bool)
    bounds = np.linspace(0, more + 1, REACH + 1).astype(int).tolist()
    for low, high in zip(bounds[:-1], bounds[1:]):
        # windows with low .. high - 1 bytes to the left have more - high + 1 to the right
        left, right = at - low, at + GRAM + more - high + 1
        inside = np.flatnonzero((left >= start) & (right <= end))
        key = mix(hasher(left[inside], right[inside]) + U64(low) + group[inside].astype(U64) * BASE)
        _, which, count = np.unique(key, return_inverse=True, return_counts=True)
        found[inside[count[which] > 1]] = True
    return found


def smallest_documents(data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray,
                       partner: np.ndarray, length: int) -> np.ndarray:
    """For each place of ``data`` (strings one after another), the smallest document of the
    window that starts there; NO_ID where no window does."""
    out = np.full(len(data), NO_ID)
    window = np.zeros(len(data), bool)
    window[gather(start, size - length + 1)] = True
    out[window] = np.repeat(doc, size - length + 1)
    if not partner.any():
        return out
    # the strings that may match others, sorted by all their suffixes
    at = gather(start[partner], size[partner])
    some, inside = data[at], window[at]
    order = suffix_array(some)
    shared = common_prefixes(some, order, length)[order]
    equal = np.cumsum(shared < length)
    mine = inside[order]
    place, equal = at[order[mine]], equal[mine]
    cut = np.flatnonzero(np.diff(equal, prepend=-1))
    least = np.minimum.reduceat(out[place], cut)
    out[place] = np.repeat(least, np.diff(np.append(cut, len(place))))
    return out


def _sort_shard(length: int):
    """Which windows of the runs that batches sent are in a smaller document."""
    def run(table: pa.Table) -> pa.Table:
        doc, anchor, size, batch, data = _received(table)
        size = size.astype(np.int64)
        start = np.cumsum(size) - size
        gram, content = _hashes(data, start, size, anchor)
        order = np.lexsort((doc, content, gram))
        gram, content, doc, batch, anchor = gram[order], content[order], doc[order], batch[order], anchor[order]
        new = np.ones(len(order), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (content[1:] != content[:-1])
        head = np.flatnonzero(new)
        data = data[gather(start[order[head]], size[order[head]])]
        size = size[order[head]]
        start = np.cumsum(size) - size
        group = np.cumsum(np.diff(gram[head], prepend=gram[head[0]]) != 0)
        partner = with_partner(data, start, size, anchor[head], group, length)
        least = smallest_documents(data, start, size, doc[head], partner, length)
        windows = size - length + 1
        at = gather(start, windows)
        cut = np.cumsum(windows) - windows
        low, high = np.minimum.reduceat(least[at], cut), np.maximum.reduceat(least[at], cut)
        string = np.cumsum(new) - 1
        whole = np.flatnonzero(high[string] < doc)
        rows = [(batch[whole], content[whole], np.zeros(len(whole), np.int64), windows[string[whole]])]
        for i in np.flatnonzero((high[string] >= doc) & (low[string] < doc)).tolist():
            s = string[i]
            hit = np.flatnonzero(np.diff(least[start[s]:start[s] + windows[s]] < doc[i], prepend=False, append=False))
            n = len(hit) // 2
            rows.append((np.full(n, batch[i]), np.full(n, content[i]), hit[0::2], hit[1::2]))
        batch, content, first, end = (np.concatenate([r[i] for r in rows]) for i in range(4))
        order = np.argsort(batch, kind="stable")
        batch, content, first, end = batch[order], content[order], first[order], end[order]
        cut = np.append(np.flatnonzero(np.diff(batch, prepend=-1)), len(batch))
        return pa.table({
            "_batch": pa.array(batch[cut[:-1]].astype(np.int32)),
            "_found": pa.array([content[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            "_from": pa.array([first[a:b].astype(np.uint8).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary()),
            "_to": pa.array([end[a:b].astype(np.uint8).tobytes() for a, b in zip(cut[:-1], cut[1:])], pa.binary())})
    return run


# --- 3: the cut --------------------------------------------------------------------------

OUT = [("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())]


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Marks of characters whose bytes are all marked."""
    head = np.flatnonzero((data & 0xC0) != 0x80)
    if not len(head):
        return gone
    return np.repeat(np.logical_and.reduceat(gone, head), np.diff(np.append(head, len(data))))


def _cut(buckets: int, length: int, carried: list[str], whole_characters: bool):
    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        if not docs.num_rows:
            kinds = [docs.schema.field(c) for c in carried] + [pa.field(*x) for x in OUT]
            return pa.schema(kinds).empty_table()
        marks = told.filter(pa.compute.is_valid(told.column("_grams")))
        found = told.filter(pa.compute.is_valid(told.column("_found")))
        shared = Shared(marks, buckets)
        content, first, end = (np.frombuffer(b"".join(found.column(c).to_pylist()), kind) for c, kind in (
            ("_found", U64), ("_from", np.uint8), ("_to", np.uint8)))
        order = np.argsort(content, kind="stable")
        content, first, end = content[order], first[order].astype(np.int64), end[order].astype(np.int64)
        ids = _ids(docs)
        held = list(_shared_parts(docs, shared, length))
        # of equal runs in the batch, all but those of the smallest document are repeats
        every = np.concatenate([h[8] for h in held])
        doc = np.concatenate([ids[h[0] + h[2]] for h in held])
        _, which = np.unique(every, return_inverse=True)
        least = np.full(which.max() + 1 if len(which) else 0, np.iinfo(np.int64).max)
        np.minimum.at(least, which, doc)
        repeat = least[which] < doc
        release()
        out, done = [], 0
        for _, texts, part, _, _, low, high, _, hashes in held:
            change = np.zeros(len(texts.data) + 1, np.int32)
            again = repeat[done:done + len(part)]
            done += len(part)
            np.add.at(change, low[again], 1)
            np.add.at(change, high[again] + length, -1)
            a, b = np.searchsorted(content, hashes, "left"), np.searchsorted(content, hashes, "right")
            b = np.where(again, a, b)
            owner, each = np.repeat(np.arange(len(part)), b - a), gather(a, b - a)
            np.add.at(change, low[owner] + first[each], 1)
            np.add.at(change, low[owner] + end[each] - 1 + length, -1)
            gone = np.cumsum(change[:-1]) > 0
            if whole_characters:
                gone = _whole_characters(texts.data, gone)
            for i, (x, y) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist())):
                mine = gone[x:y]
                if mine.any():
                    edge = np.flatnonzero(np.diff(mine, prepend=False, append=False))
                    out.append((y - x, edge[0::2], edge[1::2], texts.data[x:y][~mine].tobytes()))
                else:
                    out.append((y - x, (), (), texts.data[x:y].tobytes()))
        size, starts, ends, kept = zip(*out)
        return pa.table([*(docs.column(c) for c in carried),
                         *(pa.array(x, kind) for x, (_, kind) in zip((size, starts, ends, kept), OUT))],
                        names=[*carried, *(name for name, _ in OUT)])
    return run


def _zipped(batches):
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        packed = [pack.compress(t) for t in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary()),
                                          *batch.columns[3:]], names=["_id", "_batch", "_zip", *batch.schema.names[3:]])


def remove(docs: DataFrame, length: int = LENGTH, hot: int = HOT, batch_bytes: int = BATCH, id_col: str = "doc_id",
           text_col: str = "text", carry: list[str] | None = None, whole_characters: bool = False) -> DataFrame:
    """A row for every row of ``docs``: its columns named in ``carry`` (by default the id),
    ``n_bytes``, the removed byte spans ``starts`` and ``ends``, and the bytes ``kept``.
    With ``whole_characters`` a character goes only if all its bytes do, so that
    ``kept`` is text."""
    if not GRAM <= length <= 255 + GRAM:
        raise ValueError(f"length must be from {GRAM} to {255 + GRAM}")
    carry = [id_col] if carry is None else carry
    carried = [f"_c{i}" for i in range(len(carry))]
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("_id"), text.alias("_text"),
                       *(F.col(c).alias(x) for c, x in zip(carry, carried)))
    total = rows.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    n = int(total // batch_bytes) + 1
    dealt = rows.select("_id", F.pmod(F.xxhash64("_id", "_text"), F.lit(n)).cast("int").alias("_batch"), "_text", *carried)
    kinds = "".join(f", {x} {rows.schema[x].dataType.simpleString()}" for x in carried)
    # read three times below, by one exchange
    texts = dealt.mapInArrow(_zipped, "_id long, _batch int, _zip binary" + kinds)
    grams = texts.groupBy("_batch").applyInArrow(
        _list_grams(n, length), "_bucket int, _batch int, _grams binary, _docs binary")
    shared = grams.groupBy("_bucket").applyInArrow(
        _share(hot), "_batch int, _bucket int, _grams binary, _hot binary")
    sent = texts.groupBy("_batch").cogroup(shared.groupBy("_batch")).applyInArrow(
        _send_runs(n, SHARDS * n, length), "_shard int, _batch int, _runs binary")
    found = sent.groupBy("_shard").applyInArrow(
        _sort_shard(length), "_batch int, _found binary, _from binary, _to binary")
    told = shared.unionByName(found, allowMissingColumns=True)
    out = texts.groupBy("_batch").cogroup(told.groupBy("_batch")).applyInArrow(
        _cut(n, length, carried, whole_characters),
        f"{kinds[2:]}, n_bytes long, starts array<long>, ends array<long>, kept binary")
    return out.withColumnsRenamed(dict(zip(carried, carry)))
