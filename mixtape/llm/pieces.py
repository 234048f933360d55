"""Token ids of whole texts with a merge-type (BPE) sentencepiece model, and back.

Encoding follows the model's definition: white space becomes a mark, the
characters are the first symbols, and an agenda of adjacent symbol pairs that
spell a piece, ordered by score and then by place, merges the best pair until
none is left; what no piece spells falls back to the bytes of its UTF-8 form.

Two neighbouring characters that stand side by side in no piece can't end up in
one symbol, so texts are cut there, every distinct run between two cuts goes
through the agenda once per Python worker, and ids are put together with array
operations. Nothing is assumed about words beyond the vocabulary itself. Each
worker compares, batch by batch, what it made with the sentencepiece library:
every distinct word (a run of marks with what follows it) is encoded by both,
and whole id lists are decoded by both; a difference raises an error.

Defined results: a null or empty text has no ids and decodes to an empty text;
null document ids and repeated rows stay; other columns are left out. A worker
keeps ``KEPT_RUNS`` runs and ``KEPT_WORDS`` word hashes at most, then starts
afresh. Runs and words are known by 64-bit hash and length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mixtape.llm.textscan import U64, Texts, gather, mix, powers, slices

MARK = 0x2581
KEPT_RUNS = 1_000_000
KEPT_IDS = 8_000_000
KEPT_WORDS = 4_000_000
UNICODE = 0x110000

_models: dict[str, "Model"] = {}


def model(path: str) -> "Model":
    """The worker's copy of a model file."""
    if path not in _models:
        _models[path] = Model(path)
    return _models[path]


class Known:
    """Sorted 64-bit keys with a few numbers each; new ones go to a small table that is
    merged into the large one now and then."""

    def __init__(self, columns: int):
        self.none = (np.zeros(0, U64), *[np.zeros(0, np.int64)] * columns)
        self.clear()

    def __len__(self) -> int:
        return len(self.old[0]) + len(self.young[0])

    def clear(self) -> None:
        self.old, self.young = self.none, self.none

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, ...]:
        """(found, the numbers of each key, 0 where it isn't found)."""
        out = [np.zeros(len(keys), bool), *[np.zeros(len(keys), np.int64) for _ in self.none[1:]]]
        for known, *values in (self.old, self.young):
            if len(known):
                i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[i] == keys
                out[0] |= hit
                for to, value in zip(out[1:], values):
                    to[hit] = value[i[hit]]
        return tuple(out)

    def add(self, keys: np.ndarray, *values: np.ndarray) -> None:
        """Keys that ``find`` didn't know."""
        self.young = self._merged(self.young, (keys, *values))
        if len(self.young[0]) > max(1 << 16, len(self.old[0]) // 2):
            self.old, self.young = self._merged(self.old, self.young), self.none

    @staticmethod
    def _merged(a, b):
        both = [np.concatenate(x) for x in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)


class Model:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = sp = SentencePieceProcessor(model_file=path)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids = [sp.unk_id()] * 256
        self.surfaces: list[bytes] = []
        self.is_byte = np.zeros(sp.get_piece_size(), bool)
        self.silent: set[int] = set()
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[1:-1], 16)] = i
                self.is_byte[i] = True
                self.surfaces.append(bytes([int(piece[1:-1], 16)]))
            elif sp.is_unknown(i) or sp.is_control(i):
                self.surfaces.append(sp.decode([i]).encode() if sp.is_unknown(i) else b"")
                if sp.is_control(i):
                    self.silent.add(i)
            elif sp.is_unused(i):
                raise ValueError("a model with unused pieces isn't supported")
            else:
                self.scores[piece], self.ids[piece] = sp.get_score(i), i
                self.surfaces.append(piece.replace(chr(MARK), " ").encode())
        if not self.is_byte.any():
            raise ValueError("a model without byte pieces isn't supported")
        if sp.normalize("ﬁ  x ") not in (f"{chr(MARK)}ﬁ{chr(MARK) * 2}x{chr(MARK)}", f"ﬁ{chr(MARK) * 2}x{chr(MARK)}"):
            raise ValueError("a model that changes texts before it cuts them isn't supported")
        self.prefix = sp.normalize("x") != "x"
        self._pairs()
        #: no piece goes over the start of a word, so words can be compared on their own
        self.words = not any(chr(MARK) in p.lstrip(chr(MARK)) for p in self.ids)
        self.runs, self.seen = Known(2), Known(0)
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0

    def _pairs(self) -> None:
        """Which characters stand side by side in some piece."""
        chars = sorted({c for p in self.ids if len(p) > 1 for c in p})
        self.char_class = np.zeros(UNICODE, np.uint16)
        self.char_class[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.ids:
            c = self.char_class[[ord(x) for x in p]]
            self.beside[c[:-1], c[1:]] = True

    def agenda(self, run: str) -> list[int]:
        """The ids of one run of characters."""
        parts, scores = list(run), self.scores
        n = len(parts)
        if n > 1:
            after, before = list(range(1, n + 1)), list(range(-1, n - 1))
            queue = []
            for i in range(n - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None:
                    queue.append((-score, i, i + 1, 2))
            heapq.heapify(queue)
            while queue:
                _, a, b, size = heapq.heappop(queue)
                if not parts[a] or not parts[b] or len(parts[a]) + len(parts[b]) != size:
                    continue        # one of the two has been merged meanwhile
                parts[a] += parts[b]
                parts[b] = ""
                c = after[a] = after[b]
                if c < n:
                    before[c] = a
                    score = scores.get(parts[a] + parts[c])
                    if score is not None:
                        heapq.heappush(queue, (-score, a, c, size + len(parts[c])))
                z = before[a]
                if z >= 0:
                    score = scores.get(parts[z] + parts[a])
                    if score is not None:
                        heapq.heappush(queue, (-score, z, a, len(parts[z]) + size))
        out = []
        for part in parts:
            if part:
                i = self.ids.get(part)
                if i is None:
                    out += [self.byte_ids[x] for x in part.encode("utf-8")]
                else:
                    out.append(i)
        return out

    def _learn(self, keys: np.ndarray, runs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [self.agenda(run) for run in runs]
        count = np.fromiter(map(len, got), np.int64, len(got))
        ids = np.fromiter((x for one in got for x in one), np.int32, int(count.sum()))
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used:self.used + len(ids)] = ids
        where = self.used + np.cumsum(count) - count
        self.used += len(ids)
        self.runs.add(keys, where, count)
        return where, count

    def encode(self, texts: Texts, check: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text in them)."""
        if not len(texts.data):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64)
        if len(self.runs) > KEPT_RUNS or self.used > KEPT_IDS:
            self.runs.clear()
            self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        chars, at = self._characters(texts)
        opens = np.zeros(len(chars), bool)
        opens[at[:-1][np.diff(at) > 0]] = True
        kind = self.char_class[chars]
        cut = opens.copy()
        cut[1:] |= ~self.beside[kind[:-1], kind[1:]]
        starts = np.flatnonzero(cut)
        hashes = self._hasher(chars)
        keys, first, which = np.unique(hashes(starts, len(chars)), return_index=True, return_inverse=True)
        found, where, count = self.runs.find(keys)
        new = np.flatnonzero(~found)
        text = chars.tobytes().decode("utf-32-le") if len(new) or check else ""
        if len(new):
            ends = np.append(starts[1:], len(chars))
            where[new], count[new] = self._learn(
                keys[new], [text[a:b] for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist())])
        lengths = count[which]
        ids = self.flat[gather(where[which], lengths)]
        ends_at = np.concatenate([[0], np.cumsum(lengths)])
        if check:
            if self.words:
                marks = chars == MARK
                opens[1:] |= marks[1:] & ~marks[:-1]
            words = np.flatnonzero(opens)
            self._check(text, hashes(words, len(chars)), words, ids, ends_at[np.searchsorted(starts, np.append(words, len(chars)))])
        return ids, ends_at[np.searchsorted(starts, at)]

    def _characters(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(characters of all texts with marks, offsets of each text in them)."""
        raw = texts.data.tobytes()
        try:
            chars = np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), "<u4")
            at = np.concatenate([[0], np.cumsum((texts.data & 0xC0) != 0x80)])[texts.offsets]
        except UnicodeDecodeError:      # not text: broken bytes count as replacement characters
            own = [raw[a:b].decode("utf-8", "replace") for a, b in zip(texts.offsets, texts.offsets[1:])]
            chars = np.frombuffer("".join(own).encode("utf-32-le"), "<u4")
            at = np.concatenate([[0], np.cumsum([len(x) for x in own])]).astype(np.int64)
        chars = np.where(chars == 32, np.uint32(MARK), chars)
        if self.prefix:
            full = np.diff(at) > 0
            chars = np.insert(chars, at[:-1][full], MARK)
            at = at + np.concatenate([[0], np.cumsum(full)])
        return chars.astype("<u4", copy=False), at

    @staticmethod
    def _hasher(chars: np.ndarray):
        up, down = powers(len(chars) + 1)
        sums = np.zeros(len(chars) + 1, U64)
        np.cumsum((mix(chars.astype(U64) + U64(1)) | U64(1)) * up[:len(chars)], out=sums[1:])

        def hashes(starts: np.ndarray, end: int) -> np.ndarray:
            ends = np.append(starts[1:], end)
            return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))
        return hashes

    def _check(self, text: str, hashes: np.ndarray, starts: np.ndarray, ids: np.ndarray, at: np.ndarray) -> None:
        """The library's ids of every word that this worker hasn't compared yet."""
        if len(self.seen) > KEPT_WORDS:
            self.seen.clear()
        keys, first = np.unique(hashes, return_index=True)
        new = ~self.seen.find(keys)[0]
        keys, first = keys[new], first[new]
        ends = np.append(starts[1:], len(text))
        skip = 1 if self.prefix else 0       # the library puts the first mark back
        alone = (ends[first] - starts[first]) == skip
        first = first[~alone]
        words = [text[a + skip:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        theirs = self.library.encode(words, num_threads=1) if words else []
        count = np.fromiter(map(len, theirs), np.int64, len(theirs))
        flat = np.fromiter((x for one in theirs for x in one), np.int32, int(count.sum()))
        own = at[first + 1] - at[first]
        if not (np.array_equal(own, count) and np.array_equal(ids[gather(at[first], own)], flat)):
            for word, a, n, want in zip(words, at[first].tolist(), own.tolist(), theirs):
                if ids[a:a + n].tolist() != want:
                    raise ValueError(f"the sentencepiece library gives other ids for {word[:80]!r}")
        self.seen.add(keys)

    def decode(self, lists: list[list[int]], check: bool = True) -> list[str]:
        """The texts of id lists."""
        out = [self._text(ids) for ids in lists]
        if check and lists and self.library.decode(lists) != out:
            raise ValueError("the sentencepiece library gives another text")
        return out

    def _text(self, ids: list[int]) -> str:
        try:
            if not self.silent.isdisjoint(ids):     # they end a run of byte pieces
                text = self._broken(ids)
            else:
                text = b"".join(map(self.surfaces.__getitem__, ids)).decode("utf-8")
        except UnicodeDecodeError:
            text = self._broken(ids)
        if self.prefix and text[:1] == " ":
            first = next((i for i in ids if self.surfaces[i]), None)
            if first is not None and not self.is_byte[first] and first != self.library.unk_id():
                text = text[1:]
        return text

    def _broken(self, ids: list[int]) -> str:
        """Byte pieces that are no text: each byte outside a character is a replacement character."""
        out, run = [], b""
        for i in [*ids, None]:
            if i is not None and self.is_byte[i]:
                run += self.surfaces[i]
                continue
            while run:
                for n in (1, 2, 3, 4):
                    try:
                        out.append(run[:n].decode("utf-8"))
                        break
                    except UnicodeDecodeError:
                        pass
                else:
                    n = 1
                    out.append("�")
                run = run[n:]
            if i is not None:
                out.append(self.surfaces[i].decode("utf-8"))
        return "".join(out)


def _encoded(docs: DataFrame, path: str, id_col: str, text_col: str, decoded: bool, check: bool) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for part, texts in slices(batch, "text"):
                ids, at = own.encode(texts, check)
                columns = [part.column(0), pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids, pa.int32()))]
                if decoded:
                    flat = ids.tolist()
                    lists = [flat[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                    columns.append(pa.array(own.decode(lists, check), pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "ids", "decoded"][:len(columns)])

    schema = f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>" + ", decoded string" * decoded
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(id, ids) of every document with the model file at ``path``."""
    return _encoded(docs, path, id_col, text_col, False, check)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", check: bool = True) -> DataFrame:
    """(id, ids, decoded): the ids of every document and the text that they decode to, in one pass."""
    return _encoded(docs, path, id_col, text_col, True, check)


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids", check: bool = True) -> DataFrame:
    """(id, decoded) of id lists; null lists and null ids inside them count for nothing."""
    rows = tokens.select(F.col(id_col).alias("id"), F.coalesce(F.array_compact(ids_col), F.array().cast("array<int>")).cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = own.decode(part.column(1).to_pylist(), check)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["id", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, decoded string").withColumnRenamed("id", id_col)
