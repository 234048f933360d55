"""Token ids of whole texts with a public tokenizer file, by the ``tokenizers`` library.

Words repeat a lot, so texts are cut into pieces that the tokenizer treats on
their own, each distinct piece is encoded once per Python worker, and ids are
assembled with array operations. A piece ends before ASCII white space that
follows something else, and between an ASCII letter and ASCII punctuation other
than an apostrophe: neither tokenizer family here (byte level with an optional
leading space; lower-cased words with white space dropped) makes a token across
such a point. The cache of a worker is bounded by ``CACHE_PIECES``.
Strings of special tokens inside a text are ordinary text. Pieces are known by
64-bit hash and length.
"""

from __future__ import annotations

import os

import numpy as np

from mixtape.llm.textscan import ASCII_LOWER, NO_FOLD, NOT_SPACE, Texts, gather, range_hashes

#: Distinct pieces that a worker keeps; beyond it the cache starts afresh.
CACHE_PIECES = 1_000_000

LETTERS = (ASCII_LOWER >= 97) & (ASCII_LOWER <= 122)
PUNCTUATION = (NO_FOLD > 32) & (NO_FOLD < 127) & ~LETTERS & ~((NO_FOLD >= 48) & (NO_FOLD <= 57)) & (NO_FOLD != 39)

_encoders: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's encoder of a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        # a tokenizer that neither sees case nor white space: neither do the keys
        self.loose = self._plain(" Ab\n c") == self._plain("ab c")
        self.clear()

    def _plain(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.old, self.young = none, none
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(where, count) of each key, count -1 if unknown."""
        where, count = np.zeros(len(keys), np.int64), np.full(len(keys), -1)
        for known, at, n in (self.old, self.young):
            if len(known):
                i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[i] == keys
                where[hit], count[hit] = at[i[hit]], n[i[hit]]
        return where, count

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]
        count = np.fromiter(map(len, got), np.int64, len(got))
        flat = np.fromiter((x for ids in got for x in ids), np.uint32, int(count.sum()))
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(flat)] = flat
        where = self.used + np.cumsum(count) - count
        self.used += len(flat)
        self.young = self._merge(self.young, (keys, where, count))
        if len(self.young[0]) > max(1 << 16, len(self.old[0]) // 2):
            self.old, self.young = self._merge(self.old, self.young), self.young
            self.young = tuple(x[:0] for x in self.young)
        return where, count

    @staticmethod
    def _merge(a, b):
        both = [np.concatenate(x) for x in zip(a, b)]
        order = np.argsort(both[0], kind="stable")
        return tuple(x[order] for x in both)

    def encode(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text in them)."""
        data, n = texts.data, len(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(n + 1, np.int64)
        if len(self.old[0]) + len(self.young[0]) > CACHE_PIECES:
            self.clear()
        cut = np.zeros(len(data), bool)
        before, here = data[:-1], data[1:]
        cut[1:] = (~NOT_SPACE[here] & NOT_SPACE[before]) | (PUNCTUATION[here] & LETTERS[before])
        cut[texts.offsets[:-1][texts.offsets[:-1] < len(data)]] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(data))
        if self.loose:
            heads = starts + ~NOT_SPACE[data[starts]]
        else:
            heads = starts
        hashes = range_hashes(data, heads, ends, ASCII_LOWER if self.loose else NO_FOLD)
        keys, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        where, count = self._find(keys)
        new = np.flatnonzero(count < 0)
        if len(new):
            raw = data.tobytes()
            pieces = [raw[s:e].decode("utf-8") for s, e in zip(heads[first[new]].tolist(), ends[first[new]].tolist())]
            where[new], count[new] = self._learn(keys[new], pieces)
        lengths = count[which]
        ids = self.ids[gather(where[which], lengths)]
        ends_at = np.concatenate([[0], np.cumsum(lengths)])
        return ids, ends_at[np.searchsorted(starts, texts.offsets)]
