"""Suffix arrays by induced sorting, with array operations.

Suffixes are classified (S smaller, L larger than the next one). The leftmost
S suffixes of each run (LMS) cut the text into substrings, which are sorted by
one induction and named; if names repeat, the text of names is sorted
recursively. A second induction from the sorted LMS suffixes gives the array in
linear work. An induction goes through the symbols in order and moves all
suffixes of a symbol at once, so its overhead is per symbol, not per suffix;
names are written as two digits of a smaller alphabet to keep symbols few.

Permuted common prefixes (in text order, against the suffix before in the
array) are clipped to the length that the caller asks for.
"""

from __future__ import annotations

import numpy as np

from mixtape.llm.textscan import U64, mix

#: Texts of names below this length, or that names don't shorten, are sorted by doubling:
#: there the overhead per symbol outweighs the linear work.
SHORT = 50_000


def suffix_array(text: np.ndarray) -> np.ndarray:
    """The suffix array of an integer text of values from 0; the end is smaller than all."""
    n = len(text)
    if n < SHORT:
        return _doubling(text)
    # half the memory traffic as long as places fit
    text = np.ascontiguousarray(text, np.int32 if n < 1 << 31 else np.int64)
    symbols = int(text.max()) + 1
    small, lms = _classify(text)
    if not len(lms):
        return _induce(text, symbols, small, lms)
    order = _induce(text, symbols, small, lms)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sorted_lms = order[is_lms[order]]
    names = _names(text, lms, sorted_lms)
    k = int(names.max()) + 1
    if k == len(lms):
        return _induce(text, symbols, small, sorted_lms)
    base = int(np.ceil(np.sqrt(k)))
    if 2 * len(names) >= 0.9 * n:
        # names as two digits would not be shorter than the text
        reduced = _doubling(names)
    else:
        digits = np.empty(2 * len(names), text.dtype)
        digits[0::2], digits[1::2] = names // base, names % base
        reduced = suffix_array(digits)
        reduced = reduced[reduced % 2 == 0] // 2
    return _induce(text, symbols, small, lms[reduced])


def _classify(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each suffix is S, the LMS places in text order)."""
    n = len(text)
    step = np.sign(np.diff(text, append=-1))
    # equal symbols take the type of the run's end
    at = np.where(step != 0, np.arange(n, dtype=text.dtype), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    small = step[at] > 0
    lms = (np.flatnonzero(small[1:] & ~small[:-1]) + 1).astype(text.dtype)
    return small, lms


def _names(text: np.ndarray, lms: np.ndarray, sorted_lms: np.ndarray) -> np.ndarray:
    """The rank of each LMS substring (in text order); equal substrings share it."""
    n = len(text)
    end = np.minimum(np.append(lms[1:], n - 1), n - 1) + 1
    # a polynomial hash of each substring; neighbours share the symbol at their border
    size = end - lms
    base = U64(0xD6E8FEB86659FD93)
    powers = np.cumprod(np.concatenate([[U64(1)], np.full(int(size.max()), base)]))
    symbol = mix(np.arange(1, int(text.max()) + 2, dtype=U64) * U64(0x9E3779B97F4A7C15))
    inner = np.diff(np.append(lms, n))
    place = np.arange(n - lms[0], dtype=np.int32) - np.repeat((lms - lms[0]).astype(np.int32), inner)
    weighed = symbol[text[lms[0]:]]
    weighed *= powers[np.minimum(place, len(powers) - 1)]
    print_ = np.add.reduceat(weighed, lms - lms[0])
    border = size > inner
    print_[border] += symbol[text[end[border] - 1]] * powers[size[border] - 1]
    print_ = mix(print_ + size.astype(U64))
    # the last substring ends with the text and is like no other
    print_[-1] ^= U64(0xA5A5A5A5)
    slot = np.empty(n, np.int64)
    slot[lms] = np.arange(len(lms))
    sorted_slots = slot[sorted_lms]
    p = print_[sorted_slots]
    rank = np.cumsum(np.concatenate([[0], (p[1:] != p[:-1]).astype(np.int64)]))
    names = np.empty(len(lms), np.int64)
    names[sorted_slots] = rank
    return names


def _induce(text: np.ndarray, symbols: int, small: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """The suffixes in the order that the given order of LMS suffixes induces."""
    n = len(text)
    count = np.bincount(text, minlength=symbols)
    start = np.cumsum(count) - count
    larger = np.bincount(text[~small], minlength=symbols)
    sa = np.full(n, -1, text.dtype)
    # LMS suffixes by symbol, in their order
    first = text[lms]
    by_symbol = lms[np.argsort(first, kind="stable")]
    lms_end = np.cumsum(np.bincount(first, minlength=symbols))
    lms_start = lms_end - np.bincount(first, minlength=symbols)
    kind = np.uint8 if symbols < 1 << 8 else np.uint16 if symbols < 1 << 16 else np.int64
    skip = np.iinfo(kind).max
    # the symbol before each place (and before the end) where it is of the wanted type
    before_l, before_s = np.full(n + 1, skip, kind), np.full(n + 1, skip, kind)
    before_l[1:][~small] = text[~small]
    before_s[1:][small] = text[small]

    def put(sources, head, sign):
        """Places the suffixes before the sources at the heads of their symbols."""
        symbol = (before_l if sign > 0 else before_s)[sources]
        wanted = symbol != skip
        target, symbol = sources[wanted] - 1, symbol[wanted]
        if not len(target):
            return
        order = np.argsort(symbol, kind="stable")
        symbol, target = symbol[order], target[order]
        cut = np.append(np.flatnonzero(symbol[1:] != symbol[:-1]) + 1, len(symbol))
        first = np.concatenate([[0], cut[:-1]])
        each = cut - first
        heads = symbol[first]
        if len(cut) * 64 > len(symbol):
            place = np.repeat(head[heads] - sign * first, each) + sign * np.arange(len(symbol))
            sa[place] = target
        else:
            for c, at, to in zip(heads.tolist(), first.tolist(), cut.tolist()):
                if sign > 0:
                    sa[head[c]:head[c] + to - at] = target[at:to]
                else:
                    sa[head[c] - to + at + 1:head[c] + 1] = target[at:to][::-1]
        head[heads] += sign * each

    head = start.copy()
    put(np.array([n], text.dtype), head, 1)
    for c in range(symbols):
        done = start[c]
        while done < head[c]:
            upto = head[c]
            put(sa[done:upto], head, 1)
            done = upto
        put(by_symbol[lms_start[c]:lms_end[c]], head, 1)
    tail = start + count - 1
    for c in range(symbols - 1, -1, -1):
        done = start[c] + count[c] - 1
        while done > tail[c]:
            downto = tail[c]
            put(sa[downto + 1:done + 1][::-1], tail, -1)
            done = downto
        put(sa[start[c]:start[c] + larger[c]][::-1], tail, -1)
    return sa


def _doubling(text: np.ndarray) -> np.ndarray:
    n = len(text)
    if n < 2:
        return np.arange(n)
    rank, width = np.unique(text, return_inverse=True)[1].astype(np.int64), 1
    while True:
        after = np.full(n, -1, np.int64)
        after[:n - width] = rank[width:] if width < n else []
        key = rank * (n + 1) + after + 1
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(np.diff(key[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if fresh[-1] == n - 1:
            return order
        width = min(2 * width, n)


def common_prefixes(data: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """For each place of a byte text, the length that its suffix shares with the suffix
    before it in the array, clipped to ``most``; 0 for the first suffix."""
    n = len(data)
    before = np.full(n, -1, sa.dtype)
    before[sa[1:]] = sa[:-1]
    padded = np.concatenate([data.astype(np.uint8), np.zeros(most + 16, np.uint8)])
    # the eight bytes from each place as one number, lowest first
    words = np.ndarray(n + most + 8, "<u8", padded, strides=(1,))
    out = np.zeros(n, np.int32)
    for part in range(0, n, 1 << 19):
        left = part + np.flatnonzero(before[part:part + (1 << 19)] >= 0)
        other = before[left].astype(np.int64)
        limit = np.minimum(n - np.maximum(left, other), most)
        for at in range(0, most, 8):
            differ = words[left + at] ^ words[other + at]
            lowest = differ & (~differ + U64(1))
            run = np.where(differ == 0, 8, (np.frexp(lowest.astype(np.float64))[1] - 1) // 8)
            out[left] = np.minimum(at + run, limit)
            go = (run == 8) & (at + 8 < limit)
            left, other, limit = left[go], other[go], limit[go]
            if not len(left):
                break
    return out
