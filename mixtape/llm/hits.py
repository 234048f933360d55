"""Per-text hits with the words around them, for searches that verify later.

A scan meets each whole text once and sends on, for texts with hits, the hits
and the hashes of the words near them; so a verification needs neither the text
again nor a shuffle of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from mixtape.llm.textscan import Words


def near(words: Words, hits: np.ndarray, before: int, after: int) -> np.ndarray:
    """Word numbers within ``before`` words before and ``after`` from a hit on, in its text; sorted."""
    if not len(hits):
        return np.zeros(0, np.int64)
    text = words.text[hits]
    start = np.maximum(hits - before, words.first[text])
    end = np.minimum(hits + after, words.first[text + 1])
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, end, -1)
    return np.flatnonzero(np.cumsum(change[:-1]) > 0)


def lists(values: np.ndarray, text: np.ndarray, n: int) -> pa.ListArray:
    """Values (sorted by their text) as one list per text."""
    cut = np.searchsorted(text, np.arange(n + 1)).astype(np.int32)
    if values.dtype == np.uint64:
        values = values.view(np.int64)
    return pa.ListArray.from_arrays(pa.array(cut), pa.array(values))
