import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from mixtape.llm import textscan as ts

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB 1.\n\té\x00'", max_size=40)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(rows):
    batch = pa.record_batch({"t": pa.array(rows, pa.string())})
    for pattern, mask in ((r"[^\x20\x09-\x0D]+", ts.NOT_SPACE), (r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", ts.WORD_BYTES)):
        got = []
        for _, texts in ts.slices(batch, "t", size=16):
            words = ts.scan(texts, mask)
            for i in range(len(texts)):
                got.append([texts.data[s:e].tobytes().decode() for s, e in zip(
                    words.starts[words.first[i]:words.first[i + 1]], words.ends[words.first[i]:words.first[i + 1]])])
        assert got == [re.findall(pattern, t or "") for t in rows]


def test_hashes_depend_on_content_alone():
    data = np.frombuffer(b"the cat and the cat, THE CAT", np.uint8)
    at = np.array([0, 12, 21])
    plain = ts.range_hashes(data, at, at + 7)
    assert plain[0] == plain[1] != plain[2]
    assert len(set(ts.range_hashes(data, at, at + 7, ts.ASCII_LOWER).tolist())) == 1
    grams = ts.ngrams(plain[[0, 1, 2, 0, 1, 2]], 3)
    assert grams[0] == grams[3] != grams[2]
    assert len(ts.ngrams(plain, 4)) == 0


def test_empty_and_sliced_columns():
    assert len(ts.texts_of(pa.array([], pa.string()))) == 0
    whole = pa.array(["ab", None, "", "cde"])
    texts = ts.texts_of(whole[1:])
    assert texts.offsets.tolist() == [0, 0, 0, 3] and texts.data.tobytes() == b"cde"
    assert list(ts.slices(pa.record_batch({"t": pa.array([], pa.string())}), "t")) == []
