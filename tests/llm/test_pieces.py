"""Sentencepiece encoding and decoding against the library itself."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from sentencepiece import SentencePieceProcessor

from mixtape.llm import pieces, queries
from mixtape.llm.textscan import texts_of

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  ", "a", " a", "a ", "▁", "▁a", "a▁b", "\n\n", "日本語テキスト", "😀👩‍👩‍👧", "<s>", "<0x41>", "\0", "aaaa" * 3000,
       " " * 3000, "é", "ﬁ", "﻿x", "12345 678", "\t\t a", "</s> x", "naïve café", "x" * 20000 + " y"]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PATH)


def own_ids(model, texts, check=True):
    ids, at = model.encode(texts_of(pa.array(texts, pa.string())), check)
    return [ids[a:b].tolist() for a, b in zip(at, at[1:])]


def test_odd_texts(library):
    model = pieces.Model(PATH)
    assert own_ids(model, ODD) == library.encode(ODD)
    assert own_ids(model, ODD, check=False) == library.encode(ODD)       # now from the kept runs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=6))
def test_any_texts(library, texts):
    model = pieces.model(PATH)
    got = own_ids(model, texts, check=False)
    assert got == library.encode(texts)
    assert model.decode(got) == library.decode(got)


def test_agenda_of_whole_texts(library):
    """The agenda alone, with nothing cut before it."""
    model = pieces.Model(PATH)
    rnd = random.Random(5)
    texts = ["".join(rnd.choice("ab e\nthe in1é日😀") for _ in range(rnd.randint(1, 400))) for _ in range(100)]
    for text in texts:
        assert model.agenda("▁" + text.replace(" ", "▁")) == library.encode(text)


def test_any_ids(library):
    model = pieces.Model(PATH)
    rnd = random.Random(2)
    lists = [[rnd.choice([0, 1, 2, rnd.randrange(3, 259), rnd.randrange(32000), 29871, 259]) for _ in range(rnd.randint(0, 8))]
             for _ in range(5000)]
    assert model.decode(lists, check=False) == library.decode(lists)


def test_check_finds_differences():
    model = pieces.Model(PATH)
    model.agenda = lambda run: [5] * len(run)
    with pytest.raises(ValueError, match="other ids"):
        own_ids(model, ["some words"])
    model.surfaces[7] = b"?"
    with pytest.raises(ValueError, match="another text"):
        model.decode([[7]])


def test_caches_start_afresh(monkeypatch, library):
    monkeypatch.setattr(pieces, "KEPT_RUNS", 10)
    monkeypatch.setattr(pieces, "KEPT_WORDS", 10)
    model = pieces.Model(PATH)
    for i in range(20):
        texts = [f"word{i} other{j} things" for j in range(5)]
        assert own_ids(model, texts) == library.encode(texts)
    assert len(model.runs) < 100 and len(model.seen) < 100


def test_broken_bytes():
    model = pieces.Model(PATH)
    ids, at = model.encode(texts_of(pa.array([b"a\xff b", b"ok"])))
    assert model.decode([ids[:at[1]].tolist(), ids[at[1]:].tolist()]) == ["a� b", "ok"]


def test_table(frame, library):
    rows = [(1, "some text"), (1, "some text"), (None, "no id"), (3, None), (4, ""), (5, "y" * 50000), (-6, "a  b\nc")]
    got = pieces.round_trip(frame(rows), PATH).collect()
    want = sorted(((i, library.encode(t or ""), t or "") for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.ids, r.decoded) for r in got), key=str) == want
    tokens = pieces.encode(frame(rows), PATH)
    assert sorted(((r.doc_id, r.ids) for r in tokens.collect()), key=str) == sorted([w[:2] for w in want], key=str)
    back = pieces.decode(tokens, PATH)
    assert sorted(((r.doc_id, r.decoded) for r in back.collect()), key=str) == sorted([(w[0], w[2]) for w in want], key=str)
    assert pieces.round_trip(frame([]), PATH).count() == 0


def test_decode_null_lists(spark):
    df = spark.createDataFrame([(1, None), (2, [306, None, 306])], "doc_id long, ids array<int>")
    got = {r.doc_id: r.decoded for r in pieces.decode(df, PATH).collect()}
    assert got == {1: "", 2: SentencePieceProcessor(model_file=PATH).decode([306, 306])}


def test_query(spark, sf_smoke, documents, library):
    got = {r.doc_id: r for r in queries.QUERIES["op13_sentencepiece"](spark, sf_smoke).collect()}
    assert len(got) == len(documents)
    for doc_id, text in documents:
        ids = library.encode(text or "")
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()
