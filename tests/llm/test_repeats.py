import hashlib
import random

import pyarrow as pa
import pytest
import zstandard

from mixtape.llm import queries, repeats


def brute(rows, length=50):
    """(bytes, removed, spans, kept) of every row, by a table of all strings."""
    first = {}
    low = -(1 << 63)
    for doc, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - length + 1):
            key = raw[i:i + length]
            first[key] = min(first.get(key, 1 << 62), low if doc is None else doc)
    out = []
    for doc, text in rows:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < (low if doc is None else doc):
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(raw, gone) if not g)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(raw), sum(gone), spans, kept))
    return sorted(out, key=str)


def found(df, **options):
    return sorted(((r.doc_id, r.n_bytes, sum(b - a for a, b in zip(r.starts, r.ends)), len(r.starts), bytes(r.kept))
                   for r in repeats.remove(df, **options).collect()), key=str)


def odd_rows(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab c\x00é") for _ in range(rng.randrange(400))) for _ in range(20)]
    rows = [(None, base[0]), (None, base[0]), (7, base[1]), (7, base[1]), (8, None), (9, "")]
    for i in range(100):
        s = rng.choice(base)
        t = s[rng.randrange(len(s) + 1):][:rng.randrange(300)]
        rows.append((i * 3, rng.choice([t, t + rng.choice(base), t[:len(t) // 2] + "x" + t[len(t) // 2:], "a" * rng.randrange(200)])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("options", [{}, {"batch_bytes": 3000}, {"batch_bytes": 3000, "hot": 1}])
def test_odd_rows(frame, options):
    rows = odd_rows(5)
    assert found(frame(rows), **options) == brute(rows)


def test_other_lengths_and_empty(frame):
    rows = odd_rows(6)
    assert found(frame(rows), length=20, batch_bytes=4000) == brute(rows, 20)
    assert found(frame([])) == []


def test_long_text(frame):
    rng = random.Random(1)
    text = "".join(rng.choice("abcdefgh ") for _ in range(2_500_000))
    rows = [(1, text[1_000_000:1_000_200]), (2, text), (3, "y" + text[2_400_000:] + "z")]
    got = {r.doc_id: list(zip(r.starts, r.ends)) for r in repeats.remove(frame(rows)).collect()}
    assert got == {1: [], 2: [(1_000_000, 1_000_200)], 3: [(1, 100_001)]}


def test_a_gram_of_many_documents_of_one_batch_is_hot():
    rng = random.Random(2)
    line = "".join(rng.choice("abcdefgh") for _ in range(60))
    texts = [(line if i < 400 else "".join(rng.choice("abcdefgh") for _ in range(60))).encode() for i in range(600)]
    table = pa.table({"_id": pa.array(range(600), pa.int64()), "_batch": pa.array([0] * 600, pa.int32()),
                      "_zip": [zstandard.ZstdCompressor().compress(t) for t in texts]})
    grams = repeats._list_grams(1, 50)(table)
    for hot, expected in ((399, True), (400, False)):
        marks = b"".join(repeats._share(hot)(grams).column("_hot").to_pylist())
        assert marks and all(bool(m) == expected for m in marks)
    # runs of a gram that isn't hot stay within a shard's bytes
    assert repeats.HOT * (2 * repeats.LENGTH - repeats.GRAM) <= repeats.BATCH // repeats.SHARDS


def test_whole_characters(frame):
    rows = [(1, "é" * 25 + "ü" + "x" * 60), (2, "ü" + "é" * 25 + "ù" + "x" * 60)]
    for r in repeats.remove(frame(rows), whole_characters=True, carry=["doc_id", "text"]).collect():
        assert r.doc_id == 1 or bytes(r.kept).decode() == "üù"
        assert r.text == dict(rows)[r.doc_id]


def test_query(spark, sf_smoke, documents):
    got = queries.QUERIES["op6_repeats"](spark, sf_smoke).collect()
    expected = [(d, n, gone, spans, hashlib.sha256(kept).hexdigest()) for d, n, gone, spans, kept in brute(documents)]
    assert sorted(map(tuple, got)) == sorted(expected)
