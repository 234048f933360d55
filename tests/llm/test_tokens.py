import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mixtape.llm import packing, planes, queries
from mixtape.llm.encoding import Encoder
from mixtape.llm.textscan import slices
from mixtape.session import scratch_path

ODD = ["", "a  b   c\n\n d", " lead", "trail ", "   ", "don't we'll <|endoftext|> ok", "x.y,z!!\n\n\n a", "ÀÉ 你好 🙂🙂",
       "é ́x", "  a   b", "word " * 300, "A" * 5000]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("file", ["word_tokenizer", "byte_tokenizer"])
def test_encoder_gives_the_tokenizers_ids(file, documents, request):
    path = request.getfixturevalue(file)
    texts = ODD + [t for _, t in documents]
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    own, got = Encoder(path), []
    for _ in range(2):
        got = []
        for _, part in slices(pa.record_batch({"t": pa.array(texts)}), "t", size=5000):
            ids, offsets = own.encode(part)
            got += [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])]
    assert got == [e.ids for e in plain.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_planes_round_trip(plane):
    rng = np.random.default_rng(0)
    for ids in (rng.integers(0, 50_000, 1000), rng.integers(0, 1 << 32, 77), np.zeros(9), np.zeros(0)):
        ids = ids.astype(np.uint32)
        assert planes.join_planes(planes.split_planes(ids, plane), len(ids), plane).tolist() == ids.tolist()


@pytest.mark.parametrize("plane", ["byte", "bit"])
def test_files_read_back_whole_and_by_range(plane, tmp_path):
    rng = np.random.default_rng(1)
    docs = [(i if i else None, rng.integers(0, 49_408, int(n)).astype(np.uint32))
            for i, n in enumerate([5, 0, 300, 64, 1, 1000])]
    with open(tmp_path / "f", "wb") as out:
        writer = planes.Writer(out, plane, block=64)
        for doc, ids in docs:
            writer.add([doc], [len(ids)], ids)
        writer.close()
    import pyarrow as pa
    with pa.OSFile(str(tmp_path / "f")) as file:
        reader = planes.Reader(file)
        assert [(d, i.tolist()) for d, _, i in reader.documents()] == [(d, i.tolist()) for d, i in docs]
        every = np.concatenate([i for _, i in docs])
        assert reader.n_ids == len(every)
        for a, b in ((0, 5), (63, 65), (64, 128), (300, 1000), (0, len(every)), (7, 7)):
            assert reader.ids(a, b).tolist() == every[a:b].tolist()


def test_op2_is_the_plain_encoding_in_id_order(spark, sf_smoke, documents, word_tokenizer):
    plain, at, expected = Tokenizer.from_file(word_tokenizer), 0, []
    for doc, text in documents:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc, at, len(ids), crc(ids)))
        at += len(ids)
    got = queries.QUERIES["op2_id_planes"](spark, sf_smoke).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got)) == expected


def test_id_files_of_odd_tables(spark, frame, word_tokenizer):
    rows = [(5, "b"), (None, "n"), (5, "a"), (5, "a"), (1, None), (2, ""), (3, "long " * 30_000)]
    folder = scratch_path(spark, "test-planes")
    got = planes.read(planes.write(frame(rows), folder, word_tokenizer, end_id=2, block=1000), id_col="doc_id").collect()
    plain = Tokenizer.from_file(word_tokenizer)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    expected, at = [], 0
    for doc, text in order:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        expected.append((doc, at, len(ids), np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, bytes(r.ids)) for r in got), key=lambda r: r[1]) == expected
    nothing = planes.write(frame([]), folder, word_tokenizer, end_id=2)
    assert planes.read(nothing).count() == 0


def packed_right(rows, capacity):
    """Sequences are gapless, within capacity; returns how many there are."""
    by = {}
    for sequence, offset, length in rows:
        by.setdefault(sequence, []).append((offset, length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_op3_packs_every_piece(spark, sf_smoke, documents, byte_tokenizer):
    plain, expected = Tokenizer.from_file(byte_tokenizer), []
    for doc, text in documents:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        expected += [(doc, i, a, b - a, crc(ids[a:b])) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    got = queries.QUERIES["op3_packing"](spark, sf_smoke).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(expected)
    used = packed_right([(r.sequence_id, r.offset, r.length) for r in got], 2048)
    assert used == -(-sum(r.length for r in got) // 2048)


def test_packing_of_odd_tables_with_texts(spark, frame, byte_tokenizer):
    rows = [(1, None), (2, ""), (None, "a b"), (4, "tie tie"), (4, "tie tie"), (5, "word " * 100)]
    placed = packing.pack(frame(rows), byte_tokenizer, end_id=0, capacity=16)
    got = placed.collect()
    packed_right([(r.sequence_id, r.offset, r.length) for r in got], 16)
    plain = Tokenizer.from_file(byte_tokenizer)
    assert sum(r.length for r in got) == sum(len(plain.encode(t or "").ids) + 1 for _, t in rows)
    by = {r.sequence_id: r for r in packing.sequences(placed).collect()}
    for r in got:
        whole = np.frombuffer(bytes(by[r.sequence_id].ids), "<u4")
        assert whole[r.offset:r.offset + r.length].tolist() == np.frombuffer(bytes(r.ids), "<u4").tolist()
    assert packing.pack(frame([]), byte_tokenizer, end_id=0).count() == 0


def least_bins(sizes, capacity):
    """Brute force over all assignments (few pieces)."""
    best = len(sizes)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(sizes):
            best = len(rooms)
            return
        for j in {r: j for j, r in enumerate(rooms)}.values():
            if rooms[j] >= sizes[i]:
                go(i + 1, rooms[:j] + [rooms[j] - sizes[i]] + rooms[j + 1:])
        go(i + 1, rooms + [capacity - sizes[i]])
    go(0, [])
    return best


def test_plan_uses_every_piece_and_few_bins():
    rng = np.random.default_rng(3)
    over = 0
    for _ in range(60):
        sizes = sorted(rng.integers(1, 21, int(rng.integers(1, 12))).tolist(), reverse=True)
        counts = {s: sizes.count(s) for s in sizes}
        plan = packing.plan(counts, 20)
        used = {}
        for pattern, times in plan:
            assert sum(pattern) <= 20
            for s in pattern:
                used[s] = used.get(s, 0) + times
        assert used == counts
        over += sum(n for _, n in plan) - least_bins(sizes, 20)
    assert over == 0
    assert packing.plan({}, 20) == []
    assert sum(n for _, n in packing.plan({20: 10**9, 12: 10**9, 8: 10**9}, 20)) == 2 * 10**9


def test_plan_goes_on_when_the_promising_fillings_run_out():
    counts = {17: 2, 18: 1, 20: 1, 22: 1, 28: 2, 29: 1, 33: 1, 35: 1, 45: 1, 47: 1, 57: 1}
    found = packing.plan(counts, 101)
    used = {}
    for pattern, times in found:
        assert sum(pattern) <= 101
        for s in pattern:
            used[s] = used.get(s, 0) + times
    assert used == counts
    assert sum(n for _, n in found) == -(-sum(s * n for s, n in counts.items()) // 101) == 4


def test_all_fillings_are_those_beside_which_nothing_fits():
    counts = np.array([0, 0, 3, 1, 2, 0, 1])
    stock = packing.Stock(counts)
    for room in range(7):
        expected = set()
        for each in itertools.product(*(range(n + 1) for n in counts)):
            free = room - sum(i * n for i, n in enumerate(each))
            if free >= 0 and not any(i <= free and n < counts[i] for i, n in enumerate(each) if i):
                expected.add(tuple(i for i in range(6, 0, -1) for _ in range(each[i])))
        got = list(packing.all_fillings(stock, room))
        assert len(got) == len(set(got)) and set(got) == expected
        assert set(packing.fillings(stock, room)) <= expected
        assert stock.n == counts.tolist()


def test_packing_is_the_same_on_any_partitioning(spark, sf_smoke, byte_tokenizer):
    docs = spark.read.parquet(f"{sf_smoke}/documents.parquet")
    bins = {packing.pack(docs.repartition(n), byte_tokenizer, 0).select("sequence_id").distinct().count() for n in (1, 7)}
    assert len(bins) == 1
    assert packing.pack(docs, byte_tokenizer, 0).agg(F.countDistinct("doc_id")).first()[0] == docs.count()
