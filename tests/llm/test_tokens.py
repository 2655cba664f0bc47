"""Token files and packing against plain encodings, written and read back."""

import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from martlet.llm import packing, token_store
from martlet.llm.queries import REGISTRY, vocabulary
from martlet.llm.tokens import Encoder, _Memo

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def enc():
    return Encoder(vocabulary(), memo=50)


def plain(enc, text):
    return enc.tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t\u0085 \x1cab'sIé.1日<|endoftext|>", max_size=14), max_size=6))
def test_cuts_never_change_ids(enc, texts):
    assert [a.tolist() for a in enc.encode(texts)] == [plain(enc, t) for t in texts]


def test_new_cuts_are_added_at_once_and_old_ones_not_encoded_again(enc, monkeypatch):
    own, added, add = Encoder(vocabulary(), memo=100), [], _Memo.add
    monkeypatch.setattr(_Memo, "add", lambda memo, cuts, *got: (added.append(len(cuts)), add(memo, cuts, *got)))
    first = " ".join(f"w{i}" for i in range(12_000)) + " \t x"
    texts = [first + " w7", "new " + first]
    got = own.encode([first])
    assert added == [12_001]  # one copy of the memo, not one for each 5,000 cuts
    got += own.encode(texts)
    assert added[1:] == [12_001, 1]  # from the generation before; only "w0" with a space before it is new
    assert [a.tolist() for a in got] == [plain(enc, t) for t in [first, *texts]]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, lane long, length long")


def odd_rows():
    long = " ".join(f"w{i}x" for i in range(3000))
    return [(5, "a b", "x", 1, 1), (3, None, None, None, None), (9, "", "x", 1, 1), (None, "no id", "x", 1, 1),
            (5, "a b", "x", 1, 1), (5, "another text of the same id", "x", 1, 1), (2, long, "x", 1, 1)]


def expected_store(enc, rows):
    out, at = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for doc_id, text in ((r[0], r[1]) for r in order):
        ids = np.array(plain(enc, text) + [0], "<u4")
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_store_of_odd_rows(spark, enc):
    got = token_store.token_store(frame(spark, odd_rows()), vocabulary()).collect()
    assert key(got) == key(expected_store(enc, odd_rows()))


def test_store_over_several_files_and_random_access(spark, enc, tmp_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    files = token_store.write_store(docs, vocabulary(), f"{tmp_dir}/store", file_tokens=10_000)
    assert files.count() > 8
    assert key(token_store.read_store(files).collect()) == key(expected_store(enc, rows))
    texts = dict(rows)
    for f in files.limit(3).collect():
        file = token_store.open_file(f.path)
        ids = [i for d in file.doc_ids for i in plain(enc, texts[d]) + [0]]
        for i in random.Random(0).sample(range(len(ids)), 60):
            assert file.ids(i, i + 1).tolist() == [ids[i]]
        assert file.ids(7, 2000).tolist() == ids[7:2000]


def test_codes_round_trip():
    for ids in ([], [0], [255, 256, 65535, 65536, 2**24, 2**32 - 1] * 700):
        data = token_store.pack([1, None], np.array([len(ids), 0]), np.array(ids, np.uint32))
        f = token_store.TokenFile(token_store._Bytes(data))
        assert f.document(0).tolist() == ids and f.doc_ids == [1, None]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert token_store.token_store(empty, vocabulary()).count() == 0
    assert packing.pack_documents(empty, vocabulary()).count() == 0


def check_packing(rows, got, enc, size, end):
    want = {}
    for doc_id, text in rows:
        ids = plain(enc, text) + [end]
        first = len(ids) % size or size
        edge = [0, *range(first, len(ids) + 1, size)]
        for p, (a, b) in enumerate(zip(edge[:-1], edge[1:])):
            k = (doc_id, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
            want[k] = want.get(k, 0) + 1
    have = {}
    for r in got:
        have[tuple(r)[:5]] = have.get(tuple(r)[:5], 0) + 1
    assert have == want
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(sequences), -(-sum(r.length for r in got) // size)


def test_packing_of_odd_rows(spark, enc):
    rows = odd_rows()
    got = packing.pack_documents(frame(spark, rows), vocabulary(), size=64).collect()
    check_packing([r[:2] for r in rows], got, enc, 64, 2)


def test_packing_of_documents_is_tight_and_repeats(spark, enc):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = REGISTRY["op3_packing"](spark, "/root/testdata/sf0.01").collect()
    used, least = check_packing(rows, got, enc, 1024, 2)
    assert used <= 1.02 * least


def test_many_groups(spark, enc):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = packing.pack_documents(docs, vocabulary(), group=100).collect()
    used, least = check_packing(rows, got, enc, 1024, 2)
    assert used <= 1.04 * least


def test_sum_of_squares_takes_the_least():
    rng = np.random.default_rng(1)
    lengths = np.sort(rng.integers(1, 20, 200))[::-1]
    seq, off, fill = packing.sum_of_squares(lengths, 20)
    gaps = {}
    for s, b in zip(lengths.tolist(), seq.tolist()):
        count = [sum(1 for g in gaps.values() if g == x) for x in range(21)]

        def total(gap, new):
            c = count[:]
            if not new:
                c[gap] -= 1
            c[gap - s] += 1
            return sum(x * x for x in c[1:20])

        best = min([total(g, False) for g in set(gaps.values()) if g >= s] + [total(20, True)])
        assert total(gaps.get(b, 20), b not in gaps) == best
        gaps[b] = gaps.get(b, 20) - s
    assert all(0 <= g for g in gaps.values())


def test_one_id_fills_many_files(spark, tmp_dir):
    rows = [(7, f"{i % 40} text number {i}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    files = token_store.write_store(docs, vocabulary(), f"{tmp_dir}/hot")
    assert files.count() > 1
    assert token_store.read_store(files).count() == 400
