"""Cross-tokenizer alignment against whole-text encoding and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers as P
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from martlet.llm import alignment
from martlet.llm.queries import REGISTRY

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def encode():
    a, b, byte = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B), alignment.byte_level()
    a.encode_special_tokens = True

    def both(text):
        x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        xb = [bytes(byte[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
              for i, p in zip(y, map(b.id_to_piece, y))]
        return (x, xb, y, yb) if b"".join(xb) == b"".join(yb) == (" " + text).encode() else None
    return both


def slow(rows, encode):
    per_doc, held = [], Counter()
    for doc, text in rows:
        got = encode(text) if text else None
        if not got:
            per_doc.append((doc, 0, 0, "", []))
            continue
        x, xb, y, yb = got
        links, groups, ga, gb = [], [], [], []
        i = j = ea = eb = 0
        while i < len(x) or j < len(y):
            if ea <= eb and (ea < eb or i < len(x)):
                ga.append(x[i]); ea += len(xb[i]); i += 1
            else:
                gb.append(y[j]); eb += len(yb[j]); j += 1
            if ea == eb:
                groups.append((ga, gb)); ga, gb = [], []
        a = [(sum(map(len, xb[:k])), sum(map(len, xb[:k + 1]))) for k in range(len(x))]
        b = [(sum(map(len, yb[:k])), sum(map(len, yb[:k + 1]))) for k in range(len(y))]
        for k, (s, e) in enumerate(a):
            links += [(x[k], y[m]) for m, (u, v) in enumerate(b) if s < v and u < e]
        held.update(set(links))
        text = ";".join(",".join(map(str, p)) + "|" + ",".join(map(str, q)) for p, q in groups)
        per_doc.append((doc, (len(x), len(y), len(groups)), None, hashlib.sha256(text.encode()).hexdigest(), links))
    top = Counter()
    for (p, _), n in held.items():
        top[p] = max(top[p], n)
    out = []
    for r in per_doc:
        if r[1] == 0:
            out.append((r[0], 0, 0, 0, 0, 0, 0, ""))
        else:
            links = r[4]
            out.append((r[0], *r[1], len(links), sum(held[q] == top[q[0]] for q in links),
                        sum(held[q] for q in links), r[3]))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_texts(spark, encode):
    rng = random.Random(3)
    bits = ["the", "naïve", "straße", "日本語", "\U0001F600", "▁", "<0x41>", "<s>", "</s>", "<unk>", "<|endoftext|>",
            "x1", "--", "don't", " ", "\u0085", "\x1f", "\x00", "é", "﻿", "antidisestablishment", "٣٤"]
    gaps = [" ", " ", " ", "  ", "   ", "\n", "\t", " \n", "\n ", "\n\n", "", "　", "\r\n"]
    rows = [(i, "".join(rng.choice(bits) + rng.choice(gaps) for _ in range(rng.randrange(0, 14)))) for i in range(400)]
    rows += [(-1, None), (-2, ""), (-3, " "), (-4, "  "), (-5, "\n"), (-6, " a"), (-7, "a "), (7, "same"), (7, "same"),
             (None, "no id"), (None, "no id"), (-8, "z" * 3000), (-9, "é" * 500), (-10, "ab " * 400)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(alignment.align_documents(df, A, B)) == slow(rows, encode)
    # hot pairs by shuffle give the same
    assert got(alignment.align_documents(df, A, B, most=1)) == slow(rows, encode)


def test_cuts_equal_whole_texts(encode):
    one = alignment.Aligner(A, B)
    rng = random.Random(9)
    for n in (1, 5, 50):
        texts = ["".join(rng.choices("ab é\n.'0▁ <>|", k=rng.randrange(60))) for _ in range(200)]
        for t, r in zip(texts, one.documents(texts)):
            e = encode(t) if t else None
            assert r[:2] == ((len(e[0]), len(e[2])) if e else (0, 0)), repr(t)


def test_memo_starts_anew(monkeypatch, encode):
    monkeypatch.setattr(alignment, "MEMO", 3)
    one = alignment.Aligner(A, B)
    texts = ["one two three four five", "six seven one", "eight nine ten one two"]
    assert [r[:5] for t in texts for r in one.documents([t])] == [r[:5] for r in alignment.Aligner(A, B).documents(texts)]


def test_terminals_of_chains():
    rng = np.random.default_rng(1)
    for _ in range(200):
        total = int(rng.integers(1, 60))
        a, b = (np.append(np.sort(rng.choice(np.arange(1, total), rng.integers(0, total), replace=False)), total) for _ in range(2))
        to = alignment.terminals(a, b)
        shared = np.intersect1d(a, b)
        want = [shared[np.searchsorted(shared, e)] for e in np.concatenate([a, b])]
        assert [b[t - len(a)] for t in to] == want


def test_documents_of_the_table(spark, encode):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    short = [r for r in rows if len(r[1] or "") < 3000]
    df = spark.createDataFrame(short, SCHEMA + "").selectExpr("doc_id", "text", "1 as lane", "'x' as pairs")
    assert got(alignment.align_documents(df, A, B)) == slow(short, encode)
    whole = REGISTRY["op13_alignment"](spark, sf)
    assert whole.count() == len(rows)


def test_empty_table(spark):
    assert alignment.align_documents(spark.createDataFrame([], SCHEMA), A, B).count() == 0
