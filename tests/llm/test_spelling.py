"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from martlet.llm import spelling

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def slow_words(rows):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 5 and c >= 3}


def slow(rows):
    n = slow_words(rows)
    gaps = {}
    for w in n:
        for i in range(len(w)):
            for k in (w[:i] + w[i + 1:], w[:i] + "*" + w[i + 1:]):
                gaps.setdefault(k, set()).add(w)
        gaps.setdefault(w, set()).add(w)
    near = {w: set() for w in n}
    for same in gaps.values():
        for a in same:
            near[a] |= {b for b in same if a != b and one_edit(a, b)}
    form = {}
    for w, some in near.items():
        best = min(some, key=lambda x: (-n[x], x), default=None)
        if best is not None and n[best] >= 2 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n.get(form.get(w))))
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.collect())


def made(seed, count, letters):
    """Texts whose words are edits of a few words, so chains and ties abound."""
    rng = random.Random(seed)
    base = ["".join(rng.choices(letters, k=rng.randrange(4, 12))) for _ in range(30)]
    rows = []
    for i in range(count):
        words = []
        for _ in range(40):
            w = rng.choice(base[:1 + int(len(base) * rng.random() ** 2)])
            for _ in range(rng.choice((0, 0, 0, 1, 1, 2))):
                p = rng.randrange(len(w) + 1)
                w = w[:p] + rng.choice(("", rng.choice(letters))) + w[p + rng.choice((0, 1)):]
            words.append(w.upper() if rng.random() < .1 else w)
        rows.append((rng.choice((i, i, 7, None)), " ".join(words)))
    return rows


@pytest.mark.parametrize("seed, letters", [(1, "ab"), (2, "aéÿÀz"), (3, "abcdefgh×")])
def test_edits_of_a_few_words(spark, seed, letters):
    rows = made(seed, 120, letters) + [(5, None), (6, ""), (8, "1234 日本 É")]
    df = spark.createDataFrame(rows, SCHEMA)
    want = slow(rows)
    assert len(want) > 50
    assert got(spelling.spelling_variants(df)) == want
    # small blocks: every half is split, targets and queries
    assert got(spelling.spelling_variants(df, block=3)) == want


def test_documents_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert got(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA))) == slow(rows)


def test_a_very_long_word(spark):
    long = "ab" * 3000
    rows = [(1, f"{long} " * 3 + f"{long[1:]} " * 9 + f"c{long[1:]} " * 30)]
    assert got(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA))) == slow(rows)


def test_index_finds_exactly_the_words_one_edit_away():
    rng = random.Random(4)
    for _ in range(30):
        words = sorted({"".join(rng.choices("abc", k=rng.randrange(2, 7))) for _ in range(60)})
        code = [np.array([ord(c) - 97 for c in w]) for w in words]
        index = spelling.FMIndex(code, 3)
        for less in (0, 1):
            length = np.array([len(w) - less for w in words])
            exact = length // 2
            a, b = spelling.search(index, code, length, exact)
            want = sorted((i, j) for i, x in enumerate(words) for j, y in enumerate(words)
                          if len(y) == length[i] and x[:exact[i]] == y[:exact[i]] and one_edit(x, y)
                          and (less == 0 or any(x[:k] + x[k + 1:] == y for k in range(exact[i], len(x)))))
            assert sorted(zip(a.tolist(), b.tolist())) == want


def test_chains_and_equal_counts(spark):
    # n: 3, 6, 12, 24 in a chain; and two forms of equal n
    rows = [(1, "chaina " * 3 + "chainab " * 6 + "chainabc " * 12 + "chainabcd " * 24 + "worde " * 3 + "wordf " * 9 + "wordg " * 9)]
    out = {r[0]: r for r in got(spelling.spelling_variants(spark.createDataFrame(rows, SCHEMA), divisor=1 << 40))}
    assert out["chaina"][1:3] == ("chainab", "chainabcd") and out["worde"][1] == "wordf"
    assert out["chainabcd"][1:] == (None, "chainabcd", 24, 1, None)


def test_empty_and_clashing(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(1, "alpha alpha alpha", "x", 3)], SCHEMA + ", word string, n int")
    assert got(spelling.spelling_variants(df)) == [("alpha", None, "alpha", 3, 0, None)]
    with pytest.raises(ValueError, match="circle"):
        spelling.spelling_variants(df, factor=1)
