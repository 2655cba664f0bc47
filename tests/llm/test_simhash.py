"""SimHash fingerprints, links and components against brute force."""

import random
from collections import Counter

import pytest
import xxhash

from martlet.llm import graph, simhash
from martlet.llm.queries import REGISTRY

WHITE = " \t\n\x0b\x0c\r"


def slow_print(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in WHITE[1:]:
        text = text.replace(c, " ")
    w = [x for x in text.split(" ") if x]
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))]
    count = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        count.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * count[b] > len(shingles))


def slow_components(prints, max_bits):
    """prints: (doc_id, fingerprint) rows. The least id reachable, by row."""
    nodes = sorted({p for _, p in prints})
    root = {p: p for p in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = {}
    for d, p in prints:
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [(d, f"{p:016x}", least.get(find(p))) for d, p in prints]


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x) for x in r))


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    got = REGISTRY["op6_simhash"](spark, "/root/testdata/sf0.01").collect()
    assert key(got) == key(slow_components([(d.doc_id, slow_print(d.text)) for d in docs], 4))
    assert len({r.component_id for r in got}) < len(docs)


def test_odd_rows(spark):
    rows = [(7, None, "x"), (3, "", "x"), (9, " \n ", "x"), (None, "alone here", "x"), (4, "One two", "x"),
            (4, "one TWO", "x"), (4, "one TWO", "x"), (5, "É é", "x"), (6, "é é", "x"), (8, "w " * 70_000, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = simhash.near_duplicates(docs).collect()
    assert key(got) == key(slow_components([(d, slow_print(t)) for d, t, _ in rows], 4))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [1 << 15, 16])
def test_links_of_dense_and_sparse_prints(spark, block):
    """A ball of near fingerprints, pairs at the limit and beyond, and a chain."""
    rnd = random.Random(3)
    base = rnd.getrandbits(64)
    prints = {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 3))) for _ in range(150)}
    for bits in (4, 5) * 20:
        x = rnd.getrandbits(64)
        prints |= {x, x ^ sum(1 << b for b in rnd.sample(range(64), bits))}
    x = rnd.getrandbits(64)
    for _ in range(12):
        prints.add(x)
        x ^= sum(1 << b for b in rnd.sample(range(64), 4))
    prints = sorted(prints)
    signed = [(p - (p >> 63 << 64),) for p in prints]
    edges = simhash.links(spark.createDataFrame(signed, "fingerprint long"), 4, block)
    pairs = {(r.a % 2**64, r.b % 2**64) for r in edges.collect()}
    assert all(0 < (a ^ b).bit_count() <= 4 for a, b in pairs)
    want = slow_components(list(enumerate(prints)), 4)
    place = {p: i for i, p in enumerate(prints)}
    found = {}
    for r in graph.components(spark.createDataFrame([(place[a], place[b]) for a, b in pairs], "a long, b long")).collect():
        found[r.node] = r.component
    assert [found.get(i, i) for i in range(len(prints))] == [w[2] for w in want]
    assert len(pairs) < 8 * len(prints)  # no all-pairs output within the ball


def test_components_of_chain_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100), (70, 71), (71, 70), (70, 71), (None, 3)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, 70: 70, 71: 70}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0
