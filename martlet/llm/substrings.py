"""Removal of long repeated word spans, over a compacted de Bruijn graph.

Of every K-word run that could start, a document keeps those that are least by
hash among W neighbours (and its first and last). K + W - 1 words are a window,
so each window holds a kept K-mer, and equal windows hold the same. A K-mer that
documents with different ids hold is a node; the step from one to the next in a
document is an edge. A K-mer that follows itself at every word (a word said over
and over) is one node with its number of times. Nodes are at most W words apart
and K words long, so a path fixes every word along it. An edge that is the only
one out of its tail and the only one into its head doesn't branch; such edges are
joined back to the documents, and the nodes along them compact to one row per run.

Runs that take the same compacted path have the same words. The run in the
document with the smallest id is their source: the others' inner windows are
known to be repeated. Neighbouring runs of a document that keep the same distance
to the same source are one run, as the source has the words between them, too.

The least K-mer of a window is the same in equal windows. So a window can only be
repeated from a smaller document if such a document holds its least K-mer, and a
K-mer is open if it is the least of such a window that isn't known from a run.
Only windows whose least K-mer is open, and that aren't known, are read again from
the documents by their coordinates and compared.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow, small, stored
from .tokens import groups

#: spans sent to all tasks; with more, texts are shuffled to them
SENT = 1_000_000

C = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def mix(a: np.ndarray, b: np.ndarray, salt: int) -> np.ndarray:
    """Hashes of pairs, in order; ``salt`` 0 or 1 for two independent families."""
    x = (a * C[salt]) ^ (a >> np.uint64(31))
    x = (x + b) * C[2 + salt]
    return x ^ (x >> np.uint64(29))


def rolled(h: np.ndarray, size: int, salt: int) -> np.ndarray:
    """Hash of every ``size`` consecutive entries, from hashes of doubled lengths."""
    n, out, used, length = len(h) - size + 1, None, 0, 1
    if n <= 0:
        return np.empty(0, np.uint64)
    while length <= size:
        if size & length:
            piece = h[used:used + n]
            out = piece if out is None else mix(out, piece, salt)
            used += length
        if 2 * length <= size:
            h = mix(h[:-length], h[length:], salt)
        length *= 2
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    from xxhash import xxh64_intdigest

    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def slid(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (np.minimum or np.maximum) over every ``size`` consecutive entries."""
    length = 1
    while 2 * length <= size:
        x = pick(x[:-length], x[length:])
        length *= 2
    rest = size - length
    return pick(x[:len(x) - rest], x[rest:]) if rest else x


def kept_and_least(h: np.ndarray, bounds: np.ndarray, k: int, w: int) -> tuple[np.ndarray, ...]:
    """As ``kept_kmers``, and of every window the first hash of its least K-mer
    (0 where none fits into a document)."""
    size, n = k + w - 1, len(h)
    if n < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    one, two = rolled(h, k, 0), rolled(h, k, 1)
    least = slid(one, w, np.minimum)
    inside = np.zeros(n + 1, np.int64)
    long = np.diff(bounds) >= size
    first, last = bounds[:-1][long], bounds[1:][long]
    np.add.at(inside, first, 1)
    np.add.at(inside, last - size + 1, -1)
    valid = np.cumsum(inside)[:len(least)] > 0
    best = np.where(valid, least, np.uint64(0))
    pad = np.zeros(w - 1, np.uint64)
    keep = (slid(np.concatenate([pad, best, pad]), w, np.maximum) == one) & (one > 0)
    keep[first] = keep[last - k] = True
    at = np.flatnonzero(keep)
    return at, one[at], two[at], best


def kept_kmers(h: np.ndarray, bounds: np.ndarray, k: int, w: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the kept K-mers in documents laid end to end (``bounds``: their
    edges), with two hashes each. Documents shorter than a window have none."""
    return kept_and_least(h, bounds, k, w)[:3]


def kept_nodes(h: np.ndarray, bounds: np.ndarray, k: int, w: int) -> tuple[np.ndarray, ...]:
    """The kept K-mers, those that follow themselves at every word as one: place
    of the first, first hash, second hash (with the number of times, if several),
    that number, and the windows (first, how many) whose least K-mer it is.
    Windows whose least K-mer stands several times in them go with one of these."""
    at, one, two, best = kept_and_least(h, bounds, k, w)
    begins = np.isin(at, bounds)
    begins[:1] = True
    begins[1:] |= (np.diff(at) != 1) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
    head = np.flatnonzero(begins)
    times = np.diff(np.append(head, len(at)))
    # stretches of windows with one least K-mer, and where it first stands in them
    window = np.flatnonzero(best)
    cut = np.isin(window, bounds)
    cut[:1] = True
    cut[1:] |= (np.diff(window) != 1) | (best[window[1:]] != best[window[:-1]])
    cut = np.flatnonzero(cut)
    start = window[cut]
    j = np.searchsorted(at, start)
    wrong = np.flatnonzero(one[j] != best[start])
    while len(wrong):
        j[wrong] += 1
        wrong = wrong[one[j[wrong]] != best[start[wrong]]]
    node = np.searchsorted(head, j, "right") - 1
    since, many = at[head].copy(), np.zeros(len(head), np.int64)
    since[node], many[node] = start, np.diff(np.append(cut, len(window)))
    second = np.where(times > 1, mix(two[head], times.astype(np.uint64), 1), two[head])
    return at[head], one[head], second, times, since, many


def summaries(docs: DataFrame, k: int, w: int) -> DataFrame:
    """Of every row: doc_id, tkey, n_words, sha (of all words) and its kept K-mers,
    each with the words from its first window (see ``kept_nodes``) to it."""
    node = pa.struct([("h1", pa.int64()), ("h2", pa.int64()), ("pos", pa.int32()), ("times", pa.int32()),
                      ("before", pa.int32()), ("many", pa.int32())])

    def run(batches):
        for batch in batches:
            for at, texts in groups(batch.column("text")):
                words = [t.encode().split() for t in texts]
                bounds = np.concatenate([[0], np.cumsum([len(x) for x in words])]).astype(np.int64)
                place, one, two, times, since, many = kept_nodes(
                    word_hashes([x for y in words for x in y]), bounds, k, w)
                edge = np.searchsorted(place, bounds)
                pos = (place - np.repeat(bounds[:-1], np.diff(edge))).astype(np.int32)
                nodes = pa.StructArray.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(pos),
                     *(pa.array(x.astype(np.int32)) for x in (times, place - since, many))], fields=list(node))
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("tkey"), pa.array(np.diff(bounds)),
                     pa.array([hashlib.sha256(b" ".join(x)).hexdigest() for x in words]),
                     pa.ListArray.from_arrays(pa.array(edge.astype(np.int32)), nodes)],
                    names=["doc_id", "tkey", "n_words", "sha", "kmers"])

    return arrow(docs, run, "doc_id long, tkey long, n_words long, sha string, "
                            "kmers array<struct<h1:long,h2:long,pos:int,times:int,before:int,many:int>>")


def compacted(nodes: DataFrame, k: int, w: int) -> DataFrame:
    """Runs of repeated K-mers (doc_id, tkey, h1, h2, pos, times) along edges that
    don't branch, if a smaller document has the same run, joined where neighbours
    have one source at one distance: doc_id, tkey, and the windows within a run (a
    to b)."""
    order = Window.partitionBy("doc_id", "tkey").orderBy("pos", "h1", "h2")
    end = F.col("pos") + F.col("times") - 1
    placed = nodes.select("doc_id", "tkey", "h1", "h2", "pos", end.alias("end"))
    gap = F.lead("pos").over(order) - F.col("end")
    edges = (placed.select("h1", "h2", F.lead("h1").over(order).alias("n1"), F.lead("h2").over(order).alias("n2"),
                           gap.alias("gap")).filter(f"gap between 1 and {w}").distinct())
    # of every K-mer: whether it has one edge out, and one edge in; a step between two such is that edge
    ends = F.array(F.struct("h1", "h2", F.lit(1).alias("out"), F.lit(0).alias("into")),
                   F.struct(F.col("n1").alias("h1"), F.col("n2").alias("h2"), F.lit(0).alias("out"), F.lit(1).alias("into")))
    single = stored(edges.select(F.explode(ends).alias("x")).select("x.*").groupBy("h1", "h2")
                    .agg((F.sum("out") == 1).alias("out"), (F.sum("into") == 1).alias("into"))
                    .filter("out or into"), "single")
    joined = placed.join(single, ["h1", "h2"], "left")
    goes_on = F.lag("out").over(order) & F.col("into") & (F.col("pos") - F.lag("end").over(order)).between(1, w)
    runs = (joined.withColumn("starts", ~F.coalesce(goes_on, F.lit(False)))
            .withColumn("run", F.sum(F.col("starts").cast("int")).over(order))
            .groupBy("doc_id", "tkey", "run")
            .agg(F.min(F.struct("pos", "h1", "h2")).alias("a"), F.max(F.struct("pos", "h1", "h2", "end")).alias("b"),
                 F.count("*").alias("n")))
    path = [F.col("a.h1").alias("a1"), F.col("a.h2").alias("a2"), F.col("b.h1").alias("b1"), F.col("b.h2").alias("b2"),
            "n", (F.col("b.end") - F.col("a.pos")).alias("far")]
    same = ["a1", "a2", "b1", "b2", "n", "far"]
    # a run without a whole window inside saves no comparison
    runs = stored(runs.select("doc_id", "tkey", F.col("a.pos").alias("first"), F.col("b.end").alias("last"), *path)
                  .filter(f"far >= {w - 1}"), "runs")
    # stored, so that a path that very many documents take is a plain join that Spark can split
    source = stored(runs.groupBy(*same).agg(F.min(F.struct("doc_id", "tkey", "first")).alias("s"), F.max("doc_id").alias("hi"))
                    .filter("s.doc_id < hi")
                    .select(*same, F.col("s.doc_id").alias("source"), F.col("s.tkey").alias("source_tkey"),
                            F.col("s.first").alias("source_first")), "sources")
    known = runs.join(source, same).filter("doc_id > source").select(
        "doc_id", "tkey", "first", "last", "source", "source_tkey", (F.col("first") - F.col("source_first")).alias("shift"))
    by_place = Window.partitionBy("doc_id", "tkey").orderBy("first", "last")
    as_before = [F.lag(c).over(by_place) == F.col(c) for c in ("source", "source_tkey", "shift")]
    goes_on = (as_before[0] & as_before[1] & as_before[2]
               & (F.col("first") - F.lag("last").over(by_place)).between(1, w))
    return (known.withColumn("starts", ~F.coalesce(goes_on, F.lit(False)))
            .withColumn("run", F.sum(F.col("starts").cast("int")).over(by_place))
            .groupBy("doc_id", "tkey", "run")
            .agg(F.min("first").alias("a"), (F.max("last") - w + 1).alias("b"))
            .filter("a <= b").select("doc_id", "tkey", "a", "b"))


def repeated_nodes(summary: DataFrame) -> DataFrame:
    """The K-mers that documents with different ids hold, by document: doc_id,
    tkey, h1, h2, pos, times, the windows (a to b) whose least K-mer it is, and
    whether a smaller document holds it (``asks``)."""
    nodes = (summary.filter("doc_id is not null")
             .select("doc_id", "tkey", F.explode("kmers").alias("x")).select("doc_id", "tkey", "x.*"))
    # one of the two hashes will do to leave out the K-mers that only one document holds
    several = stored(nodes.groupBy("h1").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                     .filter("lo < hi").select("h1", "lo"), "several")
    return stored(nodes.join(several, "h1").select(
        "doc_id", "tkey", "h1", "h2", "pos", "times", (F.col("pos") - F.col("before")).alias("a"),
        (F.col("pos") - F.col("before") + F.col("many") - 1).alias("b"), (F.col("doc_id") > F.col("lo")).alias("asks")), "nodes")


def open_windows(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """Windows to compare (doc_id, tkey, a, b, asks): those of the K-mers of which
    any window that may be repeated isn't ``known``."""
    ranges = nodes.filter("a <= b").select("doc_id", "tkey", "h1", "a", "b", "asks")
    inner = known.groupBy("doc_id", "tkey").agg(F.collect_list(F.struct("a", "b")).alias("inner"))
    asked = stored(ranges.filter("asks").join(inner, ["doc_id", "tkey"], "left")
                   .filter("not coalesce(exists(inner, x -> x.a <= a and b <= x.b), false)")
                   .select("h1").distinct(), "asked")
    return ranges.join(asked, "h1", "left_semi").drop("h1")


def touched(docs: DataFrame, known: DataFrame, unknown: DataFrame) -> DataFrame:
    """The documents that have windows known to be repeated, or to compare, with
    their texts and these ``spans``, stored: the only texts that later steps read."""
    marks = unknown.withColumn("known", F.lit(False)).unionByName(
        known.withColumn("known", F.lit(True)).withColumn("asks", F.lit(False)))
    spans = stored(marks.groupBy("doc_id", "tkey").agg(
        F.collect_list(F.struct("a", "b", "known", "asks")).alias("spans")), "spans")
    return stored(docs.join(small(spans, SENT, "spans"), ["doc_id", "tkey"])
                  .select("doc_id", "tkey", "text", "spans"), "touched")


def reread(docs: DataFrame, k: int, w: int) -> DataFrame:
    """Windows of ``docs`` (as ``touched`` has them) to compare, equal ones in a
    row as one: w1, w2, doc_id, tkey, pos, times, asks."""
    size = k + w - 1

    def run(batches):
        schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc_id", pa.int64()), ("tkey", pa.int64()),
                            ("pos", pa.int32()), ("times", pa.int32()), ("asks", pa.bool_())])
        for batch in batches:
            spans = batch.column("spans").to_pylist()
            for at, texts in groups(batch.column("text")):
                rows = []
                for i, t in enumerate(texts, at):
                    if all(s["known"] for s in spans[i]):
                        continue
                    h = word_hashes(t.encode().split())
                    want, asks = np.zeros((2, max(len(h) - size + 1, 0)), bool)
                    for s in spans[i]:
                        if not s["known"]:
                            want[s["a"]:s["b"] + 1] = True
                            asks[s["a"]:s["b"] + 1] = s["asks"]
                    for s in spans[i]:
                        if s["known"]:
                            want[s["a"]:s["b"] + 1] = False
                    pos = np.flatnonzero(want)
                    if len(pos):
                        one, two = rolled(h, size, 0)[pos], rolled(h, size, 1)[pos]
                        new = np.ones(len(pos), bool)
                        new[1:] = (np.diff(pos) != 1) | (one[1:] != one[:-1]) | (two[1:] != two[:-1])
                        new = np.flatnonzero(new)
                        rows.append((one[new], two[new], i, pos[new], np.diff(np.append(new, len(pos))), asks[pos[new]]))
                if rows:
                    one, two, doc, pos, times, asks = zip(*rows)
                    take = pa.array(np.repeat(doc, [len(p) for p in pos]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(one).view(np.int64)), pa.array(np.concatenate(two).view(np.int64)),
                         batch.column("doc_id").take(take), batch.column("tkey").take(take),
                         pa.array(np.concatenate(pos).astype(np.int32)), pa.array(np.concatenate(times).astype(np.int32)),
                         pa.array(np.concatenate(asks))], schema=schema)

    return arrow(docs, run, "w1 long, w2 long, doc_id long, tkey long, pos int, times int, asks boolean")


def repeated_words(texts: DataFrame, known: DataFrame, k: int, w: int) -> DataFrame:
    """Word intervals [a, b) to remove: doc_id, tkey, a, b."""
    size = k + w - 1
    windows = stored(reread(texts, k, w), "windows")
    first = stored(windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                   .filter("lo < hi").select("w1", "w2", "lo"), "firsts")
    found = (windows.filter("asks").join(first, ["w1", "w2"]).filter("doc_id > lo")
             .select("doc_id", "tkey", "pos", (F.col("pos") + F.col("times")).alias("next")))
    order = Window.partitionBy("doc_id", "tkey").orderBy("pos")
    starts = F.coalesce(F.col("pos") > F.lag("next").over(order), F.lit(True))
    spans = (found.withColumn("starts", starts)
             .withColumn("island", F.sum(F.col("starts").cast("int")).over(order))
             .groupBy("doc_id", "tkey", "island").agg(F.min("pos").alias("a"), (F.max("next") - 1 + size).alias("b"))
             .select("doc_id", "tkey", "a", "b"))
    return spans.unionByName(known.select("doc_id", "tkey", "a", (F.col("b") + size).alias("b")))


def without_repeats(docs: DataFrame, k: int = 26, w: int = 25) -> DataFrame:
    """Remove from every whole text of ``docs`` (doc_id, text) each word inside
    a window of ``k + w - 1`` words that also starts in a document with a
    smaller doc_id. One row per row: doc_id, n_words, n_removed, kept_sha256 (of
    the words kept, joined by a space) and, for texts that lose words, kept (the
    words; else null, as the text is as it was).

    Words are runs of anything but ASCII white space; null texts have none. Rows
    of one doc_id don't remove each other's words and each get a row, judged by
    their own text. A null doc_id is neither smaller nor larger than others:
    such rows lose nothing and take nothing. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("tkey"), text.alias("text"))
    summary = stored(summaries(keyed, k, w), "summaries")
    nodes = repeated_nodes(summary)
    known = stored(compacted(nodes, k, w), "known")
    texts = touched(keyed, known, open_windows(nodes, known))
    gone = stored(repeated_words(texts, known, k, w).groupBy("doc_id", "tkey").agg(
        F.collect_list(F.struct("a", "b")).alias("gone")), "gone")

    def run(batches):
        for batch in batches:
            removed, sha, kept = [], [], []
            for t, spans in zip(batch.column("text"), batch.column("gone").to_pylist()):
                words = t.as_py().encode().split()
                keep = np.ones(len(words), bool)
                for s in spans:
                    keep[s["a"]:s["b"]] = False
                left = b" ".join([x for x, stays in zip(words, keep.tolist()) if stays])
                removed.append(len(words) - int(keep.sum()))
                sha.append(hashlib.sha256(left).hexdigest())
                kept.append(left.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tkey"), pa.array(removed, pa.int64()),
                                              pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                                             names=["doc_id", "tkey", "n_removed", "kept_sha256", "kept"])

    losing = texts.join(small(gone, SENT, "gone"), ["doc_id", "tkey"]).select("doc_id", "tkey", "text", "gone")
    changed = (arrow(losing, run, "doc_id long, tkey long, n_removed long, kept_sha256 string, kept string")
               .dropDuplicates(["doc_id", "tkey"]))
    return (summary.select("doc_id", "tkey", "n_words", "sha").join(changed, ["doc_id", "tkey"], "left")
            .select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
                    F.coalesce("kept_sha256", "sha").alias("kept_sha256"), "kept"))
