"""SimHash near-duplicates by deletion-variant signatures.

Fingerprints that differ in at most d bits agree, in at least one of d // 2 + 1
segments, on all bits but one at most. So each segment is indexed once for every
bit it has, with that bit left out: two such fingerprints meet under one of the
64 one-wildcard variants. Those that meet are compared in full.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow, partitions, small, stored
from .graph import components

#: entries of one variant that a task compares at a time; larger ones are dealt
#: in blocks, and every pair of blocks is compared
BLOCK = 32_768

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash of a whole text. A-Z are lower-cased; words are
    runs of anything but ASCII white space; a text of fewer words than
    ``shingle`` is one shingle; without words (or null) it is zero."""
    from xxhash import xxh64_intdigest

    w = (text or "").encode().translate(LOWER).split()
    if not w:
        return 0
    joined = b" ".join(w)
    ends = np.cumsum(np.fromiter(map(len, w), np.int64, len(w)) + 1)
    begins = [0, *ends[:-1].tolist()]
    ends = (ends - 1).tolist()[min(shingle, len(w)) - 1:]
    ones, step = np.zeros(64, np.int64), 1 << 16
    for i in range(0, len(ends), step):
        h = np.array([xxh64_intdigest(joined[a:b], seed)
                      for a, b in zip(begins[i:i + step], ends[i:i + step])], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(ends), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42, also: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns ``also`` (longs) and fingerprint (the 64 bits as a signed long) of every row."""
    def run(batches):
        for batch in batches:
            bits = np.array([fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", *also)), pa.array(bits.view(np.int64))],
                names=["doc_id", *also, "fingerprint"])

    return arrow(docs.select(*[F.col(c).cast("long").alias(c) for c in ("doc_id", *also)],
                             F.col("text").cast("string").alias("text")),
                 run, ", ".join(f"{c} long" for c in ("doc_id", *also, "fingerprint")))


def segments(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, bits) of max_bits // 2 + 1 segments of almost equal size."""
    k = max_bits // 2 + 1
    edge = [64 * i // k for i in range(k + 1)]
    return [(a, b - a) for a, b in zip(edge[:-1], edge[1:])]


def _variant(fp, first: int, bits: int, j: int):
    """Key of the variant of segment (first, bits) that leaves out bit j."""
    mask = ((1 << bits) - 1) & ~(1 << (j - first))
    return F.shiftrightunsigned(fp, first).bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(j << 50))


def tree(fp: np.ndarray, max_bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect whatever is connected by steps of at most
    ``max_bits``: each node reached is linked to the one that reached it."""
    found, rest = [], fp
    while len(rest):
        queue, rest = [rest[:1]], rest[1:]
        while queue and len(rest):
            x = queue.pop()
            for one in x:
                near = np.bitwise_count(rest ^ one) <= max_bits
                if near.any():
                    hit, rest = rest[near], rest[~near]
                    found.append((np.full(len(hit), one), hit))
                    queue.append(hit)
                if not len(rest):
                    break
    return found


def links(prints: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between fingerprints of ``prints`` (one row for each
    distinct one) that differ in at most ``max_bits`` bits: not all such pairs,
    but enough to connect all that they connect.

    A variant's entries are streamed in order and compared in one task. The
    bound on an entry list comes from counts of whole segment values; a list
    that may exceed ``block`` is dealt into blocks by hash, and each pair of
    blocks goes to a task of its own, so that no list is held whole.
    """
    parts = segments(max_bits)
    fp = F.col("fingerprint")
    keys = F.array(*[_variant(fp, a, n, j) for a, n in parts for j in range(a, a + n)])
    variants = prints.select(fp, F.explode(keys).alias("key"))

    # keys whose list may be too long
    value = F.array(*[F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << n) - 1)).bitwiseOR(F.lit(k << 50))
                      for k, (a, n) in enumerate(parts)])
    often = (prints.select(F.explode(value).alias("value")).groupBy("value").count()
             .filter(F.col("count") > block // 2))
    part_keys = F.lit(None)
    for k, (a, n) in enumerate(parts):
        own = F.col("value").bitwiseAND(F.lit((1 << 50) - 1))
        part_keys = F.when(F.shiftright("value", 50) == k, F.array(*[
            own.bitwiseAND(F.lit(((1 << n) - 1) & ~(1 << (j - a)))).bitwiseOR(F.lit(j << 50))
            for j in range(a, a + n)])).otherwise(part_keys)
    # a list has at most the entries of the two values that it joins
    long_lists = stored(
        often.select("count", F.explode(part_keys).alias("key"))
        .groupBy("key").agg(F.ceil((F.sum("count") + block // 2) / block).cast("int").alias("blocks")), "long-lists")
    if long_lists.isEmpty():
        dealt = variants.withColumn("sub", F.lit(0))
    else:
        mine = F.pmod(F.xxhash64("fingerprint"), F.col("blocks")).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda other: (
            F.least(mine, other) * F.col("blocks") + F.greatest(mine, other)))
        dealt = (variants.join(small(long_lists), "key", "left")
                 .select("fingerprint", "key",
                         F.explode(F.when(F.col("blocks").isNull(), F.array(F.lit(0))).otherwise(pairs)).alias("sub")))

    start = np.zeros(64, np.uint64)
    for a, n in parts:
        start[a:a + n] = a

    def first_key(diff: np.ndarray) -> np.ndarray:
        """The lowest wildcard under which a pair with these differing bits meets."""
        out = np.full(len(diff), 64, np.int64)
        for a, n in reversed(parts):
            d = (diff >> np.uint64(a)) & np.uint64((1 << n) - 1)
            one = np.bitwise_count(d) <= 1
            low = np.where(d > 0, np.bitwise_count(d - np.uint64(1)), 0).astype(np.int64) + a
            out[one] = low[one]
        return out

    def compare(batches):
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def edges(key, fp):
            """Edges within runs of equal keys; a pair that meets under several is kept under the first."""
            cut = np.flatnonzero(np.any(key[1:] != key[:-1], axis=1)) + 1
            begin = np.concatenate([[0], cut])
            size = np.diff(np.append(begin, len(fp)))
            twos = begin[size == 2]
            got = [(fp[twos], fp[twos + 1], key[twos, 0])]
            for b, n in zip(begin[size > 2].tolist(), size[size > 2].tolist()):
                for x, y in tree(np.unique(fp[b:b + n]), max_bits):
                    got.append((x, y, np.full(len(x), key[b, 0])))
            x, y, k = (np.concatenate(c) for c in zip(*got))
            diff = x ^ y
            keep = (diff > 0) & (np.bitwise_count(diff) <= max_bits) & (first_key(diff) == k >> 50)
            return pa.RecordBatch.from_arrays([pa.array(x[keep].view(np.int64)), pa.array(y[keep].view(np.int64))],
                                              schema=schema)

        held_key, held = np.empty((0, 2), np.int64), np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.concatenate([held_key, np.stack([batch.column("key").to_numpy(),
                                                      batch.column("sub").to_numpy().astype(np.int64)], axis=1)])
            fp = np.concatenate([held, batch.column("fingerprint").to_numpy().view(np.uint64)])
            same = np.all(key == key[-1], axis=1)
            last = len(fp) - int(same[::-1].argmin() if not same.all() else len(fp))
            if last:
                yield edges(key[:last], fp[:last])
            held_key, held = key[last:], fp[last:]
        if len(held):
            yield edges(held_key, held)

    n = partitions(prints.sparkSession)
    return arrow(dealt.repartition(n, "key", "sub").sortWithinPartitions("key", "sub", "fingerprint"),
                 compare, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, seed: int = 42,
                    block: int = BLOCK, also: tuple[str, ...] = (), root: bool = False) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, the columns ``also``
    (longs), fingerprint (16 lower-case hex digits) and component_id, the
    smallest doc_id reachable over links of at most ``max_bits`` differing bits,
    its own included; with ``root`` also root, a fingerprint (as a long) that
    names the component even where another one has the same smallest id.

    Texts without words and null texts have fingerprint zero and are linked like
    any other. Equal fingerprints are one node, so copies cost one row however
    many they are. Repeated rows each get a row; a null doc_id gets its
    component's smallest id, null if there is none. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, shingle, seed, also), "fingerprints")
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "nodes")
    roots = components(links(nodes.select("fingerprint"), max_bits, block))
    rooted = (nodes.join(roots, nodes["fingerprint"] == roots["node"], "left")
              .select("fingerprint", "least", F.coalesce("component", "fingerprint").alias("root")))
    ids = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    more = ["root"] if root else []
    member = rooted.join(ids, "root").select(F.col("fingerprint").alias("fp"), "component_id", *more)
    return (prints.join(member, prints["fingerprint"] == member["fp"])
            .select("doc_id", *also, F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
                    "component_id", *more))
