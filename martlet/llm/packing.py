"""Best-fit packing of documents into sequences, by the sum-of-squares rule.

A document longer than a sequence is cut into pieces of one sequence each; what
is left over is its first piece. Every full piece is a sequence. The others are
dealt by hash into groups of bounded size, and each group is packed by itself:
longest first, a piece goes to the open sequence (or a new one) for which the
squared counts of open sequences per residual gap become smallest. That rule
keeps gaps of all sizes in stock and leaves some sequences open when documents
run out; the pieces of those are gathered from all groups and placed once more,
longest first, each into the smallest gap that takes it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import arrow, stored
from .tokens import CHARS, encoder, groups

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, lane long"
PLACED = "lane long, length long, sequence long, offset long, open boolean"

#: pieces packed by one task at a time
GROUP = 65_536


def cut(docs: DataFrame, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and
    ``lane``, a number of its own for each piece."""
    def pieces(batches):
        from pyspark import TaskContext

        lane = TaskContext.get().partitionId() << 40
        enc = encoder(vocabulary)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for at, texts in groups(batch.column("text"), CHARS):
                rows = []
                for k, ids in enumerate(enc.encode(texts), at):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    first = len(ids) % size or size
                    edges = [0, *range(first, len(ids) + 1, size)]
                    for piece, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                        rows.append((keys[k], piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), lane))
                        lane += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), *[pa.int64()] * 4])],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "lane"])

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                 pieces, PIECE)


def sum_of_squares(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place ``lengths`` in the order given. Returns each one's sequence (from
    0) and offset there, and each sequence's fill."""
    count = np.zeros(size + 1, np.int64)       # open sequences by gap
    stock: list[list[int]] = [[] for _ in range(size + 1)]
    fill: list[int] = []
    seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        # gap h becomes h - s: the sum of squares changes by 2 (N[h-s] - N[h]) + 2
        change = 2 * (count[:size + 1 - s] - count[s:]) + 2
        change[0] = 1 - 2 * count[s]           # closed sequences aren't counted
        change[count[s:] == 0] = 1 << 60       # no such sequence
        change[size - s] = 2 * count[size - s] + 1 if s < size else 0
        left = int(change.argmin())
        gap = left + s
        if gap == size:
            b = len(fill)
            fill.append(0)
        else:
            b = stock[gap].pop()
            count[gap] -= 1
        seq[i], off[i] = b, fill[b]
        fill[b] += s
        if left:
            stock[left].append(b)
            count[left] += 1
    return seq, off, np.array(fill, np.int64)


def smallest_gap(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place ``lengths`` in the order given, each into the smallest gap that takes it."""
    count = np.zeros(size + 1, np.int64)
    stock: list[list[int]] = [[] for _ in range(size + 1)]
    fill: list[int] = []
    seq, off = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, s in enumerate(lengths.tolist()):
        fits = count[s:] > 0
        left = int(fits.argmax())
        if fits[left]:
            gap = left + s
            b = stock[gap].pop()
            count[gap] -= 1
        else:
            b, left = len(fill), size - s
            fill.append(0)
        seq[i], off[i] = b, fill[b]
        fill[b] += s
        if left:
            stock[left].append(b)
            count[left] += 1
    return seq, off, np.array(fill, np.int64)


def _round(pieces: DataFrame, n: int, first: int, place, size: int, group: int) -> DataFrame:
    """Deal ``n`` pieces into groups of about ``group`` and place each group's."""
    k = max(1, -(-n // group))

    def one(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "lane"], ascending=[False, True], kind="stable")
        seq, off, fill = place(pdf["length"].to_numpy(), size)
        return pd.DataFrame({"lane": pdf["lane"], "length": pdf["length"],
                             "sequence": first + (int(key[0]) << 32) + seq, "offset": off,
                             "open": fill[seq] < size})

    return (pieces.select("lane", "length")
            .groupBy(F.pmod(F.xxhash64("lane"), F.lit(k)).cast("long").alias("g"))
            .applyInPandas(one, PLACED))


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 1024, end_id: int = 2,
                   group: int = GROUP) -> DataFrame:
    """Pack every whole text of ``docs`` (doc_id, text), each with ``end_id``
    behind it, into sequences of at most ``size`` tokens. One row per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null texts count as empty (the end id alone), rows with equal or null doc_id
    are documents of their own, ties are placed in the order of a number given
    to each piece, and an empty table gives no rows. A group's work is bounded
    by ``group`` pieces however the lengths are spread: pieces are dealt by the
    hash of their number, so no key can gather them.
    """
    pieces = stored(cut(docs, vocabulary, end_id, size), "pieces")
    full = (pieces.filter(F.col("length") == size)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (-1 - F.col("lane")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")))
    part = pieces.filter(F.col("length") < size)
    placed = stored(_round(part, part.count(), 0, sum_of_squares, size, group), "placed")
    left = placed.filter("open")
    again = _round(left, left.count(), 1 << 61, smallest_gap, size, group)
    where = placed.filter("not open").unionByName(again).select("lane", "sequence", "offset")
    return full.unionByName(
        part.join(where, "lane")
        .select("doc_id", "piece", "start", "length", "ids_crc32",
                F.col("sequence").alias("sequence_id"), "offset"))
