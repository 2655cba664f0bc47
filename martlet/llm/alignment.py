"""Alignment of two tokenizers' tokens over the same bytes, by pointer jumping.

A byte-level BPE (A) and a piece model (B) encode a space and the text. Every
token points to the farthest-right token that overlaps it; successor doubling
over one array of all tokens brings each to the terminal token of its component,
which labels its group. Where both end, a component ends.

Neither vocabulary joins a word to the space behind it, so both end before every
single space between two other characters, and no component reaches over it. So
a text is cut there, cuts are aligned once per Python worker and remembered, and
a document is the sum of its cuts. The corpus-wide counts of linked id pairs are
a Spark aggregate; each document's links then meet them in a join.
"""

from __future__ import annotations

import hashlib
import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow, small, stored
from .tokens import groups

#: a space beside other white space, or at an end of the text
ODD = re.compile(r"(?:\A|\s) | (?:\s|\Z)")
CUT = re.compile(r"(?<=\S) (?=\S)")

#: cuts, and characters of them, that a Python worker remembers; then it
#: starts anew. Affects speed only.
MEMO, MEMO_CHARS = 400_000, 6_000_000

SPACE = "▁"  # the piece model's space

ROWS = ("lane long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
        "pairs array<long>, times array<int>")


def byte_level() -> dict[str, int]:
    """Byte by character of a byte-level vocabulary: printable Latin-1 characters
    stand for themselves, the other bytes for the characters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def terminals(end_a: np.ndarray, end_b: np.ndarray) -> np.ndarray:
    """The terminal token of every token's component, tokens being all of A and
    then all of B, given by their byte ends (ascending, of the same bytes)."""
    n = len(end_a)
    # of the other side, the token that holds a token's last byte reaches farthest
    over_a = np.searchsorted(end_b, end_a)
    over_b = np.searchsorted(end_a, end_b)
    further = end_a[over_b] > end_b
    to = np.concatenate([n + over_a, np.where(further, over_b, n + np.arange(len(end_b)))])
    while True:
        doubled = to[to]
        if np.array_equal(doubled, to):
            return to
        to = doubled


#: ids end to end, and how many each text has
Flat = tuple[np.ndarray, np.ndarray]


class Aligned:
    """Cuts by slot: counts, links end to end, the groups' text."""

    def __init__(self):
        self.slot: dict[str, int] = {}
        self.chars = 0
        self.counts = np.zeros((0, 5), np.int64)   # A, B, groups, links, bytes differ
        self.links = np.empty(0, np.int64)
        self.start = np.zeros(1, np.int64)
        self.text: list[str] = []


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(a_path), SentencePieceProcessor(model_file=b_path)
        self.a.encode_special_tokens = True
        byte = byte_level()
        # an entry that isn't byte-level text (a special token) can't come from a text
        self.a_bytes = [bytes(map(byte.__getitem__, e)) if all(c in byte for c in e) else None
                        for e in (self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size()))]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces) or any(
                re.search(r"\S ", x.decode(errors="replace")) for x in self.a_bytes if x):
            raise ValueError("a vocabulary joins words to the space behind them")
        self.a_size, self.b_size = (np.array([len(x or b"") for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_first = np.array([(x or b"").startswith(b" ") for x in self.a_bytes])
        self.b_first = np.array([p.startswith(SPACE) for p in pieces])
        # ids as text, with each mark that may follow
        ids = range(max(len(self.a_size), len(self.b_size)))
        self.comma, self.bar, self.semicolon = (np.array([f"{i}{m}" for i in ids], object) for m in ",|;")
        self.memo = Aligned()

    def _each(self, cuts: list[str]) -> tuple[list[Flat], np.ndarray]:
        """Ids of a space and each cut on both sides, and whether both give its bytes."""
        sides, same = [], np.ones(len(cuts), bool)
        for ids, table in (([e.ids for e in self.a.encode_batch_fast([" " + c for c in cuts], add_special_tokens=False)],
                            self.a_bytes), (self.b.encode(cuts, num_threads=1), self.b_bytes)):
            same &= [b"".join([table[i] or b"" for i in x]) == (" " + c).encode() for c, x in zip(cuts, ids)]
            sides.append((np.array([i for x in ids for i in x], np.int64), np.array([len(x) for x in ids], np.int64)))
        return sides, same

    def _joined(self, cuts: list[str]) -> tuple[list[Flat], np.ndarray]:
        """The same for cuts without a space in them and white space at their ends,
        encoded in one text: the first token of each begins with its space."""
        text = " ".join(cuts)
        whole, sides = (" " + text).encode(), []
        for ids, first, table in ((self.a.encode(" " + text, add_special_tokens=False).ids, self.a_first, self.a_bytes),
                                  (self.b.encode(text), self.b_first, self.b_bytes)):
            flat = np.array(ids, np.int64)
            begin = np.flatnonzero(first[flat])
            # where all bytes are as they were, and only cuts begin with a space, each cut's are
            if len(begin) != len(cuts) or b"".join([table[i] or b"" for i in ids]) != whole:
                return self._each(cuts)
            sides.append((flat, np.diff(np.append(begin, len(flat)))))
        return sides, np.ones(len(cuts), bool)

    def _learn(self, cuts: list[str]) -> None:
        odd = [c for c in cuts if c != c.strip() or " " in c or SPACE in c or not c]
        known = set(odd)
        plain = [c for c in cuts if c not in known]
        found = [self._each(odd)] if odd else []
        found += [self._joined(plain[i:i + 2000]) for i in range(0, len(plain), 2000)]
        cuts = odd + plain
        same = np.concatenate([x[1] for x in found])
        a, b = (tuple(np.concatenate([x[0][side][k] for x in found]) for k in (0, 1)) for side in (0, 1))
        if not same.all():
            a, b = ((flat[np.repeat(same, n)], n[same]) for flat, n in (a, b))
        counts, links, texts = self.align(a, b)
        m, at = self.memo, len(self.memo.text)
        rows = np.zeros((len(cuts), 5), np.int64)
        rows[same, :4], rows[~same, 4] = counts, 1
        m.counts = np.concatenate([m.counts, rows])
        m.links = np.concatenate([m.links, links])
        m.start = np.concatenate([m.start, m.start[-1] + np.cumsum(rows[:, 3])])
        kept = iter(texts)
        m.text += [next(kept) if x else "" for x in same.tolist()]
        m.slot.update(zip(cuts, range(at, at + len(cuts))))
        m.chars += sum(map(len, cuts))

    def align(self, a: Flat, b: Flat) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Per cut: A and B tokens, groups, links; all links, end to end, as
        A id * size of B's vocabulary + B id; per cut its groups' text."""
        (a, n_a), (b, n_b) = a, b
        if not len(a):
            return np.zeros((0, 4), np.int64), np.empty(0, np.int64), []
        end_a, end_b = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        last = end_a[np.cumsum(n_a) - 1]                         # where cuts end
        to = terminals(end_a, end_b)
        is_last = to[len(a):] == len(a) + np.arange(len(b))      # of B, each group's terminal
        label = np.cumsum(is_last) - is_last
        of_a, of_b = label[to[:len(a)] - len(a)], label[to[len(a):] - len(a)]
        n_groups = np.diff(np.searchsorted(end_b[is_last], last, "right"), prepend=0)
        # between two ends of either side lies exactly one overlapping pair
        ends = np.union1d(end_a, end_b)
        links = a[np.searchsorted(end_a, ends)] * len(self.b_size) + b[np.searchsorted(end_b, ends)]
        n_links = np.diff(np.searchsorted(ends, last, "right"), prepend=0)
        # A tokens of a group stand before its B tokens
        parts = np.empty(len(a) + len(b), object)
        last_a = np.append(of_a[1:] != of_a[:-1], True)
        parts[np.arange(len(a)) + np.searchsorted(of_b, of_a)] = np.where(last_a, self.bar[a], self.comma[a])
        parts[np.arange(len(b)) + np.searchsorted(of_a, of_b, "right")] = np.where(is_last, self.semicolon[b], self.comma[b])
        parts = parts.tolist()
        edge = np.cumsum(n_a + n_b).tolist()
        texts = ["".join(parts[s:e])[:-1] for s, e in zip([0, *edge[:-1]], edge)]
        return np.column_stack([n_a, n_b, n_groups, n_links]), links, texts

    def _slots(self, cuts: pa.Array) -> np.ndarray:
        """Memo slots of cuts; those it lacks are aligned first."""
        numbered = cuts.dictionary_encode()
        words = numbered.dictionary.to_pylist()
        if len(self.memo.text) > MEMO or self.memo.chars > MEMO_CHARS:
            self.memo = Aligned()
        new = [w for w in words if w not in self.memo.slot]
        if new:
            self._learn(new)
        at = np.fromiter(map(self.memo.slot.__getitem__, words), np.int64, len(words))
        return at[numbered.indices.to_numpy()]

    def documents(self, texts: list[str]) -> list[tuple]:
        """Per text: n_a, n_b, n_groups, n_links, groups_sha256, its distinct links
        and how often each occurs."""
        cuts = pa.array([CUT.split(t) if ODD.search(t) else t.split(" ") if t else [] for t in texts],
                        pa.list_(pa.string()))
        edge = cuts.offsets.to_numpy().astype(np.int64)
        at = self._slots(cuts.flatten())
        m = self.memo
        total = np.vstack([np.zeros(5, np.int64), np.cumsum(m.counts[at], 0)])
        sums = total[edge[1:]] - total[edge[:-1]]
        begin, size = m.start[at], m.start[at + 1] - m.start[at]
        out = np.cumsum(size)
        flat = m.links[np.repeat(begin - out + size, size) + np.arange(out[-1] if len(out) else 0)]
        link_edge = total[edge, 3]
        rows = []
        for k, (s, e) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist())):
            if s == e or sums[k, 4]:
                rows.append((0, 0, 0, 0, "", [], []))
                continue
            pairs, times = np.unique(flat[link_edge[k]:link_edge[k + 1]], return_counts=True)
            text = ";".join([m.text[i] for i in at[s:e].tolist()])
            rows.append((*sums[k, :4].tolist(), hashlib.sha256(text.encode()).hexdigest(), pairs, times.astype(np.int32)))
        return rows


@lru_cache(maxsize=1)
def aligner(a_path: str, b_path: str) -> Aligner:
    """One per Python worker and pair of vocabularies."""
    return Aligner(a_path, b_path)


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Every text of ``docs`` (doc_id, text) aligned: ``ROWS``. ``lane`` numbers the
    rows, ``pairs`` are A id * size of B's vocabulary + B id."""
    def run(batches):
        from pyspark import TaskContext

        lane = TaskContext.get().partitionId() << 40
        one = aligner(a_path, b_path)
        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for at, texts in groups(batch.column("text"), 1_000_000):
                rows = [(lane + i, keys[at + i], *r) for i, r in enumerate(one.documents(texts))]
                lane += len(rows)
                kinds = [*[pa.int64()] * 6, pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                    names=[x.split(" ")[0] for x in ROWS.split(", ")])

    return arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                 run, ROWS)


def pair_counts(rows: DataFrame, b_size: int) -> DataFrame:
    """How many documents hold each linked pair: pair, n_docs, best (no pair of its
    A id has more). An A id has at most ``b_size`` pairs."""
    n = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_docs"))
    w = Window.partitionBy(F.expr(f"pair div {b_size}"))
    return n.select("pair", "n_docs", (F.col("n_docs") == F.max("n_docs").over(w)).alias("best"))


def align_documents(docs: DataFrame, a_path: str, b_path: str, most: int = 4_000_000) -> DataFrame:
    """Both tokenizers' tokens of every whole text of ``docs`` (doc_id, text) aligned.
    One row per row: doc_id, n_a, n_b, n_groups, n_links (pairs of an A and a B
    token that overlap), n_best (links whose pair is held by the most documents
    of all pairs of its A id, ties included), count_sum (over the links, the documents
    that hold their pair) and groups_sha256.

    Texts that are null, empty or not given back byte by byte by either tokenizer have
    no tokens: zeros and ''. Rows with equal or null doc_id are documents of their
    own, repeated rows too; more columns are dropped; an empty table gives no rows.
    The table of pairs is broadcast up to ``most`` rows (of 17 bytes), else joined by a
    shuffle that splits hot pairs; a document's links are summed before any shuffle
    of their sums.
    """
    from sentencepiece import SentencePieceProcessor

    b_size = SentencePieceProcessor(model_file=b_path).get_piece_size()
    rows = stored(aligned(docs, a_path, b_path), "aligned")
    counts = small(stored(pair_counts(rows, b_size), "pairs"), most)
    links = rows.select("lane", F.explode(F.arrays_zip("pairs", "times")).alias("x")).select(
        "lane", F.col("x.pairs").alias("pair"), F.col("x.times").cast("long").alias("times"))
    sums = (links.join(counts, "pair").groupBy("lane")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                 F.sum(F.col("times") * F.col("n_docs")).alias("count_sum")))
    return (rows.drop("pairs", "times").join(sums, "lane", "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
