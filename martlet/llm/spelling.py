"""Spelling variants: words one edit apart, by search schemes over FM-indexes.

Of two words within one edit, one half of the target is untouched. So a search
matches the left half exactly and extends to the right allowing one error, or the
right half exactly and to the left; two pieces need no third search. An FM-index
extends a match in one direction, so extending to either side takes a pair of
them, of the delimited words and of the same words reversed; a scheme of two
pieces never turns round, so each search carries the suffix-rank interval of the
index that it uses, and the two can lie apart.

That is how Spark deals the work: a target goes, with each of its halves, to the
block of (side, length, half); a word goes as a query to the blocks of the halves
that it can share. A block is one task's FM-index; a half that many words share is
split over several blocks, each asked by all its queries. Only sums per word, and
never pairs, leave a block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import partitions, ship, small, stored

#: targets of one block, about; also the targets of one half that share a block
BLOCK = 16_384

FOUND = "word string, n_near long, n_form long, form string"


def runs(text: Column) -> Column:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF of 5 code points or more (a
    shorter one gives no word), only A-Z in lower case."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), upper, lower),
                                F.lit("([a-zÀ-ÿ]{5,})"), F.lit(1))


def vocabulary(docs: DataFrame, divisor: int = 97, least: int = 3, shortest: int = 5) -> DataFrame:
    """Words of ``docs`` (doc_id, text) and how often they occur: word, n. A run whose
    crc32 (of ``<doc_id>:<run>``) ``divisor`` divides loses the code point at crc32 %
    length. Null texts have no runs; a null doc_id counts as an empty one."""
    each = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                       F.explode(runs(F.col("text").cast("string"))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    word = F.when(h % divisor == 0, F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))).otherwise(F.col("run"))
    return (each.select(word.alias("word")).groupBy("word").agg(F.count("*").alias("n"))
            .filter((F.length("word") >= shortest) & (F.col("n") >= least)))


class FMIndex:
    """Suffix-rank intervals of delimited words. The text holds each word reversed
    and then a delimiter of the word's length, so that prepending to a pattern (what
    an FM-index does) reads a word from its start, and the first symbol of a search
    selects the words of one length."""

    def __init__(self, words: list[np.ndarray], symbols: int):
        """``words`` in symbols 0 to ``symbols`` - 1, none empty."""
        size = np.array([len(w) for w in words], np.int64)
        self.lengths, of = np.unique(size, return_inverse=True)
        self.symbols, self.letters = symbols + len(self.lengths), symbols
        end = np.cumsum(size + 1)
        text = np.empty(end[-1], np.int64)
        mark = np.zeros(end[-1], bool)
        mark[end - 1] = True
        text[mark] = symbols + of
        text[~mark] = np.concatenate([w[::-1] for w in words])
        self.n = n = len(text)
        self.suffixes = self._sorted(text)
        self.bwt = text[self.suffixes - 1]
        # places of each symbol in the transform: one sorted array of (symbol, place)
        self.places = np.sort(self.bwt * (n + 1) + np.arange(n))
        self.word_at = np.cumsum(mark) - mark      # the word that a text position belongs to

    @staticmethod
    def _sorted(text: np.ndarray) -> np.ndarray:
        """Suffix array by prefix doubling."""
        n, step = len(text), 1
        rank = np.unique(text, return_inverse=True)[1]
        while True:
            key = rank * (n + 1)
            key[:n - step] += rank[step:] + 1
            order = np.argsort(key, kind="stable")
            new = np.cumsum(np.concatenate([[False], key[order][1:] != key[order][:-1]]))
            rank = np.empty(n, np.int64)
            rank[order] = new
            if new[-1] == n - 1 or step >= n:
                return order
            step *= 2

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals with ``symbol`` before the pattern, by two rank queries each."""
        base = symbol * (self.n + 1)
        return np.searchsorted(self.places, base + low), np.searchsorted(self.places, base + high)

    def start(self, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the delimiters of words of these lengths; empty if there are none."""
        at = np.searchsorted(self.lengths, length)
        known = self.lengths[np.minimum(at, len(self.lengths) - 1)] == length
        low, high = self.extend(self.letters + np.minimum(at, len(self.lengths) - 1),
                                np.zeros(len(length), np.int64), np.full(len(length), self.n))
        return np.where(known, low, 0), np.where(known, high, 0)

    def symbols_before(self, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All one-letter extensions of intervals: which interval, symbol, new low and
        high. A narrow interval's symbols are read from the transform, a wide one's
        are all tried."""
        size = high - low
        narrow = np.flatnonzero(size <= self.letters)
        s = size[narrow]
        rows = np.repeat(low[narrow] - np.cumsum(s) + s, s) + np.arange(s.sum())
        pair = np.unique(np.repeat(narrow, s) * self.symbols + self.bwt[rows])
        wide = np.flatnonzero(size > self.letters)
        of = np.concatenate([pair // self.symbols, np.repeat(wide, self.letters)])
        symbol = np.concatenate([pair % self.symbols, np.tile(np.arange(self.letters), len(wide))])
        lo, hi = self.extend(symbol, low[of], high[of])
        some = (lo < hi) & (symbol < self.letters)
        return of[some], symbol[some], lo[some], hi[some]


def search(index: FMIndex, queries: list[np.ndarray], length: np.ndarray, exact: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, word) where the word has ``length``, starts with the query's
    first ``exact`` symbols and is one edit away behind them: a replaced symbol where
    the lengths agree, one deleted from the query where the word is shorter by one.
    Each pair comes once: of a run of equal symbols the last one is deleted."""
    size = np.array([len(q) for q in queries], np.int64)
    begin = np.cumsum(size) - size
    # a symbol no word has ends every query, so that one behind the last never matches
    flat = np.concatenate([*queries, np.array([-1], np.int64)])
    shorter = size > length

    def at(q: np.ndarray, place: np.ndarray) -> np.ndarray:
        return np.where(place < size[q], flat[np.minimum(begin[q] + place, len(flat) - 1)], -1)

    q = np.arange(len(queries))
    low, high = index.start(length)
    used = np.zeros(len(q), np.int64)      # errors so far
    found_q, found_low, found_high = [], [], []
    depth = 0
    while len(q):
        alive = low < high
        q, low, high, used = q[alive], low[alive], high[alive], used[alive]
        done = length[q] == depth
        # what is matched whole counts with one error; a query's last symbol may be what is deleted
        good = done & ((used == 1) | shorter[q])
        found_q.append(q[good])
        found_low.append(low[good])
        found_high.append(high[good])
        q, low, high, used = q[~done], low[~done], high[~done], used[~done]
        free = (used == 0) & (depth >= exact[q])
        # delete the query's symbol here: what follows is matched from the next one on
        drop = np.flatnonzero(free & shorter[q])
        drop = drop[at(q[drop], np.full(len(drop), depth)) != at(q[drop], np.full(len(drop), depth + 1))]
        # replace it: every other symbol that the index has before the interval
        change = np.flatnonzero(free & ~shorter[q])
        of, symbol, lo, hi = index.symbols_before(low[change], high[change])
        of = change[of]
        other = symbol != at(q[of], np.full(len(of), depth))
        # match it
        next_q, next_used = np.concatenate([q, q[drop]]), np.concatenate([used, np.ones(len(drop), np.int64)])
        next_low, next_high = np.concatenate([low, low[drop]]), np.concatenate([high, high[drop]])
        shift = np.where(shorter[next_q], next_used, 0)
        want = at(next_q, depth + shift)
        known = want >= 0
        next_low, next_high = index.extend(np.where(known, want, 0), next_low, np.where(known, next_high, next_low))
        q = np.concatenate([next_q, q[of[other]]])
        low, high = np.concatenate([next_low, lo[other]]), np.concatenate([next_high, hi[other]])
        used = np.concatenate([next_used, np.ones(int(other.sum()), np.int64)])
        depth += 1
    if not found_q:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    q, low, high = (np.concatenate(x) for x in (found_q, found_low, found_high))
    rows = high - low
    place = index.suffixes[np.repeat(low - np.cumsum(rows) + rows, rows) + np.arange(rows.sum())]
    return np.repeat(q, rows), index.word_at[place]


def _best(word: list[str], n: np.ndarray, a: np.ndarray, b: np.ndarray, order: np.ndarray) -> tuple:
    """Of pairs (a, b) for each a: how many b, and the b of largest n, then smallest."""
    by = np.lexsort([order[b], -n[b], a])
    a, b = a[by], b[by]
    first = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.empty(0, np.int64)
    count = np.diff(np.append(first, len(a)))
    return a[first], count, b[first]


def near_in_block(rows: pa.Table) -> pa.Table:
    """One block (word, n, side, length, target): for each word near a target or
    near a query here, how many and the best."""
    names = ["word", "n_near", "n_form", "form"]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string()]
    word = rows.column("word").to_pylist()
    n = rows.column("n").to_numpy()
    target = rows.column("target").to_numpy(zero_copy_only=False).astype(bool)
    right = rows.column("side").to_numpy() == 1
    length = rows.column("length").to_numpy().astype(np.int64)
    order = np.empty(len(word), np.int64)
    order[sorted(range(len(word)), key=word.__getitem__)] = np.arange(len(word))
    # equal words are equal in order, whether target or query
    ranked = np.array(word, object)[np.argsort(order)]
    order = np.cumsum(np.append(False, ranked[1:] != ranked[:-1]))[order] if len(word) else order
    got = []
    for side in (False, True):
        t, q = np.flatnonzero(target & (right == side)), np.flatnonzero(~target & (right == side))
        if not len(t) or not len(q):
            continue
        points = np.frombuffer("".join(word[k][::-1] if side else word[k] for k in [*t, *q]).encode("utf-32-le"), np.uint32)
        alphabet, code = np.unique(points, return_inverse=True)
        cut = np.split(code.astype(np.int64), np.cumsum([len(word[k]) for k in [*t, *q]])[:-1])
        index = FMIndex(cut[:len(t)], len(alphabet))
        half = length[q] // 2
        a, b = search(index, cut[len(t):], length[q], length[q] - half if side else half)
        a, b = q[a], t[b]
        if side:
            # found from the left, too: one of the two blocks counts it
            left = np.array([word[x][:length[x] // 2] != word[y][:length[x] // 2] for x, y in zip(a, b)], bool)
            a, b = a[left], b[left]
        shorter = np.array([len(word[x]) for x in a], np.int64) > length[a]
        got += [(a, b), (b[shorter], a[shorter])]
    if not got:
        return pa.table([pa.array([], k) for k in kinds], names=names)
    a, b = (np.concatenate(x) for x in zip(*got))
    of, count, best = _best(word, n, a, b, order)
    return pa.table([pa.array([word[k] for k in of], kinds[0]), pa.array(count, kinds[1]), pa.array(n[best], kinds[2]),
                     pa.array([word[k] for k in best], kinds[3])], names=names)


def _halves(words: DataFrame) -> DataFrame:
    """Targets with both halves, and queries with the halves that they can share
    with a word as long, or shorter by one: word, n, side (0 left, 1 right), length
    (the target's), half, target."""
    n = F.length("word")

    def part(side: int, less: int, target: bool) -> Column:
        length = n - less
        half = F.floor(length / 2).cast("int")
        text = F.substr("word", F.lit(1), half) if side == 0 else F.substr("word", n - (length - half) + 1)
        return F.struct(F.lit(side).alias("side"), length.alias("length"), text.alias("half"),
                        F.lit(target).alias("target"))

    parts = [part(side, less, target) for side in (0, 1) for less, target in ((0, True), (0, False), (1, False))]
    return words.select("word", "n", F.explode(F.array(*parts)).alias("x")).select("word", "n", "x.*")


def near_words(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """For every word of ``words`` (word, n; words distinct, of 2 code points or more)
    with a word one edit away: word, n_near (how many), form (that of largest n,
    ties: smallest in code-point order) and n_form (its n).

    A half that over ``block`` words share is split by the hash of the word, its
    queries likewise, and every part of one meets every part of the other, so a task
    holds a bounded part of the largest half, too."""
    ship(words.sparkSession)
    rows = _halves(words)
    key = ["side", "length", "half"]
    size = rows.groupBy(*key).agg(F.count_if("target").alias("t"), F.count_if(~F.col("target")).alias("q"))
    size = (size.select(*key, F.ceil(F.col("t") / block).cast("int").alias("t_parts"),
                        F.ceil(F.col("q") / (2 * block)).cast("int").alias("q_parts"))
            .filter("t_parts > 0 and (t_parts > 1 or q_parts > 1)"))
    large = small(stored(size, "large-halves"), 100_000)
    t_parts, q_parts = F.coalesce("t_parts", F.lit(1)), F.coalesce("q_parts", F.lit(1))
    h = F.xxhash64("word")

    def meets(own: Column, others: Column, mine_first: bool) -> Column:
        mine = F.pmod(h, own).cast("int")
        return F.transform(F.sequence(F.lit(0), others - 1), lambda o: F.struct(
            *[(mine if first else o).alias(name) for first, name in ((mine_first, "a"), (not mine_first, "b"))]))

    dealt = rows.join(large, key, "left").withColumn("part", F.explode(
        F.when(F.col("target"), meets(t_parts, q_parts, True)).otherwise(meets(q_parts, t_parts, False))))
    blocks = max(partitions(words.sparkSession), 2 * words.count() // block + 1)
    # a part of a large half is a block of its own: two parts in one block would meet twice
    own = F.col("t_parts").isNotNull()
    dealt = dealt.select(
        F.when(own, F.xxhash64(*key, "part").bitwiseOR(F.lit(-1 << 63))).otherwise(
            F.pmod(F.xxhash64(*key), F.lit(blocks))).alias("block"),
        "word", "n", "side", "length", "target")
    found = dealt.groupBy("block").applyInArrow(lambda t: near_in_block(t), FOUND)
    return (found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("n_form")).alias("n"), F.col("form").alias("form"))).alias("best"))
        .select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.n")).alias("n_form")))


def roots(forms: DataFrame) -> DataFrame:
    """Last word of every chain of ``forms`` (word, form; no circle), by pointer
    doubling: word, root. Each round is stored; a chain of k takes log2 k of them."""
    at = stored(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")), "roots")
    while not at.filter("moved").isEmpty():
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = stored(at.join(on, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
    return at.select("word", "root")


def spelling_variants(docs: DataFrame, block: int = BLOCK, divisor: int = 97, least: int = 3,
                      shortest: int = 5, factor: int = 2) -> DataFrame:
    """Words of all whole texts of ``docs`` (doc_id, text), grouped by spelling. One row
    per word: word, form, root, n, n_near, form_n.

    ``form`` is the near word (one code point inserted, deleted or replaced) of largest n,
    ties the smallest in code-point order, if that n is ``factor`` times the word's
    or more; else null, as is ``form_n``. ``root`` follows forms to the last. Repeated
    rows and ids count as often as they stand; null and empty texts have no words;
    more columns are dropped; an empty table gives no rows.
    """
    if factor < 2:
        raise ValueError("a form must be more frequent than its word, or forms could go in a circle")
    words = stored(vocabulary(docs, divisor, least, shortest), "words")
    near = words.join(near_words(words, block), "word", "left")
    own = F.col("n_form") >= factor * F.col("n")
    judged = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                                F.when(own, F.col("form")).alias("form"), F.when(own, F.col("n_form")).alias("form_n")),
                    "forms")
    last = roots(judged.filter("form is not null").select("word", "form"))
    return (judged.join(last, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
