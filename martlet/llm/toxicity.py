"""Toxicity by a weighted finite-state pattern grammar.

Words become classes: insult (stems whose weights are learned from labels), threat, target,
negation, report, other. Four transducers read the classes of a clause and mark what they
find: one from right to left marks insults and threats with a target behind them; from left
to right, one those within reach of a negation, one those behind a verb of reporting,
one those with a target before them. The last weighs an insult or threat by its
marks. The left-to-right ones are composed to one machine, once; a clause's score is the sum over
its path of arc weight times word weight, so it is scored by how a word is said.

Arc weights are products of one factor per mark, fitted to all clauses of the labelled
documents within bounds: a target never lowers a word, a negation or a report never raises
one, whatever the sample holds. A document's score rises with the sum of its clauses.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import defaultdict
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import arrow, collected, stored

# Function words of the grammar, in English, German, French and Spanish.
NEGATION = frozenset("not never no nobody none nor neither cannot can't don't doesn't didn't isn't aren't wasn't won't "
                     "nicht kein keine keiner niemand nie pas jamais personne nunca nadie".split())
REPORTING = frozenset("said says wrote claimed quoted called sagte schrieb nannte dit écrit dijo escribió".split())
TARGET = frozenset("you your you're he she they them du dich ihr euch tu vous toi tú vosotros usted".split())
THREAT = frozenset("kill hurt destroy murder stab shoot töten umbringen tuer frapper matar".split())

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
CLAUSE = re.compile(r"[.!?;:,\n]+")

#: lengths of the stems that a word offers, beside the whole word
STEMS = (4, 5, 6)

#: words that a negation reaches forward over
REACH = 5

#: the weight of a threat, beside the learned weights of insults
THREAT_WEIGHT = 6.0

INSULT, THREATENING, OTHERS = "insult", "threat", ("target", "negation", "report", "other")
#: marks: a target in the clause, a negation before it, a report before it
MARKS = ("negated", "reported", "targeted")


def stems(word: str) -> set[str]:
    """The whole word, and its beginnings with a star."""
    return {word} | {word[:n] + "*" for n in STEMS if len(word) >= n}


@dataclass(frozen=True)
class Symbol:
    """What a machine reads or writes: a class of words, with the marks so far."""
    kind: str
    marks: frozenset[str] = frozenset()

    def with_mark(self, mark: str) -> Symbol:
        return Symbol(self.kind, self.marks | {mark}) if self.kind in (INSULT, THREATENING) else self


def alphabet(marks: Iterable[str]) -> list[Symbol]:
    """All classes, insults and threats with any of the marks."""
    sets = [frozenset()]
    for m in marks:
        sets += [x | {m} for x in sets]
    return [Symbol(k) for k in OTHERS] + [Symbol(k, x) for k in (INSULT, THREATENING) for x in sets]


@dataclass
class Transducer:
    """A deterministic weighted transducer: ``arcs`` has, for a state and a symbol read,
    the next state, the symbol written and a weight. All states are final."""
    start: object
    arcs: dict[tuple[object, Symbol], tuple[object, Symbol, float]]

    def run(self, symbols: Iterable[Symbol]) -> list[tuple[Symbol, float]]:
        state, out = self.start, []
        for x in symbols:
            state, y, w = self.arcs[state, x]
            out.append((y, w))
        return out


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The machine that writes what ``second`` writes on reading what ``first`` writes;
    weights multiply. It has the states that can be reached."""
    start = (first.start, second.start)
    by_state = defaultdict(list)
    for (state, x), arc in first.arcs.items():
        by_state[state].append((x, arc))
    arcs, todo, seen = {}, [start], {start}
    while todo:
        a, b = state = todo.pop()
        for x, (a2, y, w) in by_state[a]:
            b2, z, v = second.arcs[b, y]
            arcs[state, x] = ((a2, b2), z, w * v)
            if (a2, b2) not in seen:
                seen.add((a2, b2))
                todo.append((a2, b2))
    return Transducer(start, arcs)


def behind(kind: str, mark: str, marks: Iterable[str]) -> Transducer:
    """Marks what comes after a word of class ``kind``, as far as the clause goes."""
    arcs = {}
    for x in alphabet(marks):
        arcs["before", x] = ("behind" if x.kind == kind else "before", x, 1.0)
        arcs["behind", x] = ("behind", x.with_mark(mark), 1.0)
    return Transducer("before", arcs)


def within_reach(kind: str, mark: str, reach: int, marks: Iterable[str]) -> Transducer:
    """Marks the ``reach`` words after a word of class ``kind``; the state counts them down."""
    arcs = {}
    for x in alphabet(marks):
        for left in range(reach + 1):
            arcs[left, x] = (reach if x.kind == kind else max(left - 1, 0), x.with_mark(mark) if left else x, 1.0)
    return Transducer(0, arcs)


def weighing(factors: dict[str, float], marks: Iterable[str]) -> Transducer:
    """One state: an insult or threat weighs the product of its marks' factors (a
    threat that has no target ``untargeted``), any other class nothing."""
    arcs = {}
    for x in alphabet(marks):
        weight = 0.0
        if x.kind == INSULT:
            weight = math.prod(factors[m] for m in x.marks)
        elif x.kind == THREATENING:
            weight = math.prod(factors[m] for m in x.marks - {"targeted"}) * (
                factors["targeted"] if "targeted" in x.marks else factors["untargeted"])
        arcs[0, x] = (0, x, weight)
    return Transducer(0, arcs)


#: reads a clause from its end
TARGET_AHEAD = behind("target", "targeted", ())
#: reads what that writes, from the clause's begin
CONTEXT = composed(composed(within_reach("negation", "negated", REACH, ("targeted",)),
                            behind("report", "reported", ("targeted", "negated"))),
                   behind("target", "targeted", MARKS))

#: a clause's insults and threats by their marks
CONTEXTS = [x for x in alphabet(MARKS) if x.kind in (INSULT, THREATENING)]

# The factors before any clause was seen.
PRIOR = {"targeted": 1.5, "negated": 0.05, "reported": 0.05, "untargeted": 0.1}
# Where a factor may lie.
BOUNDS = {"targeted": (1.0, 4.0), "negated": (0.01, 1.0), "reported": (0.01, 1.0), "untargeted": (0.01, 1.0)}


class Grammar:
    """The grammar over learned ``weights`` by stem and ``factors`` by mark."""

    def __init__(self, weights: dict[str, float], factors: dict[str, float] | None = None):
        import ahocorasick

        self.weights, self.factors = weights, factors or dict(PRIOR)
        self.machine = composed(CONTEXT, weighing(self.factors, MARKS))
        self.place = {x: k for k, x in enumerate(CONTEXTS)}
        self.find = ahocorasick.Automaton()
        for stem in [*weights, *THREAT]:
            self.find.add_word(stem.rstrip("*"), 1)
        self.find.make_automaton()

    def read(self, word: str) -> tuple[Symbol, float]:
        """A word's class and weight."""
        weight = max((self.weights[s] for s in stems(word) if s in self.weights), default=0.0)
        if weight > 0:
            return Symbol(INSULT), weight
        for kind, words in ((THREATENING, THREAT), ("negation", NEGATION), ("report", REPORTING), ("target", TARGET)):
            if word in words:
                return Symbol(kind), THREAT_WEIGHT
        return Symbol("other"), 0.0

    def path(self, machine: Transducer, words: list[str]) -> list[tuple[Symbol, float, float]]:
        """What a machine writes for the words of a clause: symbol, arc weight, word weight."""
        read = [self.read(w) for w in words]
        ahead = [x for x, _ in TARGET_AHEAD.run([x for x, _ in reversed(read)])][::-1]
        return [(y, w, own) for (y, w), (_, own) in zip(machine.run(ahead), read)]

    def clauses(self, text: str | None):
        """The words of each clause in which a pattern may occur."""
        text = (text or "").lower()
        if not len(self.find) or next(self.find.iter(text), None) is None:
            return
        at = 0
        for part in [*CLAUSE.finditer(text), None]:
            piece = text[at:part.start()] if part else text[at:]
            at = part.end() if part else at
            if next(self.find.iter(piece), None) is not None:
                yield WORD.findall(piece)

    def clause(self, words: list[str]) -> float:
        """A clause's score."""
        return sum(w * own for _, w, own in self.path(self.machine, words))

    def evidence(self, text: str | None) -> float:
        """A text's score: the sum of its clauses'. Without a pattern it is 0."""
        return sum(map(self.clause, self.clauses(text)))

    def contexts(self, text: str | None) -> np.ndarray:
        """Word weights by ``CONTEXTS``, over all clauses: what factors are fitted to."""
        out = np.zeros(len(CONTEXTS))
        for words in self.clauses(text):
            for x, _, own in self.path(CONTEXT, words):
                if x in self.place:
                    out[self.place[x]] += own
        return out


def sampled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` labelled documents to learn from: those whose
    crc32(doc_id as text) isn't divisible by 5, by the hash of the id. Equal
    texts of one id count once; if ids with several texts make more than
    ``rows`` in all, each id's first text goes before any second."""
    ids = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = (ids.filter(F.crc32(F.col("doc_id").cast("string")) % 5 != 0)
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    mine = F.broadcast(ids.select(F.col("doc_id").alias("label_id"), "toxic"))  # of ``rows`` rows at most
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    found = stored(own.join(mine, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic").distinct(),
                   "labelled")
    if found.count() <= rows:
        return found
    key = F.xxhash64("text")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("key"))
    first = (found.select("doc_id", key.alias("key")).withColumn("nth", nth).filter(F.col("nth") <= rows)
             .orderBy("nth", F.xxhash64("doc_id"), "doc_id").limit(rows)
             .select(F.col("doc_id").alias("label_id"), "key"))
    return stored(found.join(F.broadcast(first), (F.col("doc_id") == F.col("label_id")) & (key == F.col("key")),
                             "left_semi"), "labelled-first")


def learned(train: DataFrame, least: int = 5, share: float = 0.98, depth: int = 3,
            common: float = 0.02, most: int = 500_000) -> dict[str, float]:
    """Stems and their weights (log odds). Counts by stem run in Spark; stems in
    at least ``least`` toxic documents, with at most one in ``1 / (1 - share)``
    of their documents harmless, are candidates. Of these the one that covers
    most toxic documents not yet covered is taken, until none covers ``least``:
    words that only keep a stem company don't get in. Stems that are common
    among toxic documents (a share of ``common``) may then cover documents again,
    up to ``depth`` times, so that a text with one of them alone is told, too.
    All candidates take part; over ``most`` of them it raises."""
    def count(batches):
        for batch in batches:
            got = defaultdict(lambda: [0, 0, []])
            for i, t, y in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))):
                for s in set().union(*map(stems, set(WORD.findall(t.lower())))) if t else ():
                    x = got[s]
                    x[1 if y else 0] += 1
                    if y:
                        x[2].append(i)
            yield pa.RecordBatch.from_pydict(
                {"stem": list(got), "clean": [x[0] for x in got.values()], "toxic": [x[1] for x in got.values()],
                 "ids": [x[2] for x in got.values()]},
                pa.schema([("stem", pa.string()), ("clean", pa.int64()), ("toxic", pa.int64()),
                           ("ids", pa.list_(pa.int64()))]))

    n = {r.toxic: r["count"] for r in train.groupBy((F.col("toxic") > 0).alias("toxic")).count().collect()}
    if not n.get(True):
        return {}
    rows = (arrow(train, count, "stem string, clean long, toxic long, ids array<long>")
            .groupBy("stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"),
                                 F.array_distinct(F.flatten(F.collect_list("ids"))).alias("ids"))
            .filter((F.col("toxic") >= least) & (F.col("toxic") >= share * (F.col("toxic") + F.col("clean")))))
    left = {r.stem: (set(r.ids), r.toxic, r.clean) for r in collected(rows, most, "stems")}
    order = sorted(left, key=lambda s: (left[s][2], -len(s), [-ord(c) for c in s]))
    weights: dict[str, float] = {}
    covered: dict[int, int] = defaultdict(int)
    taken: set[str] = set()
    begun: set[str] = set()
    for times, gain in ((1, least), (depth, max(least, common * n[True]))):
        def lacking(stem: str) -> int:
            return sum(covered[i] < times for i in left[stem][0])

        # what a stem lacks only shrinks: the first in the heap that is up to date is the best
        heap = [(-lacking(s), at, s) for at, s in enumerate(order)]
        heapq.heapify(heap)
        while heap and -heap[0][0] >= gain:
            was, at, best = heapq.heappop(heap)
            word = best.rstrip("*")
            # neither the beginnings of a stem taken nor what goes on from it
            if word in begun or any(word[:n] in taken for n in range(1, len(word) + 1)):
                continue
            now = -lacking(best)
            if now != was:
                heapq.heappush(heap, (now, at, best))
                continue
            ids, toxic, clean = left[best]
            weights[best] = math.log((toxic + 0.5) / n[True]) - math.log((clean + 0.5) / max(n.get(False, 0), 1))
            for i in ids:
                covered[i] += 1
            taken.add(word)
            begun.update(word[:k] for k in range(1, len(word) + 1))
    return weights


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.05, steps: int = 50) -> tuple[float, float, float]:
    """Slope (not below 0), constant and loss of a logistic model of one variable, by Newton's method."""
    x, theta, keep = np.column_stack([x, np.ones(len(x))]), np.zeros(2), ridge * np.eye(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + keep, x.T @ (y - p) - keep @ theta)
        theta = np.maximum(theta + np.clip(step, -2, 2), [0, -np.inf])
        if np.abs(step).max() < 1e-6:
            break
    z = np.clip(x @ theta, -30, 30)
    return theta[0], theta[1], float(np.sum(np.logaddexp(0, z) - y * z) + ridge * theta @ theta / 2)


def fitted(contexts: np.ndarray, y: np.ndarray, hold: float = 50.0) -> tuple[dict[str, float], float, float]:
    """Factors by mark, slope and constant. ``contexts`` has a labelled document per row. One factor
    after the other moves within its bounds while the loss falls; ``hold`` is how dear it
    is to move from the prior, in loss by squared log."""
    def loss(factors: dict[str, float]) -> tuple[float, float, float]:
        by = weighing(factors, MARKS)
        a, b, own = logistic(np.log1p(contexts @ np.array([by.arcs[0, x][2] for x in CONTEXTS])), y)
        return own + hold * sum(math.log(factors[m] / PRIOR[m]) ** 2 for m in PRIOR), a, b

    factors, best = dict(PRIOR), loss(PRIOR)
    for step in (1.5, 1.2, 1.05):
        moved = True
        while moved:
            moved = False
            for m in PRIOR:
                for by in (step, 1 / step):
                    tried = factors | {m: min(max(factors[m] * by, BOUNDS[m][0]), BOUNDS[m][1])}
                    found = loss(tried)
                    if found[0] < best[0] - 1e-9:
                        factors, best, moved = tried, found, True
    return factors, best[1], best[2]


def with_contexts(docs: DataFrame, grammar: Grammar) -> DataFrame:
    """``docs`` (doc_id, text, toxic) with the contexts as an array in place of the text."""
    weights = grammar.weights

    def run(batches):
        machine = Grammar(weights)
        for batch in batches:
            got = [machine.contexts(t.as_py()).tolist() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(got, pa.list_(pa.float64())), batch.column("toxic")],
                names=["doc_id", "contexts", "toxic"])

    return arrow(docs.select("doc_id", "text", "toxic"), run, "doc_id long, contexts array<double>, toxic int")


def scored(docs: DataFrame, labels: DataFrame, rows: int = 12_000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, held_out (its
    crc32 mod 5 is 0: its label is never read), score (0 to 1) and predicted (1
    from 0.5 on). Stems and model are learned from at most ``rows`` labelled
    documents; every document is scored over its whole text.

    Null and empty texts have no clauses and get the score of any text without
    a match; rows of one doc_id are scored each by its own text; a null doc_id
    is scored and counts as not held out. Without labels, or without toxic ones,
    every score is 0. An empty table gives no rows.
    """
    train = sampled(docs, labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")), rows)
    grammar = Grammar(learned(train))
    model = None
    if grammar.weights:
        seen = collected(with_contexts(train, grammar).select("contexts", "toxic"), 4 * rows, "labelled rows")
        model = fitted(np.array([r.contexts for r in seen]), np.array([float(r.toxic > 0) for r in seen]))

    weights = grammar.weights

    def run(batches):
        machine = Grammar(weights, model and model[0])
        for batch in batches:
            if model is None:
                score = np.zeros(batch.num_rows)
            else:
                z = model[1] * np.log1p([machine.evidence(x.as_py()) for x in batch.column("text")]) + model[2]
                score = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], names=["doc_id", "score"])

    out = arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")),
                run, "doc_id long, score double")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
