"""Quality rules as a short-circuit cascade.

A document is kept if no rule rejects it, so the order of the rules decides the
cost and never the verdict. On a sample each rule's run time and its share of
rejections are measured; rules then run by rejection per cost, and a rule is
evaluated only for documents that all rules before it let pass.

Only DataFrame functions are used.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, words

SYMBOLS = r"[^#*$%&|<>]+"

#: bits of a packed window that hold its place in the text
PLACE = 26


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is computed once per row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(text, SYMBOLS, "")).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def packed_windows(w: Column) -> Column:
    """A sorted array of the 3-word windows of ``w``: a hash, with the place in the low bits."""
    last = F.greatest(F.size(w) - 3, F.lit(0))
    return F.when(F.size(w) < 4, F.array().cast("array<long>")).otherwise(F.sort_array(F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.shiftleft(F.xxhash64(w[i], w[i + 1], w[i + 2]), PLACE).bitwiseOR(i.cast("long")))))


def n_repeat_words(w: Column, windows: Column) -> Column:
    """Words of ``w`` inside 3-word windows that the text has twice or more.
    ``windows``: ``packed_windows(w)``. Equal hashes are neighbours there; the
    words behind them are compared, and should they ever differ, windows are
    sorted as strings."""
    def place(x: Column) -> Column:
        return x.bitwiseAND(F.lit((1 << PLACE) - 1)).cast("int")

    def differ(pair: Column) -> Column:
        p, q = pair["p"], pair["q"]
        return (w[p] != w[q]) | (w[p + 1] != w[q + 1]) | (w[p + 2] != w[q + 2])

    def count(pairs: Column) -> Column:
        begins = F.array_distinct(F.flatten(F.transform(pairs, lambda x: F.array(x["p"], x["q"]))))
        return F.size(F.array_distinct(F.flatten(F.transform(begins, lambda p: F.array(p, p + 1, p + 2)))))

    def neighbours(s: Column, key: Callable[[Column], Column], at: Callable[[Column], Column]) -> Column:
        found = F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda j: key(s[j]) == key(s[j - 1]))
        return F.transform(found, lambda j: F.struct(at(s[j - 1]).alias("p"), at(s[j]).alias("q")))

    exact = let(
        F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.concat_ws(" ", w[i], w[i + 1], w[i + 2]).alias("k"), i.alias("p")))),
        lambda s: count(neighbours(s, lambda x: x["k"], lambda x: x["p"])))
    by_hash = let(
        neighbours(windows, lambda x: F.shiftright(x, PLACE), place),
        lambda pairs: F.when(F.exists(pairs, differ), exact).otherwise(count(pairs)))
    return F.when(F.size(windows) < 2, 0).otherwise(by_hash).cast("long")


def measures(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text (null: empty),
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    w = F.col("w")
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .select("doc_id", "text", words(F.col("text")).alias("w"))
            .select("doc_id", "text", "w", packed_windows(w).alias("windows"))
            .select("doc_id", "text", F.size(w).cast("long").alias("n_words"),
                    F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                    n_symbols(F.col("text")).alias("n_symbols"), n_dup_lines(F.col("text")).alias("n_dup_lines"),
                    n_repeat_words(w, F.col("windows")).alias("n_repeat_words")))


@dataclass(frozen=True)
class Rule:
    """``rejects(text, w)``: whether a text with words ``w`` is rejected; never null."""

    name: str
    rejects: Callable[[Column, Column], Column]


def _count(text: Column, other: str) -> Column:
    return F.length(F.regexp_replace(text, other, ""))


#: the base rules: too few words, or mostly repeated
BASE = (
    Rule("few_words", lambda text, w: F.size(w) < 50),
    Rule("repeated_windows", lambda text, w: let(
        packed_windows(w), lambda s: 100 * n_repeat_words(w, s) > 50 * F.size(w))),
)

#: over one symbol for ten words; over half of the letters in capitals; over
#: half of the lines repeated; fewer than seven words in ten with a letter
RULES = (
    Rule("symbols", lambda text, w: 10 * n_symbols(text) > F.size(w)),
    Rule("capitals", lambda text, w: 2 * _count(text, r"[^\p{Lu}]+") > _count(text, r"[^\p{L}]+")),
    Rule("repeated_lines", lambda text, w: 2 * n_dup_lines(text) > F.size(F.split(text, "\n"))),
    Rule("no_letters", lambda text, w: 10 * F.size(F.filter(w, lambda x: x.rlike(r"\p{L}"))) < 7 * F.size(w)),
)


@dataclass(frozen=True)
class Estimate:
    """Of one rule on the sample: seconds beside those of reading it, and the share it rejects."""

    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / max(self.seconds, 1e-4)


def estimates(docs: DataFrame, rules=RULES, sample: int = 1000) -> list[Estimate]:
    """Cost and selectivity of each rule on the first ``sample`` rows that Spark
    finds, dearest worth first. The bound keeps this step's cost constant; the
    figures order the rules and change no verdict."""
    rows = stored(docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).limit(sample), "sample")
    prepared = rows.select("text", words(F.col("text")).alias("w"))

    def timed(what: Column) -> tuple[float, float]:
        best, share = float("inf"), 0.0
        for _ in range(2):
            t = time.perf_counter()
            share = prepared.agg(F.avg(what.cast("int")), F.sum(F.size("w"))).first()[0] or 0.0
            best = min(best, time.perf_counter() - t)
        return best, share

    idle, _ = timed(F.lit(False))
    got = [(rule, *timed(rule.rejects(F.col("text"), F.col("w")))) for rule in rules]
    return sorted((Estimate(rule, max(s - idle, 0.0), share) for rule, s, share in got),
                  key=lambda e: (-e.worth, e.seconds, e.rule.name))


def verdict(text: Column, rules) -> Column:
    """Name of the first of ``rules``, in their order, that rejects the text;
    null if none does. A later rule isn't evaluated for a text already rejected."""
    text = F.coalesce(text.cast("string"), F.lit(""))

    def first(w: Column) -> Column:
        case = F.when(F.lit(False), F.lit(None).cast("string"))
        for rule in rules:
            case = case.when(rule.rejects(text, w), F.lit(rule.name))
        return case

    return let(words(text), first)


def cascade(docs: DataFrame, rules=BASE + RULES, sample: int = 1000) -> tuple[Column, list[Estimate]]:
    """The verdict (see above) on the column ``text`` of ``docs`` by rules in
    measured order, and the measures. Null and empty texts are judged as texts
    without words; an empty table gives the rules in the order of their names."""
    plan = estimates(docs, rules, sample)
    return verdict(F.col("text"), [e.rule for e in plan]), plan


def kept_documents(docs: DataFrame, rules=BASE + RULES, sample: int = 1000) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns."""
    return docs.filter(cascade(docs, rules, sample)[0].isNull())


def judged(docs: DataFrame, sample: int = 1000) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): the measures, base_failed
    (fewer than 50 words, or over half of them in repeated windows), kept, and
    rejected_by, the first rule of the cascade that rejects it. Documents that
    fail the base never reach the cascade. Null texts have no words; repeated
    rows and null ids are judged like any other row."""
    case, _ = cascade(docs, RULES, sample)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (measures(docs).withColumn("base_failed", base_failed)
            .withColumn("rejected_by", F.when(~F.col("base_failed"), case))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    (~F.col("base_failed") & F.col("rejected_by").isNull()).alias("kept"), "rejected_by"))
