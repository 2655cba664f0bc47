"""Secret scans: patterns, and a battery of randomness tests for other tokens.

A candidate is a long token of code characters that holds a letter and a digit.
Its encoding is inferred (hexadecimal, base 32, 36, 62 or 64) and its characters
are read as numbers of that alphabet. Three tests ask whether they look random:
chi-squared for the uniformity of the alphabet, runs above and below the middle,
and the serial correlation of neighbours. A fourth figure asks whether the token
could be ordinary text: how likely text is to spell it, by how seldom text
changes its character class (lower case, capital, digit, sign) and by how often
it uses each letter, against the likelihood of a random token of that encoding.
Under text that quotient exceeds t with a probability of at most 1/t (Markov),
so its inverse is a p-value; it is held to a false-discovery rate within each
class of length over all candidates of the corpus.

Only DataFrame functions are used.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import collected
from .quality import let

# Fixed values of the base patterns, by kind: pattern, group and least length.
BASE = {
    "assign": (r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}

#: the same matches, told sooner: a text without them has no span of the kind
SEEN = {
    "assign": r"(?i)(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]",
    "access": r"AKIA[A-Z0-9]{12}",
    "hex": r"(?<![0-9a-f])[0-9a-f]{32}",
}

#: the matches of 32 and more, without those that would be dropped
HEX = r"(?<![0-9a-f])[0-9a-f]{32,}"

#: ``=`` is padding behind a token and no more: KEY=token and ?sig=token are candidates
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_-])"

#: alphabets by inferred encoding; base 64 takes both of its sign pairs
HEX_DIGITS = "0123456789abcdef"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
BASE36 = "0123456789abcdefghijklmnopqrstuvwxyz"
BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"

#: alphabets that an encoding is inferred from: hexadecimal, base 32 and 36 in either case, base 62 and 64
ENCODINGS = 8

#: a token of so many letters and digits without a sign isn't base 64
UNSIGNED = 128

#: letters in 1,000 of English text, a to z
LETTERS = (82, 13, 28, 43, 127, 22, 20, 61, 70, 1.5, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24, 1.5, 20, 1)

#: values merged at a time, and code points of a piece of text that is cut from
BLOCK, PIECE = 256, 1024

RANDOM = "random"
#: behind every place in a text
LATE = (1 << 31) - 1
SPAN = "array<struct<start:int,rank:int,kind:string,end:int>>"

#: steps of -log10 of a p-value, and the last one
STEP, LAST = 0.1, 600


def larger(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def smaller(a: Column, b: Column) -> Column:
    return F.least(a, b)


def running(values: Column, zero: Column, kind: str, merge: Callable[[Column, Column], Column]) -> Column:
    """For each of ``values`` the merger of all before it (``zero`` for the first), and
    behind them that of all. Blocks of ``BLOCK`` values are merged first, then the blocks' own
    values from where each begins, so an array that grows by appending is never long."""
    none = F.array().cast(f"array<{kind}>")

    def all_before(v: Column, first: Column) -> Column:
        start = F.struct(first.alias("at"), none.alias("out"))
        return F.aggregate(v, start, lambda s, x: F.struct(
            merge(s["at"], x).alias("at"), F.concat(s["out"], F.array(s["at"])).alias("out")), lambda s: s["out"])

    def whole(v: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BLOCK).cast("int"))

        def block(k: Column) -> Column:
            return F.slice(v, k * BLOCK + 1, F.lit(BLOCK))

        sums = F.transform(blocks, lambda k: F.aggregate(block(k), zero, merge))
        return let(all_before(sums, zero), lambda begin: F.flatten(F.transform(
            blocks, lambda k: all_before(block(k), begin[k]))))

    return F.when(F.size(values) > 0, let(values, lambda v: let(whole(v), lambda before: F.concat(
        before, F.array(merge(F.element_at(before, -1), F.element_at(v, -1))))))).otherwise(F.array(zero))


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Leftmost matches in order: array of start, end (code points) and value
    (of the group). The text between matches and the matches themselves, in
    turn, add up to their places."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else whole
    between = F.split(text, pattern, -1)

    def placed(parts: Column) -> Column:
        b, m, v = parts["b"], parts["m"], parts["v"]
        steps = F.transform(m, lambda x, i: F.length(b[i]) + F.length(x))
        return let(running(steps, F.lit(0), "int", lambda a, x: a + x), lambda at: F.transform(m, lambda x, i: F.struct(
            (at[i + 1] - F.length(x)).alias("start"), at[i + 1].alias("end"), v[i].alias("value"))))

    return let(F.struct(between.alias("b"), whole.alias("m"), value.alias("v")), placed)


def base_spans(text: Column) -> Column:
    """Spans of the base patterns by start, then kind as listed."""
    def of(rank: int, kind: str, pattern: str, group: int, least: int) -> Column:
        long = F.filter(matches(text, pattern, group), lambda m: F.length(m["value"]) >= least)
        found = F.transform(long, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"),
                                                     F.lit(kind).alias("kind"), m["end"].alias("end")))
        return F.when(text.rlike(SEEN[kind]), found).otherwise(F.array().cast(SPAN))

    parts = [of(rank, kind, HEX if kind == "hex" else pattern, group, least)
             for rank, (kind, (pattern, group, least)) in enumerate(BASE.items())]
    return F.array_sort(F.concat(*parts))


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, to some 7 digits."""
    # Abramowitz and Stegun 26.2.17
    a = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(z))
    poly = F.lit(0.0)
    for c in reversed(a):
        poly = (poly + c) * t
    tail = F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, tail).otherwise(1 - tail)


def battery(token: Column) -> Column:
    """The tests' figures for one token: n, encoding, p_uniform, p_runs, p_serial."""
    body = F.regexp_replace(token, r"=+$", "")
    encoding = (F.when(body.rlike(r"^(?:[0-9a-f]+|[0-9A-F]+)$"), F.lit(16))
                .when(body.rlike(r"^(?:[A-Z2-7]+|[a-z2-7]+)$"), F.lit(32))
                .when(body.rlike(r"^(?:[0-9a-z]+|[0-9A-Z]+)$"), F.lit(36))
                .when(body.rlike(rf"^[A-Za-z0-9]{{{UNSIGNED},}}$"), F.lit(62)).otherwise(F.lit(64)))

    def of(x: Column) -> Column:
        size = x["size"]
        alphabet = (F.when(size == 16, F.lit(HEX_DIGITS)).when(size == 32, F.lit(BASE32))
                    .when(size == 36, F.lit(BASE36)).otherwise(F.lit(BASE64)))
        plain = (F.when(size == 32, F.upper(x["body"])).when(size <= 36, F.lower(x["body"]))
                 .otherwise(F.translate(x["body"], "-_", "+/")))
        codes = F.transform(F.split(plain, ""), lambda c: F.instr(alphabet, c) - 1)
        return let(F.struct(size.alias("size"), codes.alias("c")), figures)

    def figures(x: Column) -> Column:
        c, size = x["c"], x["size"].cast("double")
        n = F.size(c).cast("double")
        total = F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
        squares = F.aggregate(F.array_distinct(c), F.lit(0.0), lambda a, v: a + F.pow(
            F.size(F.filter(c, lambda o: o == v)).cast("double"), F.lit(2.0)))
        return let(F.struct(c.alias("c"), size.alias("size"), n.alias("n"), (total / n).alias("mean"),
                            (squares * size / n - n).alias("chi"),
                            F.transform(c, lambda v: (v >= size / 2).cast("int")).alias("high")), tests)

    def tests(x: Column) -> Column:
        c, high, n, mean = x["c"], x["high"], x["n"], x["mean"]
        df = x["size"] - 1
        z_uniform = (F.pow(x["chi"] / df, F.lit(1 / 3)) - (1 - 2 / (9 * df))) / F.sqrt(2 / (9 * df))
        ones = F.aggregate(high, F.lit(0.0), lambda a, v: a + v)
        pairs = F.sequence(F.lit(1), F.size(c) - 1)
        runs = 1 + F.size(F.filter(pairs, lambda i: high[i] != high[i - 1]))
        expect = 2 * ones * (n - ones) / n + 1
        spread = F.sqrt(F.greatest((expect - 1) * (expect - 2) / (n - 1), F.lit(1e-9)))
        deviation = F.aggregate(c, F.lit(0.0), lambda a, v: a + (v - mean) * (v - mean))
        both = F.aggregate(pairs, F.lit(0.0), lambda a, i: a + (c[i] - mean) * (c[i - 1] - mean))
        serial = F.when(deviation > 0, both / deviation * F.sqrt(n)).otherwise(F.lit(99.0))
        return F.struct(n.cast("int").alias("n"), x["size"].cast("int").alias("encoding"),
                        upper_tail(z_uniform).alias("p_uniform"),
                        (2 * upper_tail(F.abs((runs - expect) / spread))).alias("p_runs"),
                        (2 * upper_tail(F.abs(serial))).alias("p_serial"))

    return let(F.struct(body.alias("body"), encoding.alias("size")), of)


def spelling() -> dict[str, float]:
    """-log10 of the share of each character in ordinary text, within its class. A
    quarter of the letters is dealt evenly, for other languages and abbreviations."""
    share = {chr(97 + i): 0.75 * n / sum(LETTERS) + 0.25 / 26 for i, n in enumerate(LETTERS)}
    share |= dict.fromkeys("0123456789", 1 / 10) | dict.fromkeys("+/_-", 1 / 4)
    return {c: -math.log10(p) for c, p in share.items()}


def text_tail(token: Column, encoding: Column, rate: float) -> Column:
    """-log10 of a bound on the chance that ordinary text, whose character class
    changes between neighbours at ``rate``, spells a token that speaks as much for
    a random one of any encoding as this does (0 where the token looks like text)."""
    body = F.regexp_replace(token, r"=+$", "")
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(
        body, r"[a-z]", "l"), r"[A-Z]", "u"), r"[0-9]", "n"), r"[+/_-]", "s")
    cost = F.create_map(*[F.lit(x) for pair in spelling().items() for x in pair])

    def bound(x: Column) -> Column:
        n, turns = F.length(x["body"]), F.length(x["turns"]) - 1
        spelt = F.aggregate(F.split(F.lower(x["body"]), ""), F.lit(0.0),
                            lambda a, c: a + F.coalesce(F.try_element_at(cost, c), F.lit(0.0)))
        text = math.log10(4) + turns * -math.log10(rate / 3) + (n - 1 - turns) * -math.log10(1 - rate) + spelt
        return F.greatest(text - n * F.log10(encoding.cast("double")) - math.log10(ENCODINGS), F.lit(0.0))

    return let(F.struct(body.alias("body"), F.regexp_replace(classes, r"(.)(?=\1)", "").alias("turns")), bound)


def tested(text: Column, rate: float, alpha: float) -> Column:
    """All candidates of a text: start, end, size class, step of the text bound,
    and whether the battery, at ``alpha`` for its three tests together, lets the token pass as random."""
    found = F.filter(matches(text, CANDIDATE),
                     lambda m: m["value"].rlike("[0-9]") & m["value"].rlike("[A-Za-z]"))

    def judged(m: Column) -> Column:
        return let(F.struct(m.alias("m"), battery(m["value"]).alias("b")), lambda x: put(x["m"], x["b"]))

    def put(m: Column, b: Column) -> Column:
        tail = text_tail(m["value"], b["encoding"], rate)
        return F.struct(m["start"].alias("start"), m["end"].alias("end"),
                        F.floor(2 * F.log2((m["end"] - m["start"]).cast("double"))).cast("int").alias("size_class"),
                        F.least(F.floor(tail / STEP), F.lit(LAST)).cast("int").alias("step"),
                        (F.least(b["p_uniform"], b["p_runs"], b["p_serial"]) >= alpha / 3).alias("random"))

    none = F.array().cast("array<struct<start:int,end:int,size_class:int,step:int,random:boolean>>")
    return F.when(text.rlike(CANDIDATE), F.transform(found, judged)).otherwise(none)


def cutoffs(docs: DataFrame, rate: float = 0.2, alpha: float = 0.01, fdr: float = 0.01) -> dict[int, int]:
    """The least step that is a discovery, by class of length, at false-discovery
    rate ``fdr`` (Benjamini and Hochberg, on steps of 0.1 of -log10 p) over all
    candidates of ``docs`` (text). Two classes double the length, and steps end
    at ``LAST``: the table is small by its meaning."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    counts = (docs.select(F.explode(tested(text, rate, alpha)).alias("t"))
              .groupBy("t.size_class", "t.step").count())
    own = Window.partitionBy("size_class")
    ranked = counts.select("size_class", "step", F.sum("count").over(own).alias("all"),
                           F.sum("count").over(own.orderBy(F.desc("step"))).alias("above"))
    found = (ranked.filter(F.pow(F.lit(10.0), -STEP * F.col("step")) * F.col("all") <= fdr * F.col("above"))
             .groupBy("size_class").agg(F.min("step").alias("step")))
    return {r.size_class: r.step for r in collected(found, 100, "length classes")}


def spans(text: Column, cut: dict[int, int], rate: float = 0.2, alpha: float = 0.01) -> Column:
    """All spans of a text by start, then kind: those of the base patterns, and
    candidates that pass the battery, are discoveries and touch no base span."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    if not cut:
        return base_spans(text)
    least = F.create_map(*[F.lit(x) for pair in sorted(cut.items()) for x in pair])

    def joined(base: Column) -> Column:
        new = F.filter(tested(text, rate, alpha), lambda t: (
            t["random"] & F.coalesce(t["step"] >= F.try_element_at(least, t["size_class"]), F.lit(False))))
        spans = F.transform(new, lambda t: F.struct(t["start"].alias("start"), F.lit(len(BASE)).alias("rank"),
                                                    F.lit(RANDOM).alias("kind"), t["end"].alias("end")))
        return F.when(F.size(spans) > 0, let(F.array_sort(F.concat(base, spans)), apart)).otherwise(base)

    def apart(both: Column) -> Column:
        # a candidate touches a base span that begins before it ends: behind it, one that
        # begins no earlier, is the next base span; before it, one that ends after its begin
        base_end = F.transform(both, lambda x: F.when(x["kind"] != RANDOM, x["end"]).otherwise(0))
        turned = F.transform(F.reverse(both), lambda x: F.when(x["kind"] != RANDOM, x["start"]).otherwise(LATE))
        return let(F.struct(running(base_end, F.lit(0), "int", larger).alias("ends"),
                            F.reverse(running(turned, F.lit(LATE), "int", smaller)).alias("next")),
                   lambda o: F.filter(both, lambda x, i: (x["kind"] != RANDOM) | (
                       (o["ends"][i] <= x["start"]) & (o["next"][i + 1] >= x["end"]))))

    return let(base_spans(text), joined)


def listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_assign, n_access,
    n_hex, n_random, base_sha256 (of the base spans, kind:start:end) and spans
    (all of them). Places count code points. A null or empty text has no spans;
    repeated rows and null ids are scanned like any other row."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), spans(F.col("text"), cutoffs(docs)).alias("s"))

    def of(kind: str) -> Callable[[Column], Column]:
        return lambda x: x["kind"] == kind

    return found.select(
        "doc_id", *[F.size(F.filter("s", of(k))).cast("long").alias(f"n_{k}") for k in (*BASE, RANDOM)],
        F.sha2(listed(F.filter("s", lambda x: x["kind"] != RANDOM)), 256).alias("base_sha256"),
        listed(F.col("s")).alias("spans"))


def redacted(text: Column, found: Column, mark: str = "[SECRET]") -> Column:
    """``text`` with its spans (by start) replaced by ``mark``; spans that touch share one."""
    def cut(pieces: Column, begin: Column, end: Column) -> Column:
        """Code points ``begin`` to ``end`` of the text, from the pieces that hold them."""
        first, last = F.floor(begin / PIECE).cast("int"), F.floor((end - 1) / PIECE).cast("int")
        return F.when(end > begin, F.array_join(F.transform(F.sequence(first, F.greatest(last, first)), lambda k: F.substring(
            pieces[k], F.greatest(begin - k * PIECE, F.lit(0)) + 1,
            F.least(end - k * PIECE, F.lit(PIECE)) - F.greatest(begin - k * PIECE, F.lit(0)))), "")).otherwise("")

    def put(x: Column) -> Column:
        s, at, pieces = x["s"], x["at"], x["pieces"]
        parts = F.transform(s, lambda p, i: F.when((p["start"] > at[i]) | (i == 0), F.concat(
            cut(pieces, at[i], p["start"]), F.lit(mark))).otherwise(""))
        return F.concat(F.array_join(parts, ""), cut(pieces, F.element_at(at, -1), F.length(text)))

    ends = running(F.transform(found, lambda p: p["end"]), F.lit(0), "int", larger)
    pieces = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))
    return F.when(F.size(found) > 0, let(F.struct(found.alias("s"), ends.alias("at"), pieces.alias("pieces")), put)
                  ).otherwise(text)


def redacted_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret in ``text`` replaced and ``n_chars`` (if it
    is there) counted anew for the texts changed; other columns as they were."""
    cut = cutoffs(docs)
    text = F.col("text").cast("string")
    names = docs.columns
    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
                       let(spans(F.col("text"), cut), lambda s: F.struct(
                           (F.size(s) > 0).alias("any"), redacted(text, s).alias("text"))).alias("new"))

    def column(c: str) -> Column:
        if c == "text":
            return F.col("new.text").alias(c)
        old = F.col("row").getField(c)
        if c == "n_chars":
            return F.when(F.col("new.any"), F.length("new.text")).otherwise(old).cast(docs.schema[c].dataType).alias(c)
        return old.alias(c)

    return both.select(*[column(c) for c in names])
