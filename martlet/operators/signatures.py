"""Candidate pairs of similar strings without comparing all pairs.

``end_candidates`` finds all pairs within an edit distance by what is left of one end of a
string when characters are deleted from it, and leaves to ``gram_candidates`` the names whose
ends are common.
``gram_candidates`` finds all pairs within an edit distance by their rarest
q-grams, a bounded number of rows per string whatever its length (pivotal prefix
filter, Deng, Li and Feng, SIGMOD 2014). ``similar_titles`` finds pairs that share most
of the weight of their words (prefix and length filters of set similarity joins).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, functions as F

from martlet.operators.dedup import keep_first, top_k_per_key
from martlet.session import scratch_path

#: gram lengths; q takes strings of q * (d + 1) code points or more
GRAMS = (4, 8)

#: characters of an end of a name
ENDS = (8, 16)


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _broadcast_if(df: DataFrame, most: int) -> DataFrame:
    """A stored table marked for broadcast if it has at most ``most`` rows."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


# ------------------------------------------------------------- edit distance
def _lengths(length: Column, d: int) -> Column:
    """Gram lengths that a string of a length can use; 0 alone if it is too short for any."""
    some = F.filter(F.array(*[F.lit(q) for q in GRAMS]), lambda q: length >= q * (d + 1))
    return F.when(F.size(some) > 0, some).otherwise(F.array(F.lit(0)))


def _rarest_grams(strings: DataFrame, d: int, block: int) -> DataFrame:
    """The q * d + 1 first gram occurrences of every (id, side, q) by rarity: id, side, q and g, an
    array of (n, h, pos) in that order: the gram's strings if they are over ``block``, else 0; its
    hash, which stands for it; its place. ``strings``: id, side, s and the array ``tiers``."""
    grams = (strings.select("id", "side", "s", F.explode("tiers").alias("q")).filter("q > 0")
             .select("id", "side", "q", F.posexplode(F.transform(
                 F.sequence(F.lit(1), F.length("s") - F.col("q") + 1),
                 lambda i: F.xxhash64(F.substr("s", i, F.col("q"))))).alias("pos", "h")))
    # only how the common ones compare needs counts; others are alike, and ordered by hash
    common = _stored(grams.groupBy("q", "h").agg(F.count("*").alias("n")).filter(F.col("n") > block), "common-grams")
    # a string's grams come from one task, so what is shuffled is one array of each
    return (grams.join(_broadcast_if(common, 200_000), ["q", "h"], "left")
            .groupBy("id", "side", "q")
            .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "pos"))).alias("g"))
            .withColumn("g", F.slice("g", F.lit(1), F.col("q") * d + 1)))


def gram_candidates(titles: DataFrame, names: DataFrame, d: int, block: int = 1000) -> DataFrame:
    """Pairs (tid, nid) among which are all pairs of ``titles`` (tid, s) and ``names``
    (nid, s) within ``d`` edits, each pair once.

    Grams have one order for all strings, rare ones first. The prefix of a string is its first q * d + 1
    gram occurrences, and of those d + 1 that don't overlap are its pivots. Edits
    leave one pivot whole, so of two strings within d edits the one whose prefix ends
    first has a pivot in the other's prefix. Per string that is one row for each gram of its prefix
    and one per pivot. A name takes the longest grams of which its prefix holds no common one (in over
    ``block`` strings), else the shortest; a title has rows for every gram length. So strings
    that differ in a short part only meet by that part. Names too short for any share
    a deletion variant instead.
    """
    from martlet.operators.lookup import deletion_variants

    n = F.length("s")
    t = titles.select(F.col("tid").alias("id"), F.lit(0).alias("side"), "s",
                      F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(-d), F.lit(d)),
                                                              lambda k: _lengths(n + k, d)))).alias("tiers"))
    c = names.select(F.col("nid").alias("id"), F.lit(1).alias("side"), "s", _lengths(n, d).alias("tiers"))
    both = _stored(t.unionByName(c), "strings")
    prefix = _rarest_grams(both, d, block)
    by_place = F.array_sort(F.transform("g", lambda x: F.struct(x["pos"].alias("pos"), x["h"].alias("h"))))
    none = F.struct(F.lit(-1000).alias("last"), F.array().cast("array<bigint>").alias("pivots"))
    pivots = F.aggregate(by_place, none, lambda s, x: F.when(
        (x["pos"] >= s["last"] + F.col("q")) & (F.size(s["pivots"]) <= d),
        F.struct(x["pos"].alias("last"), F.concat(s["pivots"], F.array(x["h"])).alias("pivots"))).otherwise(s),
        lambda s: s["pivots"])
    end = F.element_at("g", -1)
    # a prefix that isn't full holds all grams: it never ends before another
    prefix = _stored(prefix.select(
        "side", "id", "q", (end["n"] > 0).alias("common"), F.array_distinct(F.transform("g", lambda x: x["h"])).alias("prefix"),
        F.array_distinct(pivots).alias("pivots"),
        F.when(F.size("g") >= F.col("q") * d + 1, F.struct(end["n"].alias("n"), end["h"].alias("h"))).alias("last")), "prefixes")
    own = (prefix.filter("side = 1").groupBy("id", "side")
           .agg(F.coalesce(F.max(F.when(~F.col("common"), F.col("q"))), F.min("q")).alias("q")))
    prefix = prefix.filter("side = 0").unionByName(prefix.join(own, ["id", "side", "q"], "left_semi"))

    def rows(side: int, what: str, id_: str, end: str) -> DataFrame:
        return prefix.filter(F.col("side") == side).select(
            F.col("id").alias(id_), "q", F.explode(what).alias("h"), F.col("last").alias(end))

    key = ["q", "h"]
    short_t = both.filter("side = 0 and array_contains(tiers, 0)").select(
        F.col("id").alias("tid"), F.explode(deletion_variants("s", d)).alias("v"))
    short_n = both.filter("side = 1 and array_contains(tiers, 0)").select(
        F.col("id").alias("nid"), F.explode(deletion_variants("s", d)).alias("v"))
    found = (rows(1, "pivots", "nid", "n_end").join(rows(0, "prefix", "tid", "t_end").hint("merge"), key)
             .filter("t_end is null or n_end <= t_end")
             .select("tid", "nid")
             .unionByName(rows(0, "pivots", "tid", "t_end").join(rows(1, "prefix", "nid", "n_end").hint("merge"), key)
                          .filter("t_end is not null and t_end <= n_end").select("tid", "nid"))
             .unionByName(short_t.join(short_n.hint("merge"), "v").select("tid", "nid")))
    return found.distinct()


def _deleted(s: Column, k: int) -> Column:
    """Hashes of what is left of ``s`` when exactly k characters are deleted."""
    from martlet.operators.lookup import _delete_one

    left = F.array(s)
    for _ in range(k):
        left = F.array_distinct(F.flatten(F.transform(left, _delete_one)))
    return F.transform(left, lambda v: F.xxhash64(v))


def _end_keys(s: Column, tier: int, cut: int, kept: list[tuple[int, int]]) -> Column:
    """Keys of a string by its last ``cut`` characters, for pairs (edits, deletions): with fewer than
    all d edits in the end what stands before it is free, else it is the same."""
    n = F.length(s)
    end, before = F.substr(s, n - cut + 1, F.lit(cut)), F.xxhash64(F.substr(s, F.lit(1), n - cut))
    parts = []
    for all_edits, k in kept:
        rest = before if all_edits else F.lit(0).cast("bigint")
        parts.append(F.transform(_deleted(end, k), lambda h: F.xxhash64(F.lit(tier), F.lit(all_edits), rest, h)))
    keys = F.flatten(F.array(*parts))
    return F.when(n >= cut, keys).otherwise(F.array().cast("array<bigint>"))


def end_candidates(titles: DataFrame, names: DataFrame, d: int, block: int = 1000) -> DataFrame:
    """Pairs (tid, nid) among which are all pairs of ``titles`` (tid, s) and ``names``
    (nid, s) within ``d`` edits (at least one), each pair once.

    A name is seen by its last w characters, or its first (the last of it reversed). A title within d edits
    has its own last w + c characters, c from -d to d, within e <= d edits of those. Strings of
    lengths w and w + c within e edits have a string in common after min(e, e - c) deletions
    in the one and c more in the other. If e is d, the rest of both is the same and is part of the key, so a key always
    holds all of a name but d characters, or its end but d - 1. A title's rows depend on w and d only.

    A name takes the first of four ends (last or first 8, 16 characters) whose outer w - 1 it shares
    with few others (``block`` // 20). Names without one, and short ones, are left to
    :func:`gram_candidates`. So pairs grow with the strings, not with their square, where names are told
    apart by either end.
    """
    few = max(1, block // 20)
    ends = [(back, w) for w in ENDS for back in (False, True)]
    own = _stored(names.select("nid", "s"), "names")
    sided = [F.reverse("s") if back else F.col("s") for back, _ in ends]
    n = F.length("s")
    tagged = own.select("nid", F.explode(F.array(*[F.struct(F.lit(i).alias("tier"), F.when(
        n >= w, F.xxhash64(F.lit(i), F.substr(x, n - w + 2, F.lit(w - 1)))).alias("h"))
        for i, (x, (_, w)) in enumerate(zip(sided, ends))])).alias("e")).select("nid", "e.*").filter("h is not null")
    common = _stored(tagged.groupBy("h").agg(F.count("*").alias("n")).filter(F.col("n") > few).select("h"), "common-ends")
    first = tagged.join(_broadcast_if(common, 200_000), "h", "left_anti").groupBy("nid").agg(F.min("tier").alias("tier"))
    dealt = _stored(own.join(first, "nid", "left"), "names-by-end")
    used = {r.tier: r["count"] for r in dealt.groupBy("tier").count().collect()}  # a row per end
    # titles too long or short for every name have no keys
    lengths = dealt.select(F.length("s").alias("n")).distinct()
    near = _stored(titles.select("tid", "s").withColumn("n", F.length("s")).join(F.broadcast(
        lengths.select(F.explode(F.sequence(F.col("n") - d, F.col("n") + d)).alias("n")).distinct()), "n", "left_semi")
        .select("tid", "s"), "titles")
    found = near.join(dealt, F.lit(False)).select("tid", "nid")
    for i, (back, w) in enumerate(ends):
        if i not in used:
            continue
        x = F.reverse("s") if back else F.col("s")
        name_keys = _end_keys(x, i, w, [(False, k) for k in range(d)] + [(True, k) for k in range(d + 1)])
        title_keys = F.flatten(F.array(*[_end_keys(x, i, w + c, [
            (last, e + min(c, 0)) for last, e in ((False, d - 1), (True, d)) if abs(c) <= e])
            for c in range(-d, d + 1)]))
        a = near.select("tid", F.explode(F.array_distinct(title_keys)).alias("key"))
        b = dealt.filter(F.col("tier") == i).select("nid", F.explode(F.array_distinct(name_keys)).alias("key"))
        found = found.unionByName(a.join(b.hint("merge"), "key").select("tid", "nid"))
    if None in used:
        found = found.unionByName(gram_candidates(near, dealt.filter("tier is null").select("nid", "s"), d, block))
    return found.distinct()


# ------------------------------------------------------------ shared words
def title_words(c: Column) -> Column:
    """Distinct words of a normalised title: runs of letters and digits."""
    return F.array_distinct(F.regexp_extract_all(c, F.lit(r"([\p{L}\p{N}]+)"), F.lit(1)))


def similar_titles(titles: DataFrame, catalogue: DataFrame, title_col: str = "title", name_col: str = "name",
                   id_col: str = "id", least: tuple[int, int] = (3, 5), block: int = 1000) -> DataFrame:
    """Best catalogue entry by shared words for every distinct title (J3, S8):
    title, match_id, match_name, similarity.

    A word weighs one more than the whole part of log2(strings / strings with it), strings being
    the distinct titles and names. Similarity is the weight of the words that both have over
    that of all words of both; pairs under ``least`` (a fraction) don't match. The best is
    the most similar, then the smallest id. A title without words has no match.

    Candidates share a word of both prefixes: a string's words, rarest first, up to the point where
    the rest weighs less than ``least`` of the whole. So a common word makes a candidate
    only where a string has no rarer ones. Names of one prefix word over ``block`` are split by hash
    and each of its titles asks every part, so no task holds a common word's names.
    """
    from martlet.operators.lookup import normalise_title

    num, den = least
    t = titles.select(F.col(title_col).alias("title")).filter("title is not null").distinct()
    c = keep_first(catalogue.select(F.col(id_col).alias("match_id"), F.col(name_col).alias("match_name"))
                   .filter("match_name is not null").withColumn("_k", normalise_title("match_name")), ["_k"], ["match_id"])
    strings = _stored(
        t.select(F.lit(0).alias("side"), F.xxhash64("title").alias("h"), F.col("title").alias("name"),
                 F.lit(None).cast(c.schema["match_id"].dataType).alias("match_id"), normalise_title("title").alias("k"))
        .unionByName(c.select(F.lit(1).alias("side"), F.xxhash64("match_name").alias("h"), F.col("match_name").alias("name"),
                              "match_id", F.col("_k").alias("k")))
        .withColumn("w", title_words(F.col("k"))).filter(F.size("w") > 0).drop("k"), "titles")
    count = strings.count()
    words = strings.select("side", "h", "name", "match_id", F.explode("w").alias("word"))
    df = words.groupBy("word").agg(F.count("*").alias("df"))
    weight = F.length(F.bin(F.floor(F.lit(count) / F.col("df")).cast("bigint"))).cast("bigint")
    weighed = words.join(df, "word")
    sets = _stored(weighed.groupBy("side", "h", "name", "match_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("df").alias("df"), "word", weight.alias("w")))).alias("words"))
        .withColumn("total", F.aggregate("words", F.lit(0).cast("bigint"), lambda s, x: s + x["w"])), "word-sets")
    # the prefix: words before which the weight so far leaves enough for a match
    begin = F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<string>").alias("prefix"))
    prefix = F.aggregate("words", begin, lambda s, x: F.struct(
        (s["sum"] + x["w"]).alias("sum"),
        F.when((F.col("total") - s["sum"]) * den >= F.col("total") * num, F.concat(s["prefix"], F.array(x["word"])))
        .otherwise(s["prefix"]).alias("prefix")), lambda s: s["prefix"])
    keyed = sets.select("side", "h", "name", "match_id", "words", "total", F.explode(prefix).alias("word"))
    common = _stored(keyed.filter("side = 1").groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") > block)
                     .select("word", F.ceil(F.col("n") / block).cast("int").alias("parts")), "common-words")
    parts = F.coalesce("parts", F.lit(1))
    dealt = keyed.join(_broadcast_if(common, 1_000_000), "word", "left").withColumn("part", F.explode(
        F.when(F.col("side") == 1, F.array(F.pmod("h", parts).cast("int"))).otherwise(F.sequence(F.lit(0), parts - 1))))
    a = dealt.filter("side = 0").select("word", "part", F.col("name").alias("title"), F.col("words").alias("a"),
                                        F.col("total").alias("ta"))
    b = dealt.filter("side = 1").select("word", "part", "match_id", F.col("name").alias("match_name"),
                                        F.col("words").alias("b"), F.col("total").alias("tb"))
    shared = F.aggregate(F.array_intersect("a", "b"), F.lit(0).cast("bigint"), lambda s, x: s + x["w"])
    found = (a.join(b.hint("merge"), ["word", "part"])
             .filter((F.col("ta") * num <= F.col("tb") * den) & (F.col("tb") * num <= F.col("ta") * den))
             .withColumn("shared", shared).withColumn("all", F.col("ta") + F.col("tb") - F.col("shared"))
             .filter(F.col("shared") * den >= F.col("all") * num)
             .select("title", "match_id", "match_name", (F.col("shared") / F.col("all")).alias("similarity")))
    return keep_first(found, ["title"], [("similarity", "desc"), "match_id"])
