"""Title lookup against a catalogue and parent->child enrichment.

The lookup is exact on a normalised title first. Titles without an exact hit
are matched by edit distance *without* comparing every pair: each string is
expanded to its deletion neighbourhood (all strings reachable by deleting up
to ``max_distance`` characters) and the two sides are equi-joined on those
variants. Two strings within Levenshtein distance d always share such a
variant, so the candidate set is complete for distance <= d and contains no
pair that is farther apart than 2d; ``levenshtein`` then verifies it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from martlet.functions.text import _c
from martlet.operators.dedup import keep_first, top_k_per_key
from martlet.operators.signatures import end_candidates
from martlet.session import checkpoint_dir


def normalise_title(c) -> Column:
    """lower-case, any whitespace run -> one space, trimmed."""
    return F.lower(F.trim(F.regexp_replace(_c(c), r"\s+", " ")))


def _delete_one(s: Column) -> Column:
    n = F.length(s)
    return F.when(n > 0, F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)),
    )).otherwise(F.array().cast("array<string>"))


def deletion_variants(c, max_distance: int) -> Column:
    """The string itself plus every string left after deleting 1..d chars."""
    s = _c(c)
    levels = [F.array(s)]
    frontier = F.array(s)
    for _ in range(max_distance):
        frontier = F.array_distinct(F.flatten(F.transform(frontier, _delete_one)))
        levels.append(frontier)
    return F.array_distinct(F.concat(*levels))


def _segment(length: Column, i, d: int) -> tuple[Column, Column]:
    """0-based start and length of segment i (int or Column) when a string
    of ``length`` chars is cut into d+1 near-equal segments (longer ones last)."""
    n = F.lit(d + 1)
    i = F.lit(i) if isinstance(i, int) else i
    base = F.floor(length / n).cast("int")
    short = n - length % n                         # segments of length ``base``
    seg_len = F.when(i < short, base).otherwise(base + 1)
    start = i * base + F.greatest(F.lit(0), i - short)
    return start, seg_len


def segment_keys(c, max_distance: int) -> Column:
    """Index side of the segment filter: (len, i, segment) for i = 0..d."""
    s, d = _c(c), max_distance
    n = F.length(s)

    def key(i: Column) -> Column:
        st, ln = _segment(n, i, d)
        return F.struct(n.alias("l"), i.alias("i"), F.substr(s, st + 1, ln).alias("seg"))

    return F.transform(F.sequence(F.lit(0), F.lit(d)), key)


def segment_probes(c, max_distance: int) -> Column:
    """Probe side of the segment filter. For every catalogue length l within
    d of the title's and every segment i of an l-long name, the title's
    substrings where that segment can sit if the two strings are within
    edit distance d. A segment i (0-based) has at most i edits before it
    and d - i after it, so its start moves by at most i and ends up within
    d - i of the length difference: the shifts are the intersection of
    [-i, i] and [dlen - (d - i), dlen + (d - i)], dlen = title length - l
    (position-aware selection, Li et al., VLDB 2011). At most 19 probes per
    title for d = 2. Written with higher-order functions, so the expression
    stays small."""
    s, d = _c(c), max_distance
    n = F.length(s)

    def per_length(dl: Column) -> Column:
        ln_ = n + dl
        dlen = -dl

        def per_segment(i: Column) -> Column:
            st, sl = _segment(ln_, i, d)
            lo = F.greatest(-i, dlen - (F.lit(d) - i))
            hi = F.least(i, dlen + (F.lit(d) - i))
            shifts = F.when(lo <= hi, F.sequence(lo, hi)).otherwise(
                F.array().cast("array<int>"))

            def probe(delta: Column) -> Column:
                start = st + delta
                ok = (ln_ >= 0) & (start >= 0) & (start + sl <= n)
                return F.when(ok, F.struct(ln_.alias("l"), i.alias("i"),
                                           F.substr(s, start + 1, sl).alias("seg")))

            return F.transform(shifts, probe)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(d)), per_segment))

    grid = F.flatten(F.transform(F.sequence(F.lit(-d), F.lit(d)), per_length))
    return F.array_distinct(F.filter(grid, lambda x: x.isNotNull()))


def segment_candidates(titles: DataFrame, catalogue: DataFrame, max_distance: int,
                       block: int = 1000) -> DataFrame:
    """Pairs (title, _k, _ck, match_id, match_name) among which all pairs within
    ``max_distance`` are: those that share a segment. A pair comes once for each
    segment, or variant of the rest, that it shares.

    Catalogue blocks (names with one segment in one place) are counted first.
    A title meets at most ``block`` names in a block of that size or less. The titles
    and names of larger ones, where names share a prefix, say, meet by their ends
    less some characters instead (:func:`end_candidates`), which finds all pairs by itself: rows a
    title that don't grow with its length. So the result stays complete."""
    names = catalogue.select("_ck", "match_id", "match_name", F.explode(
        segment_keys("_ck", max_distance)).alias("_s")).select("_ck", "match_id", "match_name", "_s.*")
    probes = titles.select("title", "_k", F.explode(
        segment_probes("_k", max_distance)).alias("_s")).select("title", "_k", "_s.*")
    key, out = ["l", "i", "seg"], ["title", "_k", "_ck", "match_id", "match_name"]
    large = (names.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
             .filter(F.col("_n") > block).select(*key)).checkpoint(eager=True)
    if large.isEmpty():
        return probes.join(names.hint("merge"), key).select(*out)
    found = probes.join(large, key, "left_anti").join(names.join(large, key, "left_anti").hint("merge"), key).select(*out)
    t = (probes.join(large, key, "left_semi").select("title", "_k").distinct()
         .withColumn("tid", F.xxhash64("_k"))).checkpoint(eager=True)
    c = (names.join(large, key, "left_semi").select("_ck", "match_id", "match_name").distinct()
         .withColumn("nid", F.xxhash64("_ck"))).checkpoint(eager=True)
    # a number that two strings share adds pairs, and loses none
    pairs = end_candidates(t.select("tid", F.col("_k").alias("s")).distinct(),
                           c.select("nid", F.col("_ck").alias("s")).distinct(), max_distance, block)
    return found.unionByName(pairs.join(t, "tid").join(c, "nid").select(*out))


def first_match_lookup(titles: DataFrame, catalogue: DataFrame,
                       title_col: str = "title", name_col: str = "name",
                       id_col: str = "id", max_distance: int = 2,
                       materialize: bool = True,
                       blocking: str = "segments", block: int = 1000) -> DataFrame:
    """Best catalogue entry for every distinct title.

    Rank: exact normalised match, then smallest edit distance (<= d), then
    smallest id. Titles with no entry within ``max_distance`` are absent
    (see :func:`unmatched_titles`). Output: title, match_id, match_name,
    distance.

    The distinct titles and the de-duplicated catalogue are each used by the
    exact join, the anti join and the candidate join. With ``materialize``
    they are computed once and written with ``checkpoint()`` to the shared
    checkpoint folder, instead of being rescanned and reshuffled per use.

    ``blocking`` picks how fuzzy candidates are found; both are exact for
    distance <= d. ``"segments"`` joins the d+1 segments of each catalogue
    name with a bounded number of probes per title (at most 19 for d = 2,
    whatever the length) and, where names share segments, their ends less some characters;
    see :func:`segment_candidates`. ``"deletions"``
    joins deletion variants: very few false candidates, but the rows per
    string grow with the d-th power of its length, so it suits short names.
    Both exploded sides are joined by sort and merge, with skew splitting: the
    planner sizes an exploded side as if it weren't, and would broadcast it.
    """
    t = (titles.select(F.col(title_col).alias("title"))
         .filter(F.col("title").isNotNull()).distinct()
         .withColumn("_k", normalise_title("title")))
    cat = catalogue.select(F.col(id_col).alias("match_id"),
                           F.col(name_col).alias("match_name"),
                           normalise_title(name_col).alias("_ck"))
    # one entry per normalised name: the smallest id (partial aggregation
    # map-side, so a name repeated a billion times is one row per task)
    best = keep_first(cat.filter(F.col("_ck").isNotNull()), ["_ck"], ["match_id"])
    if materialize:
        checkpoint_dir(titles.sparkSession)
        t, best = t.checkpoint(eager=True), best.checkpoint(eager=True)

    exact = (t.join(best, t["_k"] == best["_ck"], "inner")
             .select("title", "match_id", "match_name",
                     F.lit(0).alias("distance")))
    if max_distance <= 0:
        return exact
    rest = t.join(best, t["_k"] == best["_ck"], "left_anti")
    if blocking == "deletions":
        tv = rest.select("title", "_k",
                         F.explode(deletion_variants("_k", max_distance)).alias("_v"))
        cv = best.select("_ck", "match_id", "match_name",
                         F.explode(deletion_variants("_ck", max_distance)).alias("_v"))
        cand = tv.join(cv.hint("merge"), "_v")
    elif blocking == "segments":
        checkpoint_dir(titles.sparkSession)
        cand = segment_candidates(rest, best, max_distance, block)
    else:
        raise ValueError(f"unknown blocking {blocking!r}")
    cand = (cand.withColumn("distance", F.levenshtein("_k", "_ck", max_distance))
            .filter((F.col("distance") >= 0) & (F.col("distance") <= max_distance)))
    fuzzy = keep_first(cand, ["title"], ["distance", "match_id"]).select(
        "title", "match_id", "match_name", "distance")
    return exact.unionByName(fuzzy)


def unmatched_titles(titles: DataFrame, matches: DataFrame,
                     title_col: str = "title") -> DataFrame:
    """Titles that found no catalogue entry."""
    t = titles.select(F.col(title_col).alias("title")).filter(
        F.col("title").isNotNull()).distinct()
    return t.join(matches.select("title"), "title", "left_anti")


def enrich_children(parents: DataFrame, children: DataFrame, key: str,
                    name_col: str | None = None,
                    per_key_limit: int | None = None,
                    order=None) -> DataFrame:
    """Children of known parents only, with the parent's name as fallback
    for a missing child name, optionally capped per parent (J2, S5, S3).

    The join is an inner equi-join: the planner broadcasts the parent side
    only when its measured size is under the broadcast threshold.
    """
    p = parents.select(key, *([F.col(name_col).alias("_pname")] if name_col else []))
    c = children.join(p, key, "inner")
    if name_col:
        if name_col in children.columns:
            c = c.withColumn(name_col, F.coalesce(F.col(name_col), F.col("_pname")))
        else:
            c = c.withColumn(name_col, F.col("_pname"))
        c = c.drop("_pname")
    if per_key_limit is not None:
        c = top_k_per_key(c, [key], order or [key], per_key_limit)
    return c
