"""Benchmark decontamination by a positional inverted index.

The corpus's terms that occur in the test items are counted first. For each
window of an item the rarest terms are looked up: the index stores the postings
(term, doc_id, position) of those terms over all documents. The lists of the two
rarest terms, each shifted by the term's offset in the window, are intersected;
what is left is compared term by term with the document's words there.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import small, stored

#: runs of these characters divide words: ASCII but for letters and digits
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: candidate places sent to all tasks, and the length of their JSON in all (each carries
#: its window and the items that have it); with more of either, texts are shuffled to them
SENT, SENT_LENGTH = 400_000, 64 << 20

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """Words of a whole text, A-Z lower-cased and no other letter; null has none."""
    text = F.coalesce(text, F.lit(""))
    plain = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, UPPER, LOWER)).otherwise(F.lower(text))
    return F.array_remove(F.split(plain, GAP), "")


def windows(items: DataFrame, size: int) -> DataFrame:
    """Distinct windows of ``items`` (item_id, text): ``window`` (array of
    terms) and ``items``, the ids that have it. An item of fewer terms than
    ``size``, but not none, is one window."""
    w = F.col("w")
    starts = F.sequence(F.lit(1), F.greatest(F.size(w) - F.lit(size - 1), F.lit(1)))
    return (items.select("item_id", terms(F.col("text")).alias("w")).filter(F.size(w) > 0)
            .select("item_id", "w", F.explode(starts).alias("s"))
            .select("item_id", F.slice(w, F.col("s"), F.lit(size)).alias("window"))
            .groupBy("window").agg(F.collect_set("item_id").alias("items")))


def rarest(wins: DataFrame, docs: DataFrame, lists: int = 2) -> DataFrame:
    """The ``lists`` rarest distinct terms of every window: window, items,
    term, offset (of its first place) and rank (1: rarest). Windows with a term
    that no document has are left out."""
    spread = wins.select("window", "items", F.posexplode("window").alias("offset", "term"))
    vocabulary = stored(spread.select("term").distinct(), "test-terms")
    seen = (docs.select(F.explode(terms(F.col("text"))).alias("term"))
            .join(small(vocabulary), "term").groupBy("term").count())
    counts = stored(seen, "term-counts")
    first = spread.groupBy("window", "items", "term").agg(F.min("offset").alias("offset"))
    ranked = F.slice(F.array_sort(F.collect_list(F.struct("count", "term", "offset"))), 1, lists)
    return (first.join(small(counts), "term", "left")
            .groupBy("window", "items").agg(ranked.alias("r"), F.count("count").alias("known"),
                                            F.count("*").alias("all"))
            .filter("known = all")
            .select("window", "items", F.posexplode("r").alias("rank", "t"))
            .select("window", "items", F.col("t.term").alias("term"), F.col("t.offset").alias("offset"),
                    (F.col("rank") + 1).alias("rank")))


def postings(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The stored index: term, doc_id and position (from 0) of every occurrence
    of the ``wanted`` terms (term) in ``docs`` (doc_id, text)."""
    return stored(docs.select("doc_id", F.posexplode(terms(F.col("text"))).alias("position", "term"))
                  .join(small(wanted), "term").select("term", "doc_id", "position"), "postings")


def candidates(docs: DataFrame, wins: DataFrame, slack: int) -> DataFrame:
    """Places where the lists of a window's two rarest terms meet: doc_id,
    window, items and start. Lists meet if the starts that they imply are at
    most ``slack`` apart; that is an equality join on blocks of starts."""
    chosen = stored(rarest(wins, docs), "rarest")
    index = postings(docs, stored(chosen.select("term").distinct(), "rarest-terms"))
    named = chosen.withColumn("win", F.xxhash64("window"))
    at = index.join(small(named.select("win", "term", "offset", "rank")), "term").select(
        "doc_id", "win", "rank", (F.col("position") - F.col("offset")).alias("start"))
    block = F.floor(F.col("start") / (slack + 1))
    alone = named.groupBy("win").agg(F.max("rank").alias("ranks"))
    one = at.filter("rank = 1").select("doc_id", "win", "start", block.alias("block"))
    near = F.array(*[block + d for d in ((-1, 0, 1) if slack else (0,))])
    two = at.filter("rank = 2").select(F.col("doc_id").alias("d2"), F.col("win").alias("w2"),
                                       F.col("start").alias("s2"), F.explode(near).alias("b2"))
    single = alone.filter("ranks = 1").select("win")
    met = (one.join(two, (F.col("doc_id") == F.col("d2")) & (F.col("win") == F.col("w2"))
                    & (F.col("block") == F.col("b2")) & (F.abs(F.col("start") - F.col("s2")) <= slack))
           .select("doc_id", "win", "start")
           .unionByName(one.join(small(single), "win", "left_semi").select("doc_id", "win", "start")))
    what = named.filter("rank = 1").select("win", "window", "items")
    return met.distinct().join(small(what), "win").select("doc_id", "start", "window", "items")


def phrase_hits(docs: DataFrame, items: DataFrame, size: int = 13, slack: int = 0) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text), with the windows of ``items``
    (item_id, text) that occur in it: doc_id, n_words, ``exact`` (array of
    start, length and items of every exact occurrence) and ``near`` (the same of
    places where all terms of a window stand within ``slack`` words around it,
    but not as an exact phrase; empty without slack).

    Null texts have no words; items without words have no window; a null
    item_id names nobody, though its windows are found. Repeated rows of
    ``docs`` each get a row; rows of one doc_id with different texts are looked
    up by their own text. A row with a null doc_id is looked up, too. Empty
    tables give no rows, or no hits.
    """
    text, doc_id = F.col("text").cast("string"), F.col("doc_id").cast("long")
    key = F.struct(F.coalesce(doc_id, F.lit(0)).alias("id"), doc_id.isNull().alias("none"),
                   F.xxhash64(text).alias("text"))
    rows = docs.select(doc_id.alias("doc_id"), key.alias("key"), text.alias("text"))
    body = rows.select(F.col("key").alias("doc_id"), "text")
    wins = stored(windows(items, size), "windows")
    found = stored(candidates(body, wins, slack).groupBy("doc_id").agg(
        F.collect_set(F.struct("start", "window", "items")).alias("places")), "candidates")
    found = found.withColumnRenamed("doc_id", "key")
    length = found.agg(F.sum(F.length(F.to_json("places")).cast("long"))).first()[0] or 0
    all_words = (rows.join(small(found, SENT, "places") if length <= SENT_LENGTH else found, "key", "left")
                 .select("doc_id", terms(F.col("text")).alias("w"), F.coalesce("places", F.array()).alias("places")))
    w = F.col("w")

    def exact(p: Column) -> Column:
        return (p["start"] >= 0) & (F.slice(w, F.greatest(p["start"] + 1, F.lit(1)), F.size(p["window"])) == p["window"])

    def around(p: Column) -> Column:
        first = F.greatest(p["start"] + 1 - slack, F.lit(1))
        last = p["start"] + F.size(p["window"]) + slack
        return F.size(F.array_except(p["window"], F.slice(w, first, F.greatest(last - first + 1, F.lit(0))))) == 0

    def plain(p: Column) -> Column:
        return F.struct(p["start"].alias("start"), F.size(p["window"]).alias("length"), p["items"].alias("items"))

    none = F.filter(F.col("places"), lambda p: F.lit(False))
    near = F.filter(F.col("places"), lambda p: ~exact(p) & around(p)) if slack else none
    return all_words.select("doc_id", F.size(w).cast("long").alias("n_words"),
                            F.transform(F.filter(F.col("places"), exact), plain).alias("exact"),
                            F.transform(near, plain).alias("near"))


def covered(hits: Column) -> Column:
    """Words inside any of the (start, length) places, each counted once."""
    ordered = F.array_sort(F.transform(hits, lambda p: F.struct(
        p["start"].alias("a"), (p["start"] + p["length"]).alias("b"))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    return F.aggregate(ordered, zero, lambda acc, p: F.struct(
        (acc["n"] + F.greatest(p["b"] - F.greatest(p["a"], acc["end"]), F.lit(0))).alias("n"),
        F.greatest(p["b"], acc["end"]).alias("end")), lambda acc: acc["n"])


def named_items(hits: Column) -> Column:
    """Ids of the items hit, as strings in string order."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(
        hits, lambda p: F.transform(p["items"], lambda i: i.cast("string"))))))


def contamination(docs: DataFrame, items: DataFrame, size: int = 13, share: int = 20,
                  slack: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_hit (words inside an
    exact occurrence of a window), n_items and items_sha256 (the items that
    occur), n_near (items that come within ``slack`` words of occurring, without
    an exact window) and contaminated: hit, and at least one word in ``share``
    is. Edge cases as in ``phrase_hits``; a document without words is clean."""
    hits = phrase_hits(docs, items, size, slack).select(
        "doc_id", "n_words", covered(F.col("exact")).alias("n_hit"), named_items(F.col("exact")).alias("ids"),
        named_items(F.col("near")).alias("near_ids"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ","), 256).alias("items_sha256"),
        F.size(F.array_except("near_ids", "ids")).cast("long").alias("n_near"),
        ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"))
