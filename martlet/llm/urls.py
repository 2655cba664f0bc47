"""URL filters: host and path rules, and link-graph propagation for the rest.

Trust starts at hosts with pages that a rule allows and follows links; distrust
starts at hosts with pages that a rule blocks and follows links backwards, as
who links to a blocked host is suspect. Both are personalised PageRanks over
host edges. A page that no rule fits is blocked if its host's distrust exceeds
its trust by a margin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import small, stored

#: share of the distrust by which it must exceed the margin
TIE = 1e-9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: target of an absolute or scheme-relative link
HREF = r"(?i)href\s*=\s*[\"']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#\"'\s<>]+)"


def _rest(url: Column) -> Column:
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def rule_table(spark: SparkSession, rules: list[tuple[str, str]]) -> DataFrame:
    """Rules as a table: verdict and rule (host and path, like ``net/``)."""
    return spark.createDataFrame(rules, "verdict string, rule string")


def suffixes(name: Column) -> Column:
    """A host and the domains above it."""
    labels = F.split(name, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)),
                       lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that fit each host (host) or a domain above it, longest last."""
    parts = rules.select("verdict", "rule", F.substring_index("rule", "/", 1).alias("domain"),
                         F.expr("substring(rule, instr(rule, '/'))").alias("start"))
    return (hosts.select("host", F.explode(suffixes(F.col("host"))).alias("domain"))
            .join(parts, "domain")
            .groupBy("host").agg(F.sort_array(F.collect_set(F.struct(
                F.length("rule").alias("size"), "rule", "verdict", "start"))).alias("rules")))


def ruled(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """Every row of ``pages`` (page_id, url): page_id, host, path, and rule and
    verdict of the longest rule that fits (null: none). A rule fits its host and
    all subdomains if the path starts with the rule's; of two rules with equal
    text, block wins."""
    split = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    by_host = stored(host_rules(split.select("host").distinct(), rules).withColumnRenamed("host", "named"), "host-rules")
    best = F.element_at(F.filter("rules", lambda r: F.startswith(F.col("path"), r["start"])), -1)
    fit = F.expr("size(filter(rules, r -> startswith(path, r.start))) > 0")
    return (split.join(small(by_host, 100_000), split["host"] == by_host["named"], "left")
            .select("page_id", "host", "path", F.when(fit, best).alias("best"))
            .select("page_id", "host", "path", "best.rule", "best.verdict"))


def link_edges(pages: DataFrame) -> DataFrame:
    """Host edges with weights: links in ``pages`` (url, html) from a page's
    host to the host of an absolute link, counted; and between a host and the
    domain just above it where both have pages, as many as the lower one has."""
    src = host(F.col("url"))
    links = (pages.select(src.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(HREF), F.lit(1))).alias("to"))
             .select("src", F.translate("to", UPPER, LOWER).alias("dst"))
             .filter("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("weight")))
    hosts = pages.select(src.alias("host")).filter("host <> ''").groupBy("host").agg(F.count("*").alias("weight"))
    above = hosts.select("host", F.expr("substring(host, instr(host, '.') + 1)").alias("up"), "weight").filter("up <> host")
    site = above.join(hosts.select(F.col("host").alias("up")), "up").select("host", "up", "weight")
    return (links.unionByName(site.select(F.col("host").alias("src"), F.col("up").alias("dst"), "weight"))
            .unionByName(site.select(F.col("up").alias("src"), F.col("host").alias("dst"), "weight"))
            .groupBy("src", "dst").agg(F.sum("weight").cast("double").alias("weight")))


def propagated(edges: DataFrame, seeds: DataFrame, damping: float = 0.85, rounds: int = 16,
               keep_every: int = 4) -> DataFrame:
    """Personalised PageRank of ``seeds`` (kind, host, mass) over ``edges``
    (kind, src, dst, weight), each kind by itself: kind, host, rank. Mass at a
    host without edges out stays with the seeds. ``rounds`` steps leave at most
    ``damping ** rounds`` of the mass unsettled; each few steps are stored."""
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("all"))
    arcs = stored(edges.join(out, ["kind", "src"]).select(
        "kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("all")).alias("share")), "arcs")
    total = seeds.groupBy("kind").agg(F.sum("mass").alias("total"))
    start = stored(seeds.join(total, "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("rank")), "seeds")
    rank = start
    for k in range(rounds):
        moved = rank.join(arcs, ["kind", "host"]).select("kind", F.col("dst").alias("host"),
                                                         (damping * F.col("rank") * F.col("share")).alias("rank"))
        lost = moved.groupBy("kind").agg((1 - F.sum("rank")).alias("back"))
        again = (start.join(lost, "kind", "left")
                 .select("kind", "host", (F.coalesce("back", F.lit(1.0)) * F.col("rank")).alias("rank")))
        rank = moved.unionByName(again).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        if k % keep_every == keep_every - 1 or k == rounds - 1:
            rank = stored(rank, "ranks")
    return rank


def filtered(pages: DataFrame, rules: DataFrame, margin: float = 2.0, damping: float = 0.85,
             rounds: int = 16) -> DataFrame:
    """One row per row of ``pages`` (page_id, url, html): page_id, host, path,
    rule (null: none fits), verdict (the rule's; else block where the host's
    distrust exceeds ``margin`` times its trust, allow elsewhere), and trust and
    distrust of the host (0 where none arrives), rounded to 9 decimals. The
    verdict is on the ranks as they are: it doesn't depend on how many hosts
    share the mass.

    A null url, or one without ``://``, has an empty host and path, fits no rule
    and is allowed. Null html has no links. Repeated rows are judged alike, and
    count as often as they are there. An empty table gives no rows; without
    rules every page is allowed.
    """
    judged = stored(ruled(pages, rules), "ruled")
    seeds = (judged.filter("verdict is not null")
             .select(F.when(F.col("verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host")
             .groupBy("kind", "host").agg(F.count("*").cast("double").alias("mass")))
    edges = link_edges(pages)
    both = (edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight")
            .unionByName(edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"),
                                      F.col("src").alias("dst"), "weight")))
    rank = propagated(both, seeds, damping, rounds)
    known = stored(rank.groupBy("host").agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank"))).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank"))).alias("distrust"))
        .select(F.col("host").alias("named"), F.coalesce("trust", F.lit(0.0)).alias("trust"),
                F.coalesce("distrust", F.lit(0.0)).alias("distrust")), "trust")
    # a tie but for the last digits of the sums is one in every order of adding
    shady = F.coalesce(F.col("distrust") * (1 - TIE) > margin * F.col("trust"), F.lit(False))
    return (judged.join(small(known), judged["host"] == known["named"], "left")
            .select("page_id", "host", "path", "rule",
                    F.coalesce("verdict", F.when(shady, "block").otherwise("allow")).alias("verdict"),
                    F.coalesce(F.round("trust", 9), F.lit(0.0)).alias("trust"),
                    F.coalesce(F.round("distrust", 9), F.lit(0.0)).alias("distrust")))
