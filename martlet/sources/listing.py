"""Listings landed page by page (S2): order by following cursors, and the end.

A collector asks for a page, gets its items and the cursor of the next page, and
stops at the first page without items. Landed, the pages lie in any order, some
twice (a retry) and some behind the end. The order is a linked list over
(cursor asked with, next cursor); ranking it one page at a time would take a job
per page, so pointers are doubled: k rounds of joins rank 2^k pages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from martlet.operators.dedup import keep_first, top_k_per_key
from martlet.session import scratch_path


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def rank_links(links: DataFrame, by: list[str], node: str = "node", nxt: str = "next",
               first: str = "") -> DataFrame:
    """Place of every node on the path from the node ``first`` of each key:
    ``by``, node, rank (0 for the first). ``links`` has one row per key and node;
    a null ``nxt``, or one without a row, ends the path.

    Nodes that the path doesn't reach are left out. A path that comes back to a
    node ends there: a node has the rank of its first visit. After k rounds all
    nodes less than 2^k steps away are ranked, each from its own stored table; it
    ends when a round ranks nothing new.
    """
    jump = _stored(links.select(*by, F.col(node).alias("node"), F.col(nxt).alias("next")), "jump")
    # a pointer to a node without a row is the end
    nodes = jump.select(*by, F.col("node").alias("next"))
    jump = _stored(jump.filter("next is not null").join(nodes, by + ["next"], "left_semi"), "jump")
    seen = _stored(nodes.filter(F.col("next") == first).select(*by, F.col("next").alias("node"),
                                                               F.lit(0).cast("bigint").alias("rank")), "ranks")
    step, ranked = 1, seen.count()
    while ranked:
        ahead = seen.join(jump, by + ["node"]).select(*by, F.col("next").alias("node"),
                                                      (F.col("rank") + step).alias("rank"))
        seen = _stored(seen.unionByName(ahead).groupBy(*by, "node").agg(F.min("rank").alias("rank")), "ranks")
        now = seen.count()
        if now == ranked:
            break
        ranked = now
        on = jump.select(*by, F.col("node").alias("next"), F.col("next").alias("after"))
        jump = _stored(jump.join(on, by + ["next"]).select(*by, "node", F.col("after").alias("next")), "jump")
        step *= 2
    return seen


def before_the_end(pages: DataFrame, by: list[str], rank: str, items: str = "data") -> DataFrame:
    """Pages before the first gap of each key: the first page without items, or
    the first rank that no page has, counted from the key's smallest rank. Both are
    found by an aggregate; no task walks the pages."""
    # one row per page, and not its items, is looked at from here on
    heads = _stored(pages.groupBy(*by, rank).agg(F.max(F.coalesce(F.size(items), F.lit(0))).alias("_items")), "heads")
    empty = heads.filter("_items <= 0").select(*by, F.col(rank).alias("_gap"))
    have = heads.select(*by, F.col(rank).alias("_gap"))
    missing = heads.select(*by, (F.col(rank) + 1).alias("_gap")).join(have, by + ["_gap"], "left_anti")
    gaps = empty.unionByName(missing)
    if by:
        end = gaps.groupBy(*by).agg(F.min("_gap").alias("_end"))
        return pages.join(end, by).filter(F.col(rank) < F.col("_end")).drop("_end")
    return pages.filter(F.col(rank) < gaps.agg(F.min("_gap")).scalar())


def read_cursor_pages(spark: SparkSession, path: str, item_schema: StructType, limit: int | None = None,
                      by: list[str] | None = None, asked: str = "after", multi_line: bool = True) -> DataFrame:
    """Items of landed pages in the order of their cursors, up to the listing's end.

    A page is ``{"after": ..., "data": [...], "pagination": {"cursor": ...}}``: the
    cursor it was asked with (absent, null or empty: the first page), its items, and the
    next page's cursor (absent, null or empty: no more). With ``by`` each key (columns of the
    page object, text) is a listing of its own, as of one game's streams.

    Pages may lie in any files and order. Of pages asked with one cursor (a retry)
    one is kept, one with items before one without, then by the hash of its content.
    Pages behind the end, and those no cursor leads to, are left out; ``limit`` keeps the
    first items of each listing. Returns ``by``, _page (from 0), _pos and the item's fields.
    """
    by = by or []
    schema = StructType([*[StructField(c, StringType(), True) for c in [*by, asked]],
                         StructField("data", ArrayType(item_schema), True),
                         StructField("pagination", StructType([StructField("cursor", StringType(), True)]), True)])
    raw = spark.read.schema(schema).option("multiLine", multi_line).json(path).select(
        *by, F.coalesce(asked, F.lit("")).alias("node"), F.expr("nullif(pagination.cursor, '')").alias("next"), "data")
    pages = _stored(keep_first(
        raw.withColumn("_empty", F.coalesce(F.size("data"), F.lit(0)) <= 0)
        .withColumn("_hash", F.md5(F.to_json(F.struct("data", "next")))),
        by + ["node"], ["_empty", "_hash"]).drop("_empty", "_hash"), "pages")
    ranks = rank_links(pages.select(*by, "node", "next"), by).withColumnRenamed("rank", "_page")
    listed = before_the_end(pages.join(ranks, by + ["node"]), by, "_page")
    items = listed.select(*by, "_page", F.posexplode("data").alias("_pos", "_item")).select(*by, "_page", "_pos", "_item.*")
    if limit is None:
        return items
    # the cap is the feature: a collector asks for so many
    if by:
        return top_k_per_key(items, by, ["_page", "_pos"], limit)
    return items.orderBy("_page", "_pos").limit(limit)
