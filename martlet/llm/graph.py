"""Connected components over an edge table, by alternating large and small stars
(Kiveris et al., 2014). No step gathers a node's neighbours in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v), u > v. Every neighbour moves to the least node it can see."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    seen = both.join(least, "u")
    if large:
        moved = seen.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = (seen.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))))
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Component of every node of ``edges`` (a, b: any ordered type): node and
    component, its least node. Loops, repeated and reversed edges are fine;
    edges with a null end are left out; an empty table gives no rows.

    Each round is stored in the shared folder. It ends when a round changes
    nothing: every node then points at its component's least node.
    """
    e = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
               .distinct(), "edges")

    def state(x: DataFrame):
        return x.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    was = state(e)
    while was[0]:
        e = stored(_star(_star(e, True), False), "edges")
        now = state(e)
        if now == was:
            break
        was = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
