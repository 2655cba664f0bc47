"""Exact quantiles by refined histograms (A13): no task holds a group's values.

A pass counts each group's values per bucket of its range, some thousand rows a
group; the bucket with the wanted rank becomes the next pass's range, with the rank
counted inside it, until it holds one value. A pass is one aggregate with map-side
combine over the rows of all groups, so a group with all rows is as good as many.
"""

from __future__ import annotations

import math
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType


def exact_quantiles(df: DataFrame, group: str, value: str, p: float = 0.5, buckets: int = 1024,
                    most_groups: int = 100_000) -> dict:
    """Per value of ``group`` the smallest ``value`` with at least the share ``p`` of the group's
    values at or below it (SQL's percentile_disc). Nulls don't count; a group of nulls only
    gives None; NaN is above all numbers. Groups are few and named by the caller's columns:
    over ``most_groups`` it raises. A pass reads ``df`` once; whole numbers and decimals of range r take about
    log r / log ``buckets`` passes.
    """
    kind = df.schema[value].dataType
    floating = isinstance(kind, (DoubleType, FloatType))
    v = F.col("v")
    of = df.schema[group].dataType.simpleString()
    df = df.select(F.col(group).alias("g"), (F.col(value).cast("double") if floating else F.col(value)).alias("v"))
    rows = (df.groupBy("g").agg(F.count(v).alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi"))
            .limit(most_groups + 1).collect())
    if len(rows) > most_groups:
        raise ValueError(f"more than {most_groups} groups in {group!r}")
    out = {r.g: None for r in rows if not r.n}
    # group -> (smallest and largest value left, rank wanted among what is left)
    left = {r.g: (r.lo, r.hi, max(1, math.ceil(Decimal(str(p)) * r.n))) for r in rows if r.n}
    while True:
        for g in [g for g, (lo, hi, _) in left.items() if lo == hi or hi != hi and lo != lo]:
            out[g] = left.pop(g)[0]
        if not left:
            return out
        ranges = df.sparkSession.createDataFrame(
            [(g, lo, hi) for g, (lo, hi, _) in left.items()],
            f"of {of}, lo {_range_type(kind)}, hi {_range_type(kind)}")
        inside = (df.join(F.broadcast(ranges), F.col("g").eqNullSafe(F.col("of")))
                  .filter((v >= F.col("lo")) & (v <= F.col("hi"))))
        counts = (inside.groupBy("g", _bucket(v, floating, isinstance(kind, DecimalType), buckets).alias("b"))
                  .agg(F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).collect())
        by: dict = {}
        for r in counts:   # at most ``buckets`` + 1 a group
            by.setdefault(r.g, []).append((r.b, r.n, r.lo, r.hi))
        for g, found in by.items():
            rank = left[g][2]
            for _, n, lo, hi in sorted(found, key=lambda x: x[0]):
                if rank <= n:
                    left[g] = (lo, hi, rank)
                    break
                rank -= n


def _range_type(kind) -> str:
    return "double" if isinstance(kind, (DoubleType, FloatType)) else kind.simpleString()


def _bucket(v: Column, floating: bool, decimal: bool, buckets: int) -> Column:
    """The bucket of a value in its group's range: never falling, and the largest
    value's is another than the smallest's."""
    lo, hi = F.col("lo"), F.col("hi")
    if floating:
        wide = F.isnan(hi) | (hi - lo == float("inf")) | (lo == float("-inf"))
        # a range that has no finite width is halved around zero first
        return F.when(wide, F.when(F.isnan(v), 3).when(v == float("inf"), 2).when(v == float("-inf"), 0).when(
            v < 0, 0.5).otherwise(1)).otherwise(F.least(F.floor((v - lo) / (hi - lo) * buckets), F.lit(buckets))).cast("double")
    x, a, b = (v, lo, hi) if decimal else (c.cast("decimal(20,0)") for c in (v, lo, hi))
    return F.floor((x - a).cast("double") / (b - a).cast("double") * buckets).cast("double")


def with_exact_quantiles(groups: DataFrame, group: str, found: dict, out: str, kind) -> DataFrame:
    """``groups`` with the quantiles of :func:`exact_quantiles` as a column."""
    table = groups.sparkSession.createDataFrame(
        [(g, x) for g, x in found.items()],
        f"_g {groups.schema[group].dataType.simpleString()}, {out} {kind.simpleString()}")
    return groups.join(F.broadcast(table), F.col(group).eqNullSafe(F.col("_g")), "left").drop("_g")
