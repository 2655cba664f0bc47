"""Deterministic dedup and per-key limits.

Both ``keep_first`` and ``top_k_per_key`` are a ``row_number()`` filter.
Catalyst plans that as a *partial* WindowGroupLimit before the shuffle and a
final one after it, so a key that holds a third of all rows is cut to k rows
inside every map task: no task ever receives the whole hot group.
"""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

OrderSpec = Sequence[str | Column | tuple[str, str]]


def sort_spec(order: OrderSpec) -> list[Column]:
    """Normalise ``["ts", ("price", "desc"), F.col("x").asc()]`` to sort
    columns. Ascending puts NULLs first and descending puts them last, the
    default of both Spark and ANSI SQL; pass a Column to choose otherwise."""
    out: list[Column] = []
    for o in order:
        if isinstance(o, Column):
            out.append(o)
        elif isinstance(o, tuple):
            name, direction = o
            d = direction.lower()
            if d in ("asc", "asc_nulls_first"):
                out.append(F.col(name).asc_nulls_first())
            elif d in ("desc", "desc_nulls_last"):
                out.append(F.col(name).desc_nulls_last())
            elif d == "asc_nulls_last":
                out.append(F.col(name).asc_nulls_last())
            elif d == "desc_nulls_first":
                out.append(F.col(name).desc_nulls_first())
            else:
                raise ValueError(f"bad direction {direction!r}")
        else:
            out.append(F.col(o).asc_nulls_first())
    return out


def top_k_per_key(df: DataFrame, keys: Iterable[str], order: OrderSpec, k: int,
                  rank_col: str | None = None) -> DataFrame:
    """At most ``k`` rows per key, first by ``order``.

    ``order`` should end with a unique column so the choice is deterministic.
    A ``k`` over ``spark.sql.optimizer.windowGroupLimitThreshold``, which Spark doesn't
    cut before the shuffle, goes through :func:`large_top_k_per_key`.
    """
    keys = list(keys)
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if k > limit:
        return large_top_k_per_key(df, keys, order, k, rank_col=rank_col)
    w = Window.partitionBy(*keys).orderBy(*sort_spec(order))
    rn = rank_col or "_rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def large_top_k_per_key(df: DataFrame, keys: Iterable[str], order: OrderSpec, k: int, parts: int = 64,
                        rank_col: str | None = None) -> DataFrame:
    """At most ``k`` rows per key for a large ``k``, in two stages.

    The rows of a key are dealt into ``parts`` sub-keys by the input partition that they
    come from, so equal rows are dealt apart, too, and each sub-key keeps its first k; the
    survivors, at most parts * k a key, are ranked once more. So a key with a third of
    all rows is sorted in ``parts`` tasks and then in one of a bounded size. The rows are
    the same for any dealing.
    """
    keys = list(keys)
    by = sort_spec(order)
    # which input partition a row is in must be taken before the first shuffle
    dealt = df.withColumn("_part", F.spark_partition_id() % parts)
    first = dealt.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys, "_part").orderBy(*by))).filter(
        F.col("_rn") <= k).drop("_part", "_rn")
    rn = rank_col or "_rn"
    out = first.withColumn(rn, F.row_number().over(Window.partitionBy(*keys).orderBy(*by))).filter(F.col(rn) <= k)
    return out if rank_col else out.drop(rn)


def keep_first(df: DataFrame, keys: Iterable[str], order: OrderSpec) -> DataFrame:
    """One row per key: the first by ``order``.

    Replaces ``dropDuplicates(keys)``, which keeps an arbitrary row. Filters
    that must not see dropped duplicates belong *before* this call (T1).
    A NULL key is one key, as in ``dropDuplicates``.
    """
    return top_k_per_key(df, keys, order, 1)


def distinct_values(df: DataFrame, col: str, limit: int | None = None,
                    ascending: bool = True) -> DataFrame:
    """Distinct values of one column, ordered; optional first-n.

    The distinct is a partial+final hash aggregate; with a limit Spark plans
    TakeOrderedAndProject (each task keeps n rows), not a global sort.
    """
    d = df.select(col).distinct()
    c = F.col(col).asc_nulls_first() if ascending else F.col(col).desc_nulls_last()
    d = d.orderBy(c)
    return d.limit(limit) if limit is not None else d
