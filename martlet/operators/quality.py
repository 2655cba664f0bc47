"""Data-quality report and table-constraint checks.

Every report reads its input once: where a key's uniqueness is asked for, the
column counts ride along in the keyed aggregate. No per-column jobs, and nothing
collected to the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType


def _q(c: str) -> Column:
    """Column by exact name (dots, spaces and backticks allowed)."""
    return F.col("`" + c.replace("`", "``") + "`")


def _missing(df: DataFrame, c: str) -> Column:
    """NULL, or '' for string columns only (T22: no '' test on non-strings)."""
    col = _q(c)
    if isinstance(df.schema[c].dataType, StringType):
        return col.isNull() | (col == F.lit(""))
    return col.isNull()


def _pct(part: Column, total: Column) -> Column:
    """Share in percent, 2 decimals, ties to even (as Python's ``round``);
    NULL for an empty table."""
    return F.when(total > 0, F.bround(F.lit(100.0) * part / total, 2))


def null_blank_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Long form (column_name, null_count, null_pct) of missing values."""
    cols = cols or df.columns
    agg = df.agg(F.count(F.lit(1)).alias("_total"),
                 *[F.count_if(_missing(df, c)).alias(c) for c in cols])
    long = agg.unpivot("_total", [_q(c) for c in cols], "column_name", "null_count")
    return long.select("column_name", "null_count",
                       _pct(F.col("null_count"), F.col("_total")).alias("null_pct"))


def duplicate_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """rows - distinct keys, one row (A9). A NULL key is one value, as in
    ``dropDuplicates``. Counted through a keyed partial aggregate."""
    g = df.groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint")
                 .alias("duplicate_count"))


def quality_report(df: DataFrame, source: str, keys: list[str] | None = None,
                   cols: list[str] | None = None) -> DataFrame:
    """One-row report (A10): source, total_records, duplicate_count,
    null_percentage map, columns_with_empty, validation_passed.

    ``keys`` names the primary key (T22); without it duplicate_count is NULL
    and does not take part in the verdict.
    """
    cols = cols or df.columns
    # one pass: missing values are summed per key (map-side first), then over
    # the keys; a key's surplus rows are its duplicates
    z = [F.count_if(_missing(df, c)).alias(f"_z{i}") for i, c in enumerate(cols)]
    if keys:
        per_key = df.groupBy(*[_q(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.count(F.lit(1)).alias("_n"), *z)
        r = per_key.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
                        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_count"),
                        *[F.coalesce(F.sum(f"_z{i}"), F.lit(0)).alias(f"_z{i}") for i in range(len(cols))])
    else:
        r = df.agg(F.count(F.lit(1)).alias("total_records"),
                   F.lit(None).cast("bigint").alias("duplicate_count"), *z)
    pcts = [_pct(F.col(f"_z{i}"), F.col("total_records")) for i in range(len(cols))]
    pairs = []
    for c, p in zip(cols, pcts):
        pairs += [F.lit(c), p]
    empty = F.filter(F.array(*[F.when(p > 0, F.lit(c)) for c, p in zip(cols, pcts)]),
                     lambda x: x.isNotNull())
    all_zero = reduce(lambda a, b: a & b,
                      [F.coalesce(p == 0, F.lit(True)) for p in pcts], F.lit(True))
    dup_ok = F.coalesce(F.col("duplicate_count") == 0, F.lit(keys is None))
    return r.select(
        F.lit(source).alias("source"),
        "total_records", "duplicate_count",
        F.create_map(*pairs).alias("null_percentage"),
        empty.alias("columns_with_empty"),
        (dup_ok & all_zero).alias("validation_passed"),
    )


def not_null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows breaking NOT NULL on any of ``cols``, with the broken names."""
    bad = F.filter(F.array(*[F.when(_q(c).isNull(), F.lit(c)) for c in cols]),
                   lambda x: x.isNotNull())
    return df.withColumn("violated", bad).filter(F.size("violated") > 0)


def unique_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once (C2). Rows with a NULL key part
    never conflict (SQL UNIQUE treats NULLs as distinct)."""
    nn = reduce(lambda a, b: a & b, [_q(k).isNotNull() for k in keys])
    return (df.filter(nn).groupBy(*[_q(k) for k in keys]).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def fk_violations(child: DataFrame, fk: list[str], parent: DataFrame,
                  pk: list[str]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent row.
    Only the key columns of the parent are read."""
    nn = reduce(lambda a, b: a & b, [_q(k).isNotNull() for k in fk])
    p = parent.select(*[_q(b).alias(a) for a, b in zip(fk, pk)])
    return child.filter(nn).join(p, fk, "left_anti")


def max_length_violations(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text longer than its VARCHAR(n) limit (C4)."""
    bad = F.filter(F.array(*[F.when(F.char_length(_q(c)) > n, F.lit(c))
                             for c, n in limits.items()]),
                   lambda x: x.isNotNull())
    return df.withColumn("violated", bad).filter(F.size("violated") > 0)


def constraint_summary(df: DataFrame, not_null: list[str] | None = None,
                       max_length: dict[str, int] | None = None,
                       unique: list[str] | None = None) -> DataFrame:
    """Long form (check_name, column_name, violations) of NOT NULL, length and
    uniqueness checks, in one pass over the input: with a unique key the other
    counts are summed per key first. Rows with a NULL key part never conflict."""
    not_null, max_length = not_null or [], max_length or {}
    labels = ([("not_null", c) for c in not_null] + [("max_length", c) for c in max_length]
              + ([("unique", ",".join(unique))] if unique else []))
    counts = ([F.count_if(_q(c).isNull()) for c in not_null]
              + [F.count_if(F.char_length(_q(c)) > n) for c, n in max_length.items()])
    counts = [c.alias(f"_v{i}") for i, c in enumerate(counts)]
    if unique:
        keys = [f"_k{i}" for i in range(len(unique))]
        per_key = df.groupBy(*[_q(c).alias(k) for c, k in zip(unique, keys)]).agg(
            F.count(F.lit(1)).alias("_n"), *counts)
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        one = per_key.agg(*[F.coalesce(F.sum(f"_v{i}"), F.lit(0)).alias(f"_v{i}") for i in range(len(counts))],
                          F.coalesce(F.sum(F.when(whole, F.col("_n") - 1)), F.lit(0)).alias(f"_v{len(counts)}"))
    else:
        one = df.agg(*counts)
    rows = [F.struct(F.lit(check).alias("check_name"), F.lit(c).alias("column_name"),
                     F.col(f"_v{i}").alias("violations")) for i, (check, c) in enumerate(labels)]
    return one.select(F.inline(F.array(*rows)))
