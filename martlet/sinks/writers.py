"""Sinks. Every write is a single Spark job over the partitioned data;
nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, NullType, StructType


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Parquet write (K1). Partitioning by run id lets "latest run" reads
    prune whole directories."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def complex_as_text(df: DataFrame, how: str = "cast") -> DataFrame:
    """Map/array/struct columns to text: Spark's own form (``cast``) as the
    export writes it, or ``json``."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (MapType, ArrayType, StructType)):
            c = (F.to_json(c) if how == "json" else c.cast("string")).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def export_csv(df: DataFrame, path: str, single_file: bool = False,
               mode: str = "overwrite", complex_how: str = "cast") -> None:
    """CSV export with header (K2, G4). ``single_file`` funnels the data
    through one task and is meant for small extracts only."""
    out = complex_as_text(df, complex_how)
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).option("header", "true").csv(path)


def drop_void_columns(df: DataFrame) -> DataFrame:
    """Drop NullType columns, which JDBC cannot store."""
    void = [f.name for f in df.schema.fields if isinstance(f.dataType, NullType)]
    return df.drop(*void) if void else df


def restamp_lineage(df: DataFrame, source: str, endpoint: str,
                    run_id: str | None = None) -> DataFrame:
    """Overwrite lineage columns at load time, same rule for all sources (K5)."""
    cols = {"dw_source": F.lit(source.upper()), "dw_endpoint": F.lit(endpoint)}
    if run_id is not None:
        cols["dw_id_carga"] = F.lit(run_id).cast("string")
    return df.withColumns(cols)


def select_target_columns(df: DataFrame, target_columns: list[str]) -> DataFrame:
    """Keep only the target table's columns (T25): a mixed union must not
    send one kind's columns to another kind's table."""
    return df.select(*[c for c in target_columns if c in df.columns])


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               driver: str | None = None, batchsize: int = 10_000,
               num_partitions: int | None = None,
               properties: dict | None = None) -> None:
    """JDBC append (K3). ``num_partitions`` caps concurrent connections
    (Spark coalesces to it); ``batchsize`` sets rows per INSERT batch."""
    out = drop_void_columns(df)
    w = (out.write.format("jdbc").mode(mode).option("url", url)
         .option("dbtable", table).option("batchsize", str(batchsize)))
    if driver:
        w = w.option("driver", driver)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()


def append_new_rows(df: DataFrame, existing: DataFrame | None,
                    keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose key is not already in ``existing`` (C7): with
    UNIQUE(key, run) this makes a re-run an idempotent no-op. Only the key
    columns of the target are read; duplicates inside ``df`` are kept for
    the caller's dedup rule to decide. A NULL key equals a stored NULL key, so
    a re-run does not store such a row again."""
    if existing is None:
        return df
    stored = existing.select(*[F.col(k).alias(f"_stored_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [df[k].eqNullSafe(stored[f"_stored_{k}"]) for k in keys])
    return df.join(stored, same, "left_anti")


def constraint_breaks(not_null: Iterable[str] = (), max_length: dict[str, int] | None = None) -> Column:
    """Names of the columns of a row that break NOT NULL or VARCHAR(n)
    as an array; empty for a row that may be stored."""
    bad = [F.when(F.col(c).isNull(), F.lit(c)) for c in not_null]
    bad += [F.when(F.char_length(c) > n, F.lit(c)) for c, n in (max_length or {}).items()]
    return F.array_distinct(F.array_compact(F.array(F.lit(None).cast("string"), *bad)))


def route_by_kind(df: DataFrame, routes: dict[str, tuple[str, list[str] | None]],
                  kind_col: str = "record_type",
                  strict: bool = True) -> dict[str, DataFrame]:
    """Split a cleaned frame into per-target frames (K8): ``routes`` maps a
    kind to (target name, target columns). Unknown kinds are an error when
    ``strict``. Returns target -> frame; the caller writes each."""
    out = {}
    for kind, (target, cols) in routes.items():
        part = df.filter(F.col(kind_col) == F.lit(kind))
        out[target] = select_target_columns(part, cols) if cols else part
    if strict:
        known = list(routes)
        out["_unrouted"] = df.filter(~F.col(kind_col).isin(known) | F.col(kind_col).isNull())
    return out
