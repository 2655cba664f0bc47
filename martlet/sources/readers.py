"""Scans of landed files. Every reader takes an explicit schema so that an
empty landing or an all-null field still yields a typed frame."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from martlet.sources.listing import before_the_end


def read_parquet(spark: SparkSession, path: str,
                 columns: list[str] | None = None) -> DataFrame:
    """Parquet scan (S1). Selecting ``columns`` here makes the pruning
    explicit; filters applied later still reach the scan."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_table(spark: SparkSession, sf_dir: str, name: str,
               columns: list[str] | None = None) -> DataFrame:
    """One of the driver tables ``{sf_dir}/{name}.parquet``."""
    return read_parquet(spark, os.path.join(sf_dir, f"{name}.parquet"), columns)


def read_json(spark: SparkSession, path: str, schema: StructType,
              multi_line: bool = False) -> DataFrame:
    """Landed JSON with a fixed schema; absent keys come back NULL.
    Malformed records keep their columns NULL (PERMISSIVE)."""
    return (spark.read.schema(schema)
            .option("multiLine", multi_line)
            .option("mode", "PERMISSIVE")
            .json(path))


def read_pages(spark: SparkSession, path: str, item_schema: StructType,
               limit: int | None = None,
               page_pattern: str = r"(\d+)[^/]*$",
               multi_line: bool = True, page_col: str | None = None) -> DataFrame:
    """Paged API responses landed one page per file.

    Each file holds ``{"data": [...], "pagination": {"cursor": ...}}`` (one
    object per file, or one per line with ``multi_line=False``). Items keep
    page order (page number, then position in the page) and stop, as the collector
    did, at the first page without items or the first number missing behind the
    smallest; ``limit`` keeps the first n items overall. Pages that name cursors
    instead of numbers are read by :func:`read_cursor_pages`. The page number is the field
    ``page_col`` of the page object, so that many pages can share a file, or
    else is parsed from the file path with ``page_pattern``; a path without a
    number raises.
    """
    page_schema = StructType(([StructField(page_col, LongType(), True)] if page_col else []) + [
        StructField("data", ArrayType(item_schema), True),
        StructField("pagination",
                    StructType([StructField("cursor", StringType(), True)]), True)])
    pages = (spark.read.schema(page_schema).option("multiLine", multi_line).json(path)
             .withColumn("_page", F.col(page_col) if page_col else F.coalesce(
                 F.regexp_extract(F.col("_metadata.file_path"), page_pattern, 1).try_cast("long"),
                 F.raise_error(F.concat(F.lit("no page number in "), F.col("_metadata.file_path"))))))
    pages = before_the_end(pages, [], "_page")
    items = (pages.select("_page", F.posexplode("data").alias("_pos", "_item"))
             .select("_page", "_pos", "_item.*"))
    if limit is not None:
        # the cap is the feature (first n of a ranked listing)
        items = items.orderBy("_page", "_pos").limit(limit)
    return items


def flatten_keyed_objects(df: DataFrame, json_col: str, value_ddl: str,
                          key_name: str = "key") -> DataFrame:
    """Object-of-objects JSON ``{id: {...}, ...}`` -> one row per id.

    ``value_ddl`` is the struct of the inner object, e.g.
    ``"name string, types array<string>"``. Runs per row on executors.
    """
    m = F.from_json(F.col(json_col), f"map<string,struct<{value_ddl}>>")
    keep = [c for c in df.columns if c != json_col]
    return (df.select(*keep, F.explode(m).alias(key_name, "_v"))
            .select(*keep, key_name, "_v.*"))


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """Typed empty dataset for a failed or empty source."""
    return spark.createDataFrame([], schema)


def conform_to_schema(df: DataFrame, schema: StructType,
                      defaults: dict[str, object] | None = None) -> DataFrame:
    """Project onto ``schema`` (S11, C5): existing columns are safely cast,
    absent ones become the default (or a typed NULL). A NULL that was
    supplied stays NULL; only *absent* columns take the default."""
    defaults = defaults or {}
    have = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in have:
            src = df[f.name]
            cols.append(src if df.schema[f.name].dataType == f.dataType
                        else src.try_cast(f.dataType).alias(f.name))
        elif f.name in defaults:
            d = defaults[f.name]
            v = d if isinstance(d, Column) else F.lit(d)
            cols.append(v.cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def stamp_batch_time(df: DataFrame, ts, col: str = "extraction_time") -> DataFrame:
    """One extraction time for the whole batch."""
    v = ts if isinstance(ts, Column) else F.lit(ts)
    return df.withColumn(col, v)


def point_read(df: DataFrame, key: str, value) -> DataFrame:
    """Equality lookup (S15); pushed down to the Parquet scan."""
    return df.filter(F.col(key) == F.lit(value))
