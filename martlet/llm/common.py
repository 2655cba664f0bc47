"""Helpers shared by the corpus operators."""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import martlet
from martlet.session import scratch_path

_SHIPPED: set[str] = set()

#: ASCII white space, as the word definition of the operators has it
WHITE = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder; every executor sees it."""
    return f"{scratch_path(spark, 'llm')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, so
    that a lost executor costs a re-read and not a re-computation."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_uri(path: str) -> str:
    """``file:/x`` and ``/x`` in the form that pyarrow's file systems take."""
    return re.sub(r"^file:/+", "file:///", path)


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers of all executors, once per
    application: what a task calls is imported there, wherever the driver found
    it. The archive lies in the shared folder."""
    from pyarrow import fs

    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top, data = Path(martlet.__file__).parent, io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    folder = shared_folder(spark, "package")
    where, name = fs.FileSystem.from_uri(local_uri(folder))
    where.create_dir(name, recursive=True)
    with where.open_output_stream(f"{name}/martlet.zip") as out:
        out.write(data.getvalue())
    sc.addPyFile(f"{folder}/martlet.zip")
    _SHIPPED.add(sc.applicationId)


def arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInArrow`` with a function that may use this package."""
    ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def words(text: Column) -> Column:
    """Words of a whole text: runs of anything but ASCII white space; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def collected(df: DataFrame, bound: int, what: str) -> list:
    """Rows of a table whose size is bounded by its meaning; over ``bound`` it raises."""
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what}: more than {bound} rows")
    return rows


def small(df: DataFrame, most: int = 1_000_000, entries: str | None = None) -> DataFrame:
    """``df`` marked for broadcast if it has at most ``most`` rows, or entries in
    all rows of its array column ``entries``; else as it is, for a shuffled join.
    For stored tables, whose count costs little."""
    n = df.agg(F.sum(F.size(entries))).first()[0] or 0 if entries else df.limit(most + 1).count()
    return F.broadcast(df) if n <= most else df
