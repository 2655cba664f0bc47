"""One CSV file written by many tasks.

Spark writes the rows as parts without headers, in parallel, beside a part that is the
header. Their byte lengths give every part its place in the file, and each is then
copied there by a task of its own; where the file system can join files by
their names (HDFS), that is done instead and no byte is copied. No task and no driver
sees more than one part.
"""

from __future__ import annotations

import re
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.sinks.writers import complex_as_text

#: bytes that a copying task holds at a time
PIECE = 8 << 20


def part_files(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Data files of a folder in the order of their names, and their lengths."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(s.getPath().toString(), s.getLen()) for s in fs.listStatus(path)]
    named = [(re.match(r"part-(\d+)", p.rsplit("/", 1)[1]), p, n) for p, n in found if n]
    return [(p, n) for _, p, n in sorted((int(m[1]), p, n) for m, p, n in named if m)]


def _local(path: str) -> str | None:
    """The path as a mounted file system has it; None for other schemes."""
    u = urlparse(path)
    return unquote(u.path) if u.scheme in ("", "file") else None


def join_parts(spark: SparkSession, parts: list[tuple[str, int]], target: str) -> int:
    """Join files, in the order given, to one at ``target``, and return its length. On a mounted
    file system (shared by all executors) every task copies one part to its
    offset; a task that runs again writes the same bytes to the same place. On one that
    concatenates, the parts are moved together. Others raise."""
    total = sum(n for _, n in parts)
    out = _local(target)
    jvm, sc = spark.sparkContext._jvm, spark.sparkContext
    if out is None:
        path = jvm.org.apache.hadoop.fs.Path(target)
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        if not hasattr(fs, "concat") or fs.getScheme() not in ("hdfs", "webhdfs"):
            raise ValueError(f"{target}: this file system neither takes writes at an offset nor joins files; "
                             "keep the parts, or write to a mounted folder or HDFS")
        fs.create(path).close()
        if parts:
            sources = sc._gateway.new_array(jvm.org.apache.hadoop.fs.Path, len(parts))
            for i, (p, _) in enumerate(parts):
                sources[i] = jvm.org.apache.hadoop.fs.Path(p)
            fs.concat(path, sources)
        return total
    import os

    os.makedirs(os.path.dirname(out), exist_ok=True)
    with open(out, "wb") as f:
        f.truncate(total)
    rows, offset = [], 0
    for p, n in parts:
        rows.append((_local(p), offset, n))
        offset += n
    if not rows:
        return 0

    def copy(batches):
        import pandas as pd

        for batch in batches:
            for part, at, n in zip(batch["part"], batch["at"], batch["n"]):
                done = 0
                with open(part, "rb") as src, open(out, "r+b") as dst:
                    dst.seek(at)
                    while piece := src.read(PIECE):
                        dst.write(piece)
                        done += len(piece)
                if done != n:
                    raise OSError(f"{part}: {done} bytes, listed with {n}")
                yield pd.DataFrame({"n": [done]})

    table = spark.createDataFrame(rows, "part string, at long, n long").repartition(len(rows), "at")
    copied = table.mapInPandas(copy, "n long").agg(F.sum("n")).first()[0]
    if copied != total:
        raise OSError(f"{target}: {copied} bytes copied of {total}")
    return total


def export_csv_file(df: DataFrame, target: str, complex_how: str = "cast", work: str | None = None) -> int:
    """Export ``df`` as one CSV file with one header at ``target``, and return its length
    in bytes. Complex columns become text as in :func:`export_csv`. Rows keep the order of
    ``df``'s partitions. ``work`` is a folder for the parts, on ``target``'s file system; they
    are left there for the caller to remove with it. An empty table gives the header alone."""
    spark = df.sparkSession
    work = work or f"{target}.parts-{uuid.uuid4().hex}"
    out = complex_as_text(df, complex_how)
    names = spark.createDataFrame([tuple(out.columns)], ", ".join(f"c{i} string" for i in range(len(out.columns))))
    names.coalesce(1).write.option("header", "false").csv(f"{work}/0-header")
    out.write.option("header", "false").csv(f"{work}/1-rows")
    return join_parts(spark, part_files(spark, f"{work}/0-header") + part_files(spark, f"{work}/1-rows"), target)
