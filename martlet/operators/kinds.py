"""Record-kind split and union by name."""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame, functions as F


def split_by_kind(df: DataFrame, kinds: Iterable[str],
                  col: str = "record_type") -> dict[str, DataFrame]:
    """One filtered frame per kind. The equality reaches the Parquet scan
    as a pushed filter; each branch is planned (and pruned) separately."""
    return {k: df.filter(F.col(col) == F.lit(k)) for k in kinds}


def union_kinds(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name; a column missing on one side is NULL there.
    Empty frames are harmless, so there is no emptiness test (A7)."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_kinds needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
