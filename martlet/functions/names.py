"""Column-name normalisation (P1, P17, T23). Runs on the driver over the
schema only; the data are renamed in one ``toDF`` projection."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import DataFrame


def normalize_name(name: str, strip_accents: bool = False) -> str:
    """lower-case, every char outside [a-z0-9] -> '_', squeeze '_', strip '_'.

    By default an accented letter becomes '_' like any other symbol; with
    ``strip_accents`` it is folded to its base letter first (Día -> dia).
    """
    s = name
    if strip_accents:
        s = "".join(ch for ch in unicodedata.normalize("NFKD", s)
                    if not unicodedata.combining(ch))
    # the runs of [a-z0-9] joined by single underscores: every other
    # character separates, and none is left at either end
    return "_".join(re.findall(r"[a-z0-9]+", s.lower()))


def normalize_column_names(df: DataFrame, strip_accents: bool = False) -> DataFrame:
    """Rename every column; raises if two names collapse into one."""
    new = [normalize_name(c, strip_accents) for c in df.columns]
    seen: dict[str, str] = {}
    for old, n in zip(df.columns, new):
        if n in seen:
            raise ValueError(
                f"columns {seen[n]!r} and {old!r} both normalise to {n!r}")
        seen[n] = old
    if new == df.columns:
        return df
    return df.toDF(*new)
