"""Blank / null handling for string columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c, trim: bool = False) -> Column:
    """'' (or, with ``trim``, a value of only spaces) becomes NULL.

    ``F.lit('')`` is required: a bare '' is read as a column name.
    """
    col = F.trim(_c(c)) if trim else _c(c)
    return F.nullif(col, F.lit(""))


def is_present(c) -> Column:
    """Predicate: not null and not blank after trimming spaces."""
    return blank_to_null(c, trim=True).isNotNull()


def trimmed(c) -> Column:
    """Strip leading/trailing spaces (P5). Tabs and newlines are kept."""
    return F.trim(_c(c))


def default_if_blank(c, default: str = "unknown") -> Column:
    """NULL or '' becomes ``default``."""
    return F.coalesce(blank_to_null(c), F.lit(default))
