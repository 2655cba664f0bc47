"""ANSI-safe casts: a value that cannot be converted becomes NULL and can be
counted with :func:`is_rejected` instead of failing the job (T6, T10)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from martlet.functions.text import _c


def safe_cast(c, dtype: str) -> Column:
    return _c(c).try_cast(dtype)


def is_rejected(raw, parsed) -> Column:
    """True when an input value was present but did not convert."""
    return _c(raw).isNotNull() & _c(parsed).isNull()


def null_to_zero_int(c) -> Column:
    """NULL -> 0, otherwise integer cast; unparsable text -> NULL."""
    return F.when(_c(c).isNull(), F.lit(0)).otherwise(_c(c).try_cast("int"))


def positive_decimal(c, precision: int = 6, scale: int = 2) -> Column:
    """Non-positive or NULL -> NULL, otherwise decimal(p,s) rounded half-up;
    a value that does not fit the precision -> NULL (P10, T10)."""
    v = _c(c).try_cast("double")
    return F.when(v > 0, _c(c).try_cast(f"decimal({precision},{scale})"))


def to_bool(c) -> Column:
    """Boolean cast ('true'/'false'/'1'/'0', ...); other text -> NULL."""
    return _c(c).try_cast("boolean")


def iso_to_timestamp(c) -> Column:
    """ISO-8601 text (naive or with offset) -> timestamp in the session zone
    (P13). A column that is already a timestamp is returned unchanged by the
    callers that inspect the schema (P15)."""
    return F.try_to_timestamp(_c(c))


def utc_to_timestamp(c, pattern: str = "yyyy-MM-dd'T'HH:mm:ssX") -> Column:
    """Patterned text -> timestamp. The default pattern honours the trailing
    ``Z`` as UTC instead of treating it as a quoted literal (P14, T4)."""
    return F.try_to_timestamp(_c(c), F.lit(pattern))
