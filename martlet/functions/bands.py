"""First-match range banding."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from martlet.functions.text import _c

# Duration band labels and bounds of the hours view, in the
# order they are tested (first match wins; BETWEEN bounds are inclusive).
# (label, low, high, kind) with kind "lt" (< high), "between" (low..high),
# "gt" (> low).
DURATION_BANDS = [
    ("Corto (< 10h)", None, 10, "lt"),
    ("Medio (10-25h)", 10, 25, "between"),
    ("Largo (25-50h)", 25, 50, "between"),
    ("Muy Largo (> 50h)", 50, None, "gt"),
]
DURATION_ELSE = "Sin datos"


def band(c, bands=DURATION_BANDS, otherwise: str | None = DURATION_ELSE) -> Column:
    """CASE WHEN chain in list order; NULL input falls to ``otherwise``."""
    x = _c(c)
    expr = None
    for label, lo, hi, kind in bands:
        if kind == "lt":
            cond = x < F.lit(hi)
        elif kind == "gt":
            cond = x > F.lit(lo)
        elif kind == "between":
            cond = x.between(F.lit(lo), F.lit(hi))
        else:
            raise ValueError(f"unknown band kind {kind!r}")
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise)) if otherwise is not None else expr
