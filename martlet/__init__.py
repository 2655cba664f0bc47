"""martlet: a PySpark library for batch landing, cleaning, quality checks,
idempotent publishing and KPI marts, written with DataFrame/SQL builtins only.

Sub-packages
------------
sources    landed JSON / Parquet readers, explicit raw schemas (S1-S16)
functions  column-level cleaning expressions and name rules (P1-P25)
operators  DataFrame -> DataFrame operators: dedup, top-k, lookup, quality,
           constraints, KPI marts, audit (D1-D2, W1-W2, J1-J5, A1-A15, C1-C7)
sinks      Parquet / CSV / JDBC writers, routing, lineage stamping (K1-K9)
plans      declarative source specs, SQL views and table functions, pipeline
           phases (P26-P30, F2-F4, G1-G4)
streaming  incremental landing of new files with exactly-once append
"""

from martlet.session import get_spark, checkpoint_dir  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
