"""Lineage columns, step audit rows and single-pass row counts
(P2, C6, K6, K7, K9, A6)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from martlet.sources.schemas import AUDIT


def with_audit_columns(df: DataFrame, source: str, endpoint: str,
                       run_id: str | None = None) -> DataFrame:
    """Five warehouse columns (P2). ``run_id`` is stored (T12); every
    column is typed, never void (T13)."""
    return df.withColumns({
        "dw_fecha_registro": F.current_timestamp(),
        "dw_id_carga": F.lit(run_id).cast("string"),
        "dw_deleted": F.lit(False),
        "dw_source": F.lit(source.upper()),
        "dw_endpoint": F.lit(endpoint),
    })


def duration_seconds(start, end) -> Column:
    """end - start in seconds as decimal(10,2)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return (F.timestamp_diff("MICROSECOND", s, e) / F.lit(1_000_000)).cast("decimal(10,2)")


def with_duration_seconds(df: DataFrame, start: str = "load_start_time",
                          end: str = "load_end_time",
                          out: str = "duration_seconds") -> DataFrame:
    return df.withColumn(out, duration_seconds(start, end))


def audit_frame(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Audit rows with the defaults of the log table (K6): counts 0, source
    UNKNOWN, status SUCCESS, times and created_at 'now'; plus derived
    duration_seconds."""
    now = _dt.datetime.now(_dt.timezone.utc)
    full = []
    for r in rows:
        full.append((
            r.get("run_id"), r.get("step"),
            r.get("load_start_time") or now, r.get("load_end_time") or now,
            int(r.get("records_count") or 0), int(r.get("rejected_count") or 0),
            r.get("source") or "UNKNOWN", r.get("endpoint"), r.get("output_file"),
            r.get("status") or "SUCCESS", r.get("error_message"), r.get("created_at") or now, r.get("step_id")))
    return with_duration_seconds(spark.createDataFrame(full, AUDIT))


def observe_count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter that is filled by whatever action runs next
    (A6): no extra job just to count."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs
