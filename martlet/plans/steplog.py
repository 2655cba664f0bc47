"""Audit rows written step by step, with a write-ahead record.

Before a step works, its opening is appended to ``{log}_steps``; when it ends, well or
not, its rows are appended to ``{log}`` under the opening's step id. So a run that
dies leaves the rows of every finished step, and an opening without rows for the one
that it died in. The next run settles those: each becomes an ERROR row. A row carries
its step id, so settling twice, or after rows that did arrive, adds nothing.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martlet.operators.audit import audit_frame, with_duration_seconds
from martlet.sinks.writers import append_new_rows
from martlet.sources.schemas import AUDIT, S, TS, schema_of

OPENED = schema_of(("step_id", S), ("run_id", S), ("step", S), ("source", S), ("endpoint", S),
                   ("output_file", S), ("opened_at", TS))


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc)


class StepLog:
    """The audit log at ``path`` for one run. ``read`` reads a Parquet folder with a
    schema and gives no rows where there is none yet."""

    def __init__(self, spark: SparkSession, path: str, run_id: str, read: Callable[..., DataFrame]):
        self.spark, self.path, self.run_id, self._read = spark, path, run_id, read
        self.opened_path = path.rstrip("/") + "_steps"
        self.rows: list[dict] = []

    def open(self, step: str, source: str, endpoint: str, output_file: str | None = None) -> dict:
        """Record that a step begins; its row so far."""
        row = {"run_id": self.run_id, "step": step, "source": source.upper(), "endpoint": endpoint,
               "output_file": output_file, "load_start_time": _now(), "step_id": uuid.uuid4().hex}
        opened = [tuple(row[c] for c in OPENED.fieldNames()[:-1]) + (row["load_start_time"],)]
        self.spark.createDataFrame(opened, OPENED).coalesce(1).write.mode("append").parquet(self.opened_path)
        return row

    def close(self, row: dict, results: list[dict]) -> None:
        """Append a step's rows: each is ``row`` with a result over it."""
        done = [row | {"status": "SUCCESS"} | {"load_end_time": _now()} | r for r in results]
        audit_frame(self.spark, done).coalesce(1).write.mode("append").parquet(self.path)
        self.rows += done

    def run(self, step: str, source: str, endpoint: str, work: Callable[[], list[dict]],
            output_file: str | None = None) -> list[dict]:
        """``work()`` as a step; its results are its rows, or one row of no records if
        it has none. What it raises becomes an ERROR row and is raised again."""
        row = self.open(step, source, endpoint, output_file)
        try:
            results = work() or [{"records_count": 0}]
        except Exception as e:
            self.close(row, [{"records_count": 0, "status": "ERROR", "error_message": str(e)}])
            raise
        self.close(row, results)
        return self.rows[len(self.rows) - len(results):]

    def settle(self) -> None:
        """An ERROR row for every step, of any run, that was opened and has no row:
        its run died in it. For the start of a run, while no other is at work."""
        opened = self._read(self.spark, self.opened_path, OPENED)
        logged = self._read(self.spark, self.path, AUDIT)
        lost = append_new_rows(opened, logged, ["step_id"])
        if lost.isEmpty():
            return
        now = F.lit(_now())
        rows = lost.select(
            "run_id", "step", F.col("opened_at").alias("load_start_time"), now.alias("load_end_time"),
            F.lit(0).cast("bigint").alias("records_count"), F.lit(0).cast("bigint").alias("rejected_count"),
            "source", "endpoint", "output_file", F.lit("ERROR").alias("status"),
            F.lit("interrupted: the run ended inside this step").alias("error_message"), now.alias("created_at"), "step_id")
        # the frame's columns are those of every other row of the log
        full = audit_frame(self.spark, []).unionByName(rows, allowMissingColumns=True)
        with_duration_seconds(full).write.mode("append").parquet(self.path)

    def frame(self) -> DataFrame:
        """The rows that this run has written."""
        return audit_frame(self.spark, self.rows)
