"""Load audit: an append-only event log folded into one state per run.

A run appends a ``running`` event when it starts and a ``completed`` or
``failed`` event when it ends (L01).  Readers fold the events per ``run_id``
(the latest event wins), then answer freshness (A18/L03) and failure (T03)
questions.  Writes are appends of one-row frames; nothing is updated in place.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schema import AUDIT_STATUSES

AUDIT_SCHEMA = (
    "run_id STRING, source STRING, table_name STRING, status STRING, event_at TIMESTAMP_NTZ, "
    "started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, rows_inserted BIGINT, rows_updated BIGINT, "
    "rows_unchanged BIGINT, error_message STRING"
)
ERROR_TEXT_LIMIT = 2000


def fold_runs(events: DataFrame) -> DataFrame:
    """One row per run, the state of its latest event (ties: terminal
    statuses after 'running')."""
    rank = F.when(F.col("status") == "running", F.lit(0)).otherwise(F.lit(1))
    cols = [c for c in events.columns if c != "run_id"]
    packed = F.struct(*[F.col(c) for c in cols])
    agg = events.groupBy("run_id").agg(
        F.max_by(packed, F.struct(F.col("event_at"), rank)).alias("__r"),
        F.min("started_at").alias("__start"),
    )
    out = agg.select("run_id", *[F.col("__r")[c].alias(c) for c in cols], "__start")
    return out.withColumn("started_at", F.coalesce(F.col("started_at"), F.col("__start"))).drop("__start")


def last_completed(runs: DataFrame) -> DataFrame:
    """Latest completion time per (source, table)."""
    return (
        runs.where(F.col("status") == "completed")
        .groupBy("source", "table_name")
        .agg(F.max("completed_at").alias("last_completed"))
        .orderBy("source", "table_name")
    )


def recent_failures(runs: DataFrame, limit: int = 10) -> DataFrame:
    """Newest failures first (ties by run id), at most ``limit`` rows."""
    f = runs.where(F.col("status") == "failed").select("run_id", "source", "table_name", "started_at", "error_message")
    return f.orderBy(F.col("started_at").desc(), F.col("run_id")).limit(limit)


def freshness(runs: DataFrame) -> DataFrame:
    """Latest completion overall and the number of tables tracked."""
    done = runs.where(F.col("status") == "completed")
    return done.agg(
        F.max("completed_at").alias("latest_completed"),
        F.countDistinct("source", "table_name").alias("tables_tracked"),
    )


def invalid_statuses(events: DataFrame) -> DataFrame:
    """Events whose status is outside the allowed set."""
    return events.where(~F.col("status").isin(*AUDIT_STATUSES) | F.col("status").isNull())


@dataclass
class AuditRun:
    """L01 writer: appends start and end events to ``{root}/etl_audit_log``.

    Use as a context manager; an exception inside marks the run failed (the
    message is cut to 2000 characters) and is re-raised.
    """

    spark: SparkSession
    root: str
    source: str
    table_name: str
    run_id: str = field(default_factory=lambda: uuid.uuid4().hex)
    rows_inserted: int = 0
    rows_updated: int = 0
    rows_unchanged: int = 0

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/etl_audit_log"

    def _event(self, status: str, error: str | None = None, completed: bool = False) -> None:
        import datetime as dt

        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        row = (
            self.run_id, self.source, self.table_name, status, now,
            now if status == "running" else None, now if completed else None,
            self.rows_inserted, self.rows_updated, self.rows_unchanged,
            (error or None) and error[:ERROR_TEXT_LIMIT],
        )
        self.spark.createDataFrame([row], AUDIT_SCHEMA).write.mode("append").parquet(self.path)

    def __enter__(self) -> "AuditRun":
        self._started = time.time()
        self._event("running")
        return self

    def record(self, inserted: int = 0, updated: int = 0, unchanged: int = 0) -> None:
        self.rows_inserted += inserted
        self.rows_updated += updated
        self.rows_unchanged += unchanged

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc is None:
            self._event("completed", completed=True)
        else:
            self._event("failed", error=f"{exc_type.__name__}: {exc}", completed=False)
        return False


def read_audit(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(AUDIT_SCHEMA).parquet(f"{root.rstrip('/')}/etl_audit_log")
