"""Run orchestration helpers: per-source isolation and summary (L02), the load
gate (G17) and a versioned result cache (L04).  These run on the driver and
only launch Spark jobs; no data passes through them."""

from __future__ import annotations

import time
import traceback
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SUMMARY_SCHEMA = "source STRING, status STRING, rows BIGINT, seconds DOUBLE, error STRING"


def run_sources(spark: SparkSession, runners: Mapping[str, Callable[[], int]]) -> DataFrame:
    """Run each source's loader in turn; a failure is recorded and the next
    source still runs.  Each runner returns the rows it loaded."""
    rows = []
    for name, fn in runners.items():
        t0 = time.time()
        try:
            n = int(fn())
            rows.append((name, "ok" if n > 0 else "empty", n, time.time() - t0, None))
        except Exception as e:  # noqa: BLE001 - isolation is the point
            rows.append((name, "failed", 0, time.time() - t0, f"{type(e).__name__}: {e}"[:2000]))
            traceback.print_exc()
    return spark.createDataFrame(rows, SUMMARY_SCHEMA)


def load_gate(dry_run_summary: DataFrame) -> DataFrame:
    """A load may start only if every source parsed in the dry run, none
    failed and none returned zero rows; one row (passed, blocking sources)."""
    bad = dry_run_summary.where((F.col("status") != "ok") | (F.col("rows") <= 0))
    return bad.agg(
        (F.count(F.lit(1)) == 0).alias("passed"),
        F.sort_array(F.collect_list("source")).alias("blocking_sources"),
    )


@dataclass
class ResultCache:
    """Frames persisted per (query, table version) with a time-to-live; a
    new table version or an expired entry recomputes, ``clear`` unpersists
    everything (the refresh button)."""

    ttl_seconds: float = 900.0
    _entries: dict = field(default_factory=dict)

    def get(self, key: str, version: str, build: Callable[[], DataFrame]) -> DataFrame:
        now = time.time()
        hit = self._entries.get(key)
        if hit and hit[0] == version and now - hit[1] < self.ttl_seconds:
            return hit[2]
        if hit:
            hit[2].unpersist()
        df = build().persist()
        self._entries[key] = (version, now, df)
        return df

    def clear(self) -> None:
        for _, _, df in self._entries.values():
            df.unpersist()
        self._entries.clear()
