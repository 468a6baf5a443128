"""Incremental ingest with Structured Streaming.

Releases arrive as files over time and may revise earlier periods.  The
operators here read a landing folder as a stream (each file once, tracked in
the checkpoint), and publish every micro-batch with a keyed upsert, so a late
revision replaces the earlier value by key.  ``Trigger.AvailableNow`` runs the
backlog in bounded micro-batches and stops: the same code serves a scheduled
batch job and a continuous one.

Checkpoints live in the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), so a restarted driver resumes where it stopped and
a lost executor only re-runs its tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.session import checkpoint_dir


def landing_stream(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
    **options: str,
) -> DataFrame:
    """ST1: a folder of landed files as a stream with a declared schema."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    for k, v in options.items():
        r = r.option(k, v)
    return r.load(path)


def _checkpoint(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}"


def run_available(
    df: DataFrame, name: str, handler: Callable[[DataFrame, int], None], checkpoint: str | None = None
) -> StreamingQuery:
    """Run the backlog through ``handler(batch_df, batch_id)`` and stop (AvailableNow)."""
    spark = df.sparkSession
    q = (
        df.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint or _checkpoint(spark, name))
        .foreachBatch(handler)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return q


def upsert_each_batch(
    root: str, table: str, keys: Sequence[str], audit_source: str | None = None, mode: str = "update", by: str | None = None
) -> Callable[[DataFrame, int], None]:
    """ST2 + ST5: a ``foreachBatch`` handler that upserts the batch by key (the
    batch id is the load sequence, so a later file wins over an earlier one
    for the same key) and writes an audit event pair per micro-batch.  With ``by`` a
    batch rewrites the folders of its own values of that key column only.  The batch is kept
    while it is loaded, as a load reads it more than once and a stateful batch must
    not run again for that."""
    from tidemark.operators.audit import AuditRun
    from tidemark.sources.sinks import upsert

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seq = batch.withColumn("__load_seq", F.lit(batch_id).cast("long"))
        if "__row_seq" in batch.columns:
            seq = seq.withColumn("__load_seq", F.col("__load_seq") * F.lit(1 << 32) + F.col("__row_seq"))
            seq = seq.drop("__row_seq")
        seq = seq.persist()
        try:
            if audit_source:
                with AuditRun(spark, root, audit_source, table, run_id=f"{table}-batch-{batch_id}") as run:
                    res = upsert(spark, seq, root, table, keys, mode=mode, order_col="__load_seq", by=by)
                    run.record(res.inserted, res.updated, res.unchanged)
            else:
                upsert(spark, seq, root, table, keys, mode=mode, order_col="__load_seq", by=by)
        finally:
            seq.unpersist()

    return handle


def _as_event_time(df: DataFrame, event_time: str) -> DataFrame:
    """Watermarks need TIMESTAMP; landed TIMESTAMP_NTZ is read as UTC wall time
    (the session time zone is UTC)."""
    from pyspark.sql.types import TimestampNTZType

    if isinstance(df.schema[event_time].dataType, TimestampNTZType):
        return df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def dedupe_within_horizon(df: DataFrame, event_time: str, horizon: str, keys: Sequence[str]) -> DataFrame:
    """ST3: drop repeats of a key seen within ``horizon`` of event time; state for
    older keys is evicted by the watermark."""
    return _as_event_time(df, event_time).withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(list(keys))


def daily_averages(df: DataFrame, event_time: str, key: str, value: str, lateness: str = "1 day") -> DataFrame:
    """ST4: tumbling daily mean per series; late rows within ``lateness`` still
    count, older ones are dropped by the watermark."""
    w = F.window(event_time, "1 day")
    return (
        _as_event_time(df, event_time).withWatermark(event_time, lateness)
        .groupBy(w.alias("window"), F.col(key))
        .agg(F.avg(value).alias("avg_value"), F.count(F.lit(1)).alias("n"))
        .select(F.col("window.start").alias("window_start"), key, "avg_value", "n")
    )


def run_to_files(df: DataFrame, name: str, path: str, checkpoint: str | None = None) -> DataFrame:
    """Run the backlog of a stream into Parquet files in append mode and return them as a
    batch DataFrame.  A windowed result is written once its window is past the watermark, and
    its state goes then, so neither state nor driver grow with the stream."""
    q = (
        df.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint or _checkpoint(df.sparkSession, name))
        .trigger(availableNow=True)
        .start(path)
    )
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_to_table(df: DataFrame, name: str, root: str, table: str, keys: Sequence[str], checkpoint: str | None = None) -> DataFrame:
    """Run the backlog of a stream in update mode into a published table, by the keyed upsert of
    ST2, and return the table as a batch DataFrame.  Windows not yet past the watermark are in it
    as they stand; a later batch replaces them, and the state of closed ones goes."""
    from tidemark.sources.sinks import read_table

    q = (
        df.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint or _checkpoint(df.sparkSession, name))
        .foreachBatch(upsert_each_batch(root, table, keys))
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    out = read_table(df.sparkSession, root, table)
    return df.sparkSession.createDataFrame([], df.schema) if out is None else out
