"""Incremental ingest: AvailableNow stream equals the batch result; a later file
revises an earlier key; a file landed twice is read once."""

import os
import shutil

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tidemark.sources import sinks
from tidemark.sources.tables import SCHEMAS
from tidemark.streaming import ingest

FX_SCHEMA = "rate_date DATE, series_id STRING, value DOUBLE"


def test_stream_upsert_revisions_and_duplicates(spark, tmp_root):
    land = os.path.join(tmp_root, "landing")
    os.makedirs(land)
    first = spark.createDataFrame([("2024-01-01", "FXRUSD", 0.65), ("2024-01-02", "FXRUSD", 0.66)], "d STRING, s STRING, v DOUBLE")
    first = first.select(F.to_date("d").alias("rate_date"), F.col("s").alias("series_id"), F.col("v").alias("value"))
    first.coalesce(1).write.parquet(os.path.join(land, "b1"))
    root = os.path.join(tmp_root, "pub")
    stream = ingest.landing_stream(spark, os.path.join(land, "*"), FX_SCHEMA, max_files_per_trigger=1)
    handler = ingest.upsert_each_batch(root, "fx", ["rate_date", "series_id"], audit_source="rba")
    ckpt = os.path.join(tmp_root, "ckpt")
    ingest.run_available(stream, "fx_ingest", handler, checkpoint=ckpt)
    assert sinks.read_table(spark, root, "fx").count() == 2
    def land_and_run(name):
        again = ingest.landing_stream(spark, os.path.join(land, "*"), FX_SCHEMA, max_files_per_trigger=1)
        ingest.run_available(again, name, handler, checkpoint=ckpt)
        return {str(r.rate_date): r.value for r in sinks.read_table(spark, root, "fx").collect()}

    # a revision of 2024-01-02 lands later and wins
    first.where("rate_date = '2024-01-02'").withColumn("value", F.lit(0.70)).coalesce(1).write.parquet(os.path.join(land, "b2"))
    assert land_and_run("fx_ingest2") == {"2024-01-01": 0.65, "2024-01-02": 0.70}
    # the first file landed again under a new name is a new, later file: it restores 0.66
    shutil.copytree(os.path.join(land, "b1"), os.path.join(land, "b1_again"), copy_function=shutil.copyfile)
    assert land_and_run("fx_ingest3") == {"2024-01-01": 0.65, "2024-01-02": 0.66}
    from tidemark.operators.audit import fold_runs, read_audit

    runs = fold_runs(read_audit(spark, root))
    assert runs.where(F.col("status") != "completed").count() == 0
    assert runs.count() >= 3


def test_stream_daily_average_equals_batch(spark, tmp_root):
    land = os.path.join(tmp_root, "events")
    ev = spark.read.schema(SCHEMAS["events"]).parquet(f"{SF_SMALL}/events.parquet")
    ev.repartition(4).write.parquet(land)
    s = ingest.landing_stream(spark, land, SCHEMAS["events"])
    streamed = ingest.run_to_files(ingest.daily_averages(s, "ts", "event_type", "value"), "daily_avg_test", os.path.join(tmp_root, "daily"))
    batch = ev.withColumn("ts", F.col("ts").cast("timestamp")).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(
        F.avg("value").alias("avg_value"), F.count(F.lit(1)).alias("n"))
    newest = ev.agg(F.max(F.col("ts").cast("timestamp"))).first()[0]
    closed = batch.where(F.col("w.end") <= F.lit(newest) - F.expr("INTERVAL 1 DAY"))  # the watermark is a day behind
    a = sorted((str(r.window_start), r.event_type, round(r.avg_value, 9), r.n) for r in streamed.collect())
    b = sorted((str(r.w.start), r.event_type, round(r.avg_value, 9), r.n) for r in closed.collect())
    assert a == b and 0 < len(a) < batch.count()


def test_registered_daily_averages_hold_every_day(spark):
    import __spark_entry__ as E

    ev = spark.read.schema(SCHEMAS["events"]).parquet(f"{SF_SMALL}/events.parquet")
    batch = ev.groupBy(F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day"), "event_type").agg(
        F.round(F.avg("value"), 6).alias("avg_value"), F.count(F.lit(1)).alias("n"))
    got = E.queries()["st4_daily_event_averages"](spark, SF_SMALL).collect()
    assert sorted((str(r.window_start), r.event_type, r.avg_value, r.n) for r in got) == \
        sorted((str(r.day), r.event_type, r.avg_value, r.n) for r in batch.collect())


def test_stream_later_batch_replaces_open_windows(spark, tmp_root):
    land, schema = os.path.join(tmp_root, "open"), "ts TIMESTAMP, k STRING, v DOUBLE"

    def land_and_run(rows):
        df = spark.createDataFrame(rows, "ts STRING, k STRING, v DOUBLE").withColumn("ts", F.to_timestamp("ts"))
        df.coalesce(1).write.mode("append").parquet(land)
        daily = ingest.daily_averages(ingest.landing_stream(spark, land, schema), "ts", "k", "v")
        out = ingest.run_to_table(daily, "open_test", tmp_root, "daily", ["window_start", "k"], os.path.join(tmp_root, "ck"))
        return sorted((str(r.window_start)[:10], r.avg_value, r.n) for r in out.collect())

    assert land_and_run([("2024-01-01 01:00:00", "a", 1.0), ("2024-01-02 01:00:00", "a", 2.0)]) == [
        ("2024-01-01", 1.0, 1), ("2024-01-02", 2.0, 1)]
    assert land_and_run([("2024-01-02 05:00:00", "a", 4.0), ("2024-01-03 00:00:00", "a", 5.0)]) == [
        ("2024-01-01", 1.0, 1), ("2024-01-02", 3.0, 2), ("2024-01-03", 5.0, 1)]


def test_stream_dedupe_within_horizon(spark, tmp_root):
    land = os.path.join(tmp_root, "dups")
    rows = [("2024-01-01 00:00:00", "k1", 1.0), ("2024-01-01 00:05:00", "k1", 2.0), ("2024-01-01 00:00:00", "k2", 3.0)]
    df = spark.createDataFrame(rows, "ts STRING, k STRING, v DOUBLE").select(
        F.to_timestamp("ts").alias("ts"), "k", "v")
    df.coalesce(1).write.parquet(land)
    s = ingest.landing_stream(spark, land, "ts TIMESTAMP, k STRING, v DOUBLE")
    out = ingest.run_to_files(ingest.dedupe_within_horizon(s, "ts", "1 hour", ["k"]), "dedupe_test", os.path.join(tmp_root, "deduped"))
    assert sorted(r.k for r in out.collect()) == ["k1", "k2"]
