"""Registered queries over landed files and published tables.

Each lays a given table out in a source's own file format in the cluster's shared folder, or
publishes it, and reads it back with the library's reader, so that the whole way from
files to rows is compared with SQL over the given table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import quality as qa
from tidemark.operators import ranges
from tidemark.plans.registry import published_root, query
from tidemark.sources import manifest, readers, sinks
from tidemark.sources.scratch import Scratch
from tidemark.sources.tables import Tables
from tidemark.streaming import ingest

#: The priorities of orders, which head columns of landed files.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def land_lines(lines: DataFrame, path: str) -> str:
    """Text files of ``lines`` (file, seq, line), one for each file name, in the order of seq; a folder
    ``file=<name>`` each."""
    lines.repartition("file").sortWithinPartitions("file", "seq").select("file", "line").write.partitionBy("file").text(path)
    return path


def finished(t: Tables, df: DataFrame, scratch: Scratch) -> DataFrame:
    """``df`` written as the query's result, upon which its intermediate tables are removed."""
    path = f"{published_root(t)}/result"
    df.write.parquet(path)
    scratch.remove()
    return t.spark.read.schema(df.schema).parquet(path)


# ---------------------------------------------------------------------------
# Ranks and quantiles of a fact


@query("w01_price_rank_within_flag")
def q_w01_price(t: Tables) -> DataFrame:
    li = t.read("lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")
    scratch = Scratch(t.spark, "w01")
    ranked = ranges.percentile_rank_in_groups(li, "l_extendedprice", "price_pct", ["l_returnflag"], scratch)
    return finished(t, ranked.withColumn("price_pct", F.round("price_pct", 6)), scratch)


@query("a22_median_price_by_flag")
def q_a22_price(t: Tables) -> DataFrame:
    li = t.read("lineitem", "l_returnflag", "l_linestatus", "l_extendedprice")
    scratch = Scratch(t.spark, "a22")
    parts = ["l_returnflag", "l_linestatus"]
    median = ranges.exact_quantiles(li, "l_extendedprice", parts, scratch).withColumnRenamed("quantile", "median_price")
    p90 = ranges.exact_quantiles(li, "l_extendedprice", parts, scratch, share=0.9).select(*parts, F.col("quantile").alias("p90_price"))
    both = median.join(p90, parts).select(*parts, "n", F.round("median_price", 6).alias("median_price"), F.round("p90_price", 6).alias("p90_price"))
    return finished(t, both, scratch)


# ---------------------------------------------------------------------------
# Keyed upsert by period (K01, ST2), audit per batch (ST5)


def _yearly(t: Tables) -> DataFrame:
    o = t.read("orders", "o_orderdate", "o_orderpriority", "o_orderstatus")
    return o.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.col("o_orderpriority").alias("priority")) \
        .agg(F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "F").alias("filled"))


@query("k01_upsert_by_period")
def q_k01_period(t: Tables) -> DataFrame:
    """All years but 2000 first; then a batch of 1998 (filled orders only) and 2000.  Which years' folders were written
    again is told by the commits."""
    root, keys, rows = published_root(t), ["y", "m", "priority"], _yearly(t)
    sinks.upsert(t.spark, rows.where("y <> 2000").select(*keys, "orders"), root, "monthly_orders", keys, by="y")
    batch = rows.where("y IN (1998, 2000)").select(*keys, F.when(F.col("y") == 1998, F.col("filled")).otherwise(F.col("orders")).alias("orders"))
    first = set(sinks.live_tables(t.spark, root)["monthly_orders"])
    sinks.upsert(t.spark, batch, root, "monthly_orders", keys, by="y")
    now = sinks.live_tables(t.spark, root)["monthly_orders"]
    written = t.spark.createDataFrame([(f.rsplit("=k", 1)[1], f not in first) for f in now], "year STRING, written_again BOOLEAN")
    out = sinks.read_table(t.spark, root, "monthly_orders").groupBy(F.col("y").cast("string").alias("year")).agg(F.count(F.lit(1)).alias("rows"), F.sum("orders").alias("orders"))
    return out.join(written, "year")


def _stream_of(t: Tables, batches: DataFrame, schema: str, run) -> None:
    """``batches`` (with a column ``batch``) landed and run through ``run(stream)`` one batch number after the other."""
    landing = f"{published_root(t)}/landing"
    numbers = [r[0] for r in batches.select("batch").distinct().orderBy("batch").collect()]  # a few micro-batches
    for number in numbers:
        batches.where(F.col("batch") == number).drop("batch").write.mode("append").parquet(landing)
        run(ingest.landing_stream(t.spark, landing, schema))


@query("st3_repeats_within_horizon")
def q_st3(t: Tables) -> DataFrame:
    """Events replayed in spans of six days: some repeated half an hour later, within the horizon of a day, some twelve
    days later, beyond it; how often each one passes."""
    e = t.read("events", "event_id", "ts")
    again = F.filter(F.array(F.struct(F.lit(0).alias("minutes"), F.lit(True).alias("sent")),
                             F.struct(F.lit(30).alias("minutes"), (F.col("event_id") % 3 == 0).alias("sent")),
                             F.struct(F.lit(12 * 24 * 60).alias("minutes"), (F.col("event_id") % 5 == 0).alias("sent"))), lambda x: x["sent"])
    sent = e.select("event_id", "ts", F.explode(again).alias("x")).select(
        "event_id", (F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("x.minutes"))).alias("ts"))
    root = published_root(t)

    def run(stream: DataFrame) -> None:
        ingest.run_to_files(ingest.dedupe_within_horizon(stream, "ts", "1 day", ["event_id"]), f"st3_{root[-32:]}", f"{root}/passed", checkpoint=f"{root}/_checkpoint")

    _stream_of(t, sent.withColumn("batch", F.floor(F.unix_timestamp("ts") / F.lit(6 * 86400))), "event_id BIGINT, ts TIMESTAMP", run)
    return t.spark.read.schema("event_id BIGINT, ts TIMESTAMP").parquet(f"{root}/passed").groupBy("event_id").agg(F.count(F.lit(1)).alias("passed"))


@query("st5_audit_row_per_batch")
def q_st5(t: Tables) -> DataFrame:
    """Three micro-batches of events upserted by user and type, in folders by type; the audit log's counts of each batch."""
    from tidemark.operators.audit import fold_runs, read_audit

    e = t.read("events", "event_id", "user_id", "event_type", "value").withColumn("batch", F.col("event_id") % 3)
    root = published_root(t)

    def run(stream: DataFrame) -> None:
        rows = stream.select("user_id", "event_type", "value", F.col("event_id").alias("__row_seq"))
        handler = ingest.upsert_each_batch(root, "latest", ["user_id", "event_type"], audit_source="events", by="event_type")
        ingest.run_available(rows, f"st5_{root[-32:]}", handler, checkpoint=f"{root}/_checkpoint")

    _stream_of(t, e, "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE", run)
    return fold_runs(read_audit(t.spark, root)).select("run_id", "status", "rows_inserted", "rows_updated", F.col("rows_unchanged"))


# ---------------------------------------------------------------------------
# Files in their own encodings and layouts


@query("s03_csv_of_two_encodings")
def q_s03(t: Tables) -> DataFrame:
    c = t.read("customer", "c_custkey", "c_name", "c_nationkey").withColumn("c_name", F.concat(F.lit("Société n° "), "c_name"))
    path = f"{published_root(t)}/customers"
    for name, encoding, rows in (("a", "UTF-8", c.where("c_nationkey % 2 = 0")), ("b", "ISO-8859-1", c.where("c_nationkey % 2 = 1"))):
        rows.write.option("header", True).option("encoding", encoding).csv(f"{path}/part={name}")
    out = readers.read_csv_any_encoding(t.spark, path, "c_custkey BIGINT, c_name STRING, c_nationkey INT")
    return out.select("c_custkey", "c_name", "c_nationkey", F.col("_encoding").alias("encoding"))


@query("s01_r02_series_files")
def q_s01(t: Tables) -> DataFrame:
    """Orders by month as one ragged series file a year: five columns of counts and five of the largest totals, in another
    order in even years; blank cells at a line's end are left off."""
    o = t.read("orders", "o_orderdate", "o_orderpriority", "o_totalprice")
    monthly = o.groupBy(F.year("o_orderdate").alias("y"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("d")) \
        .pivot("o_orderpriority", list(PRIORITIES)).agg(F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("v"))
    kinds = [(p, k) for k in "nv" for p in PRIORITIES]

    def cells(values: list[Column]) -> Column:
        arr = F.array(*values)
        return F.array_join(F.when(F.col("y") % 2 == 0, F.reverse(arr)).otherwise(arr), ",")

    def heads(label: Column, texts: list[str]) -> Column:
        return F.concat(label, F.lit(","), cells([F.lit(x) for x in texts]))

    series_label = F.when(F.col("y") % 2 == 0, F.lit("series_id")).otherwise(F.lit("Series ID"))
    meta = monthly.select("y").distinct().select(F.col("y").alias("file"), F.posexplode(F.array(
        F.concat(F.lit("F1 ORDERS OF "), F.col("y").cast("string")),
        heads(F.lit("Title"), [f'"{"Orders" if k == "n" else "Largest total"}, {p}"' for p, k in kinds]),
        heads(F.lit("Units"), ["Number" if k == "n" else "USD" for _, k in kinds]), heads(F.lit("Frequency"), ["Monthly"] * len(kinds)),
        heads(series_label, [f"OR{p[0]}{k.upper()}" for p, k in kinds]))).alias("seq", "line"))
    row = F.concat(F.date_format("d", "dd-MMM-yyyy"), F.lit(","), cells([F.coalesce(F.col(f"`{p}_{k}`").cast("string"), F.lit("")) for p, k in kinds]))
    data = monthly.select(F.col("y").alias("file"), (F.month("d") + 10).alias("seq"), F.regexp_replace(row, ",+$", "").alias("line"))
    path = land_lines(meta.unionByName(data), f"{published_root(t)}/series")
    return readers.read_series_csv(t.spark, path, glob="*.txt").drop("path")


@query("s05_p12_labelled_csv_periods")
def q_s05(t: Tables) -> DataFrame:
    """Line items by month as a labelled CSV, read between two periods."""
    li = t.read("lineitem", "l_shipdate", "l_returnflag", "l_linestatus", "l_quantity")
    flow = li.groupBy(X.date_text("l_shipdate", "yyyy-MM").alias("TIME_PERIOD"), F.col("l_returnflag").alias("MEASURE"), F.col("l_linestatus").alias("REGION")) \
        .agg(F.sum("l_quantity").alias("OBS_VALUE"))
    path = f"{published_root(t)}/flow"
    blank = F.when(F.substring("TIME_PERIOD", -2, 2) == "02", F.lit("..")).otherwise(F.col("OBS_VALUE").cast("string"))
    flow.withColumn("OBS_VALUE", blank).write.option("header", True).csv(path)
    out = readers.read_sdmx_csv(t.spark, path, "1996-01", "1998-12")
    return out.select("period", "measure", "region", "value")


@query("s02_s04_csv_with_marks")
def q_s02(t: Tables) -> DataFrame:
    """Suppliers as header CSVs that begin with a byte-order mark, read against a schema in one scan."""
    s = t.read("supplier", "s_suppkey", "s_name", "s_nationkey", "s_acctbal")
    path = f"{published_root(t)}/suppliers"
    s.withColumnRenamed("s_suppkey", "﻿s_suppkey").write.option("header", True).csv(path)
    return readers.read_csv(t.spark, path, "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE")


# ---------------------------------------------------------------------------
# Manifests against files (G15, G16, K10, X23), reruns


def _release_lines(t: Tables) -> DataFrame:
    """(kind, y, m, file, seq, line): two small files for each month of orders."""
    o = t.read("orders", "o_orderdate", "o_orderstatus", "o_orderpriority")
    per = o.select(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m"), F.explode(F.array(
        F.struct(F.lit("basic").alias("kind"), F.col("o_orderstatus").alias("k")), F.struct(F.lit("detailed").alias("kind"), F.col("o_orderpriority").alias("k")))).alias("x")) \
        .groupBy("y", "m", "x.kind", "x.k").agg(F.count(F.lit(1)).alias("n"))
    name = F.concat("kind", F.lit("_"), F.col("y").cast("string"), F.lit("_"), F.lpad(F.col("m").cast("string"), 2, "0"), F.lit(".csv"))
    return per.select("kind", "y", "m", name.alias("file"), F.col("k").alias("seq"), F.concat_ws(",", "k", F.col("n").cast("string")).alias("line"))


def _manifests(t: Tables, lines: DataFrame, root: str) -> DataFrame:
    path = land_lines(lines.select("file", "seq", "line"), f"{root}/first")
    digests = manifest.file_digests(t.spark, path, "*.txt", folder_key="file")

    def name(kind: str) -> Column:
        return F.concat(F.lit(f"{kind}_"), F.col("release_year").cast("string"), F.lit("_"), F.lpad(F.col("release_month").cast("string"), 2, "0"), F.lit(".csv"))

    releases = lines.select(F.col("y").alias("release_year"), F.col("m").alias("release_month")).distinct().select(
        "release_year", "release_month", F.lit("https://releases.example.org/page").alias("publication_page_url"), F.lit("2026-01-01T00:00:00Z").alias("downloaded_at_utc"),
        *[c for k in ("basic", "detailed") for c in (name(k).alias(f"{k}_name"), F.concat(F.lit("https://releases.example.org/download/"), name(k)).alias(f"{k}_url"))])
    made = manifest.build_manifests(digests, releases)
    made.write.json(f"{root}/manifests")
    return sinks.read_manifest(t.spark, f"{root}/manifests", manifest.MANIFEST_SCHEMA)


@query("g16_release_manifests")
def q_g16(t: Tables) -> DataFrame:
    """The manifest of each month's release, written as JSON and read back."""
    kept = _manifests(t, _release_lines(t), published_root(t))
    return kept.select("release_label", "release_year", "release_month", "status", F.col("basic.filename").alias("basic_name"), F.col("basic.size_bytes").alias("basic_bytes"),
                       F.col("basic.sha256").alias("basic_sha256"), F.col("detailed.sha256").alias("detailed_sha256"), F.col("detailed.url").alias("detailed_url"))


@query("g15_manifest_against_files")
def q_g15(t: Tables) -> DataFrame:
    """The same releases landed again, some of them changed by a rule on the month, and what the manifests say of them."""
    lines, root = _release_lines(t).persist(), published_root(t)
    kept = _manifests(t, lines, root)
    shifted = F.when(F.col("release_month") == 4, F.col("basic").withField("release_month", F.col("release_month") + 1)).otherwise(F.col("basic"))
    basic = F.col("kind") == "basic"
    longer = F.when(basic & (F.col("m") == 1), F.concat("line", F.lit(",?"))).when(basic & (F.col("m") == 2), F.translate("line", "FOP", "XYZ")).otherwise(F.col("line"))
    named = F.when(basic & (F.col("m") == 5), F.replace("file", F.lit("basic"), F.lit("base"))).otherwise(F.col("file"))
    again = lines.where(basic | (F.col("m") != 3)).select(named.alias("file"), "seq", longer.alias("line"))
    digests = manifest.file_digests(t.spark, land_lines(again, f"{root}/second"), "*.txt", folder_key="file")
    found = manifest.validate_against_manifest(kept.withColumn("basic", shifted), digests).select("filename", "problems")
    lines.unpersist()
    return found.unionByName(manifest.validate_names(kept, digests)).select("filename", F.array_join("problems", ",").alias("problems"))


@query("g08_loader_run_twice")
def q_g08_twice(t: Tables) -> DataFrame:
    """A loader of three tables run twice: a keyed upsert and a replace change no count, a bare append doubles its own."""
    from tidemark.operators.shape import add_lineage

    root, rows, keys = published_root(t), _yearly(t), ["y", "m", "priority"]

    def load() -> None:
        sinks.upsert(t.spark, add_lineage(rows, "orders"), root, "monthly_orders", keys, by="y")
        sinks.replace_table(t.spark, t.read("nation", "n_nationkey", "n_name"), root, "nations", ["n_nationkey"])
        sinks.append_rows(t.spark, rows.where("m = 1"), root, "january_log")

    return qa.rerun_check(t.spark, root, load, tolerance_pct=5.0)
