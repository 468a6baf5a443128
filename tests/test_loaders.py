"""Filters, manifests, run helpers, audit fold and source loaders."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import filters as flt
from tidemark.operators import runs
from tidemark.operators.audit import AuditRun, fold_runs, freshness, last_completed, read_audit, recent_failures
from tidemark.plans import loaders
from tidemark.sources import manifest, sinks


def test_filters(spark):
    df = spark.createDataFrame(
        [("NSW", "Total", 5, "261313"), ("NATIONAL", "India", 0, "2613"), (None, None, -1, None), (None, None, None, None)],
        "state STRING, label STRING, n INT, code STRING",
    )
    assert flt.where_equal(df, state=None).count() == 4
    assert flt.where_equal(df, label=[]).count() == 0
    assert flt.where_equal(df, label=["India", "Total"]).count() == 2
    assert flt.drop_empty_rows(df).count() == 3
    assert flt.drop_null_in(df, ["state"]).count() == 2
    assert [r.label for r in flt.exclude_totals(df, ["label"]).collect()] == ["India", None, None]
    assert flt.positive(df, "n").count() == 1
    assert flt.national_only(df).count() == 3
    assert df.where(flt.matches("code", flt.SIX_DIGIT_CODE)).count() == 1
    wide = spark.createDataFrame([(1, None), (2, None)], "a INT, b STRING")
    assert flt.drop_empty_columns(wide).columns == ["a"]
    sheets = spark.createDataFrame([("Institutions",), ("Course Locations",), ("Courses",), ("Locations",), ("Notes",)],
                                   "sheet STRING")
    got = [r.e for r in sheets.select(flt.route_sheet(F.col("sheet"), flt.PROVIDER_SHEET_ROUTES).alias("e")).collect()]
    assert got == ["provider", "course_location", "course", "location", None]


def test_manifest_validation(spark, tmp_root):
    d = os.path.join(tmp_root, "rel")
    os.makedirs(d)
    for name, body in (("basic.xlsx", b"basic-bytes"), ("detailed.xlsx", b"detailed-bytes"), ("basic_raw.csv", b"r")):
        with open(os.path.join(d, name), "wb") as fh:
            fh.write(body)
    dig = manifest.file_digests(spark, d)
    assert {r.filename: r.sha256 for r in dig.collect()}["basic.xlsx"] == hashlib.sha256(b"basic-bytes").hexdigest()
    m = manifest.build_manifest(spark, dig, 2026, 5, "https://x/page", "basic.xlsx", "https://x/b", "detailed.xlsx",
                                "https://x/d", "2026-06-01T00:00:00Z")
    ok = {r.kind: r.ok for r in manifest.validate_against_manifest(m, dig).collect()}
    assert ok == {"basic": True, "detailed": True}
    not_extracted = manifest.validate_against_manifest(m, dig, require_extracted=True).collect()
    assert all("not_extracted" in r.problems for r in not_extracted)
    split = dig.where(F.col("filename") == "basic_raw.csv")
    ext = manifest.mark_extracted(m, split, split)
    assert all(r.ok for r in manifest.validate_against_manifest(ext, dig, require_extracted=True).collect())
    with open(os.path.join(d, "basic.xlsx"), "wb") as fh:
        fh.write(b"changed!!!!")  # same size, new bytes
    changed = {r.kind: r.problems for r in manifest.validate_against_manifest(m, manifest.file_digests(spark, d)).collect()}
    assert changed["basic"] == ["hash_mismatch"]
    os.remove(os.path.join(d, "detailed.xlsx"))
    gone = {r.kind: r.problems for r in manifest.validate_against_manifest(m, manifest.file_digests(spark, d)).collect()}
    assert gone["detailed"] == ["missing_file"]
    path = os.path.join(tmp_root, "manifest_json")
    sinks.write_manifest(spark, m, path)
    back = sinks.read_manifest(spark, path, manifest.MANIFEST_SCHEMA).first()
    assert back.basic.sha256 == hashlib.sha256(b"basic-bytes").hexdigest() and back.release_label == "May 2026"


def test_run_summary_gate_and_cache(spark):
    def boom():
        raise RuntimeError("bad file")

    summary = runs.run_sources(spark, {"a": lambda: 5, "b": boom, "c": lambda: 0})
    st = {r.source: r.status for r in summary.collect()}
    assert st == {"a": "ok", "b": "failed", "c": "empty"}
    gate = runs.load_gate(summary).first()
    assert not gate.passed and gate.blocking_sources == ["b", "c"]
    assert runs.load_gate(summary.where("source = 'a'")).first().passed
    cache = runs.ResultCache(ttl_seconds=60)
    calls = []
    build = lambda: calls.append(1) or spark.range(3)
    cache.get("q", "v1", build)
    cache.get("q", "v1", build)
    cache.get("q", "v2", build)
    assert len(calls) == 2
    cache.clear()


def test_audit_fold(spark, tmp_root):
    with AuditRun(spark, tmp_root, "rba", "fact_exchange_rate") as run:
        run.record(inserted=3)
    with pytest.raises(ValueError):
        with AuditRun(spark, tmp_root, "jsa", "fact_job_vacancy"):
            raise ValueError("x" * 3000)
    runs_df = fold_runs(read_audit(spark, tmp_root))
    st = {r.source: (r.status, r.rows_inserted, len(r.error_message or "")) for r in runs_df.collect()}
    assert st == {"rba": ("completed", 3, 0), "jsa": ("failed", 0, 2000)}
    assert [r.source for r in last_completed(runs_df).collect()] == ["rba"]
    assert [r.source for r in recent_failures(runs_df).collect()] == ["jsa"]
    assert freshness(runs_df).first().tables_tracked == 1


def test_exchange_rate_loader_last_file_wins(spark, tmp_root):
    land = os.path.join(tmp_root, "rba")
    os.makedirs(land)
    head = "Title,AUD/USD\nUnits,USD\nFrequency,Daily\nSeries ID,FXRUSD\n"
    with open(os.path.join(land, "f11_2023.csv"), "w") as fh:
        fh.write(head + "02-Jan-2024,0.6800\n03-Jan-2024,0.6700\n")
    with open(os.path.join(land, "f11_2024.csv"), "w") as fh:
        fh.write(head + "03-Jan-2024,0.6750\n04-Jan-2024,0.6600\n")
    root = os.path.join(tmp_root, "pub")
    assert loaders.load_exchange_rates(spark, land, root, dry_run=True) == 3
    assert sinks.current_version(spark, root, "fact_exchange_rate") is None
    loaders.load_exchange_rates(spark, land, root)
    got = {str(r.rate_date): r.value for r in sinks.read_table(spark, root, "fact_exchange_rate").collect()}
    assert got == {"2024-01-02": 0.68, "2024-01-03": 0.675, "2024-01-04": 0.66}
    loaders.load_exchange_rates(spark, land, root)  # rerun: idempotent
    assert sinks.read_table(spark, root, "fact_exchange_rate").count() == 3
    counts = {r.table_name: r.rows for r in loaders.table_counts(spark, root, ["fact_exchange_rate", "x"]).collect()}
    assert counts == {"fact_exchange_rate": 3, "x": 0}
    assert loaders.missing_tables(spark, root, ["fact_exchange_rate", "fact_cpi"]) == ["fact_cpi"]


def test_two_grains_never_unioned(spark, tmp_root):
    basic = spark.createDataFrame([(2024, 6, "China", "NSW", 100)], "y INT, m INT, nat STRING, st STRING, ytd BIGINT")
    detailed = spark.createDataFrame([(2024, 6, "China", "NSW", "IT", 60), (2024, 6, "China", "NSW", "Law", 40)],
                                     "y INT, m INT, nat STRING, st STRING, field STRING, ytd BIGINT")
    with pytest.raises(ValueError):
        loaders.load_enrolment_grains(spark, basic, detailed, tmp_root, ["y", "m", "nat", "st"], ["y", "m", "nat", "st"])
    assert loaders.load_enrolment_grains(
        spark, basic, detailed, tmp_root, ["y", "m", "nat", "st"], ["y", "m", "nat", "st", "field"]) == (1, 2)
