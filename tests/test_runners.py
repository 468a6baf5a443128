"""Source runners on small hand-made sheets and files: precedence, merged labels, odd layouts, one commit for all tables."""

import os

import pytest
from pyspark.sql import functions as F

from tests_helpers import write_workbook
from tidemark.operators import sheets
from tidemark.operators.shape import header_rows
from tidemark.plans import runners
from tidemark.sources import manifest, readers, sinks, xlsx
from tidemark.sources.scratch import Scratch

GRID = "path STRING, sheet STRING, row_idx BIGINT, cells ARRAY<STRING>"


def grid(spark, books):
    return spark.createDataFrame([(p, s, i, r) for (p, s), rows in books.items() for i, r in enumerate(rows)], GRID)


def test_register_from_a_workbook_and_its_correction(spark, tmp_root):
    head = ["CRICOS Provider Code", "Institution Name", "Postal Address State"]
    write_workbook(os.path.join(tmp_root, "a_2024.xlsx"), {
        "Institutions": [["Title"], ["Report generated"], head, ["00001A", "First", "NSW"], ["00002B", "Second", ""]],
        "Course Locations": [head[:1] + ["CRICOS Course Code", "Location Name"], ["00001A", "C1", "Main "], ["00001A", "C1", "main"]],
        "Courses": [["CRICOS Course Code", "Course Name", "Total Cost (AUD)", "CRICOS Provider Code"], ["C1", "Law", "$1,200.50", "00001A"], ["", "", "", ""]]}, pad_to=0)
    write_workbook(os.path.join(tmp_root, "b_2025.xlsx"), {"Institution list": [head, ["00002B", "Second renamed", "VIC"]]})
    facts = runners.register_facts(xlsx.read_grid(spark, tmp_root))
    root = os.path.join(tmp_root, "published")
    first = runners.load(spark, "register", facts, root)
    assert {k: r.inserted for k, r in first.items()} == {"dim_provider": 2, "dim_course": 1, "dim_provider_location": 0, "bridge_course_location": 1}
    assert sinks.last_commit(spark, root) == 1
    providers = {r.provider_id: (r.provider_name, r.state_code) for r in sinks.read_table(spark, root, "dim_provider").collect()}
    assert providers == {"00001A": ("First", "NSW"), "00002B": ("Second renamed", "VIC")}
    assert sinks.read_table(spark, root, "dim_course").first().annual_fees_aud == 1200.5
    again = runners.load(spark, "register", facts, root)
    assert all((r.inserted, r.updated) == (0, 0) for r in again.values())


def test_merged_labels_are_filled_from_rows_without_values(spark):
    g = grid(spark, {("student_visas.xlsx", "Lodged 2026"): [
        ["Visas"], ["Applicant Type", "Sector", "2004-05", "2005-06", "Comment"], ["Primary", None, None, None, None], [None, "School", "1,234", "x", "2"],
        [None, "VET", "5", "6", None], ["Secondary", "VET", "7", " ", None], ["Total", "VET", "99", "99", None], [None, "Grand Total", "99", "9", None]]})
    rows = {(r.applicant_type, r.sector, r.financial_year, r.measure): r.value for r in runners.visa_facts(g)["fact_student_visa_activity"].collect()}
    assert rows == {("Primary", "School", "2004-05", "lodged"): 1234.0, ("Primary", "VET", "2004-05", "lodged"): 5.0,
                    ("Primary", "VET", "2005-06", "lodged"): 6.0, ("Secondary", "VET", "2004-05", "lodged"): 7.0}


def test_series_sheets_with_and_without_labels(spark):
    g = grid(spark, {
        ("labour_1.xlsx", "Data1"): [["", "Employed ;  Females ;", "Rate ;  Persons ;"], ["Unit", "000", "Percent"], ["Series Type", "Trend", "Original"], [None], ["Series ID", "A1", "A2"],
                                     ["2024-01-01", "5", "n.a."], ["2024-02-01 00:00:00", "6", "7.5"]],
        ("labour_2.xlsx", "Data1"): [["", "Employed ;  Males ;  Seasonally Adjusted"], ["Series ID", "A3"], ["01-Mar-2024", "8"]]})
    rows = [(r.lf_period, r.series_id, r.sex, r.adjustment_type, r.unit, r.value) for r in runners.macro_facts(g)["fact_labour_force"].orderBy("lf_period", "series_id").collect()]
    assert rows == [("2024-01", "A1", "Females", "Trend", "000", 5.0), ("2024-02", "A1", "Females", "Trend", "000", 6.0), ("2024-02", "A2", "Persons", "Original", "Percent", 7.5),
                    ("2024-03", "A3", "Males", "Seasonally Adjusted", None, 8.0)]


def test_shortage_lists_take_a_role_once(spark):
    lists = grid(spark, {("osl.xlsx", "OSL"): [["ANZSCO Code", "Title", "Shortage", "Shortage driver"], ["261313", "Engineer", "S", "D"], ["", "Nobody", "S", ""], ["261312", "Developer", "", ""]],
                         ("osca.xlsx", "OSCA"): [["OSCA code", "Occupation", "Shortage"], ["1", "x", "S"]]})
    empty = spark.createDataFrame([], GRID)
    got = runners.labour_market_facts(empty, lists, empty)["fact_occupation_shortage"].collect()
    assert [(r.anzsco_code, r.anzsco_level, r.shortage_status, r.state_code, r.assessment_year) for r in got] == [("261313", 6, "S", "AUS", None)]


def test_named_and_melted_rows_on_odd_headings(spark):
    g = grid(spark, {("p", "s"): [["B", "A", "", "A"], ["b1", " a1 ", "x", "again"], [], [None, "", " "], ["b2"]]})
    hdr = header_rows(g, hint="^a$", min_nonnull=2)
    rows = sheets.named_rows(g, hdr, {"a": ["zz", "a"], "none": ["zz"]}).orderBy("row_idx").collect()
    assert [(r.a, r.none) for r in rows] == [("a1", None), (None, None)]
    long = sheets.melted_rows(g, hdr, [("b", sheets.is_any("b"))], "n", "v").orderBy("row_idx").collect()
    assert [(r.b, r.n, r.v) for r in long] == [("b1", "a", "a1"), ("b1", "a", "again")]
    assert sheets.melted_rows(g, hdr, [("c", sheets.contains_any("c+d", "q"))], "n", "v").collect() == []


def test_rows_of_one_sheet_are_dealt_over_tasks(spark):
    g = grid(spark, {("p", "s"): [["Code", "Name", "2020"], *[[f"c{i}", f"n{i}", str(i)] for i in range(200)]]})
    hdr = header_rows(g, hint="code")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        named = sheets.named_rows(g, hdr, {"code": ["code"], "name": ["name"]})
        long = sheets.melted_rows(g, hdr, [("code", sheets.is_any("code"))], "n", "v")
        roles = runners._by_roles(g, hdr, [("code", sheets.contains_any("code"))], ["code", "none"])
        got = [df.withColumn("task", F.spark_partition_id()).collect() for df in (named, long, roles)]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(r.code for r in got[0]) == sorted(f"c{i}" for i in range(200)) and all(r.name[1:] == r.code[1:] for r in got[0])
    assert sorted((r.code, r.n, r.v) for r in got[1]) == sorted((f"c{i}", n, v) for i in range(200) for n, v in (("name", f"n{i}"), ("2020", str(i))))
    assert sorted((r.code, r.none) for r in got[2]) == sorted((f"c{i}", None) for i in range(200))
    assert all(len({r.task for r in rows}) > 1 for rows in got)


def test_exports_in_two_encodings_and_layouts(spark, tmp_root):
    def write(name, text, encoding):
        with open(os.path.join(tmp_root, name), "wb") as fh:
            fh.write(text.encode(encoding))

    write("06_2026_189_Submitted_Occupations_Points.csv", '﻿Métier,65,"70, 75"\nCafé ,"1,200",0\nThé,,5\n', "utf-8")
    write("06_2026_190_Invited_State_ProfYear.csv", "État,Yes,No\nForêt,3,x\n", "latin-1")
    write("loose.csv", "Dimension 1 name,Dimension 1 val,Dimension 2 name,Dimension 2 val,EOI count\nA,a,B,b,7\nA,c,B,d,0\n", "utf-8")
    facts = runners.interest_facts(runners.csv_grid(spark, tmp_root, 5))
    rows = {(r.as_at_month, r.visa_type, r.source_view, r.dimension_1_name, r.dimension_1_val, r.dimension_2_name, r.dimension_2_val): r.eoi_count
            for r in facts["stg_skillselect_eoi"].collect()}
    assert rows == {("06/2026", "189", "Occupations_Points", "Occupations", "Café", "Points", "65"): 1200.0, ("06/2026", "189", "Occupations_Points", "Occupations", "Thé", "Points", "70, 75"): 5.0,
                    ("06/2026", "190", "State_ProfYear", "Nominated State", "Forêt", "Professional Year", "Yes"): 3.0, (None, None, "loose", "A", "a", "B", "b"): 7.0}


def test_a_failing_table_leaves_all_of_a_release_as_it_was(spark, tmp_root):
    good = spark.createDataFrame([(1, "x", "a")], "k INT, v STRING, o STRING")
    sinks.upsert_release(spark, tmp_root, {"one": good, "two": good}, {"one": ["k"], "two": ["k"]}, "o")
    new = good.withColumn("v", F.lit("new"))
    bad = new.withColumn("v", F.raise_error(F.lit("torn sheet")).cast("string"))
    with pytest.raises(Exception, match="torn sheet"):
        sinks.upsert_release(spark, tmp_root, {"one": new, "two": bad}, {"one": ["k"], "two": ["k"]}, "o")
    assert sinks.last_commit(spark, tmp_root) == 1
    assert [sinks.read_table(spark, tmp_root, n).first().v for n in ("one", "two")] == ["x", "x"]

    def refuse(table, df):
        if df.where("value < 0").count():
            raise sinks.LoadError(table)

    facts = {"fact_cpi": spark.createDataFrame([("2024-01", "C1", -1.0, "p")], "cpi_period STRING, series_id STRING, value DOUBLE, __place STRING")}
    with pytest.raises(sinks.LoadError):
        runners.load(spark, "macro", facts, tmp_root, gate=refuse)
    assert sinks.last_commit(spark, tmp_root) == 1


def test_encodings_are_judged_by_file(spark, tmp_root):
    for name, raw in (("a.csv", "k,v\n1,é\n2,plain\n".encode()), ("b.csv", "k,v\n3,é\n".encode("latin-1")), ("c.csv", b"k,v\n4,ascii\n")):
        with open(os.path.join(tmp_root, name), "wb") as fh:
            fh.write(raw)
    got = {r.k: (r.v, r._encoding) for r in readers.read_csv_any_encoding(spark, tmp_root, "k INT, v STRING").collect()}
    assert got == {1: ("é", "UTF-8"), 2: ("plain", "UTF-8"), 3: ("é", "ISO-8859-1"), 4: ("ascii", "UTF-8")}
    with pytest.raises(Exception):
        readers.read_csv_any_encoding(spark, tmp_root, "k INT", glob="*.none")


def test_scratch_removes_what_it_wrote(spark):
    with Scratch(spark) as s:
        cut = s.cut(spark.range(5))
        folder = s.root
        assert cut.count() == 5 and os.path.isdir(folder.removeprefix("file:"))
    assert not os.path.isdir(folder.removeprefix("file:"))


def test_manifests_name_files_that_are_not_there(spark):
    digests = spark.createDataFrame([("p/basic_1", "basic_1", 3, "s")], "path STRING, filename STRING, size_bytes BIGINT, sha256 STRING")
    releases = spark.createDataFrame([(2026, 5, "u", "t", "basic_1", "b", "detailed_1", "d")], "release_year INT, release_month INT, publication_page_url STRING, "
                                     "downloaded_at_utc STRING, basic_name STRING, basic_url STRING, detailed_name STRING, detailed_url STRING")
    made = manifest.build_manifests(digests, releases)
    row = made.first()
    assert (row.release_label, row.basic.size_bytes, row.detailed.sha256) == ("May 2026", 3, None)
    assert {r.kind: r.problems for r in manifest.validate_against_manifest(made, digests).collect()} == {"basic": [], "detailed": ["missing_file"]}
    extra = digests.withColumn("filename", F.lit("other"))
    assert [tuple(r) for r in manifest.validate_names(made, digests.unionByName(extra)).collect()] == [("other", ["not_in_manifest"])]
