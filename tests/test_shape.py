"""Schema-level helpers and grid rules: P06, P07-P09, P13-P20, K05."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import shape
from tidemark.sources import sinks


def test_rename_keep_defaults_require(spark):
    df = spark.createDataFrame([(1, "x")], "`Country Name` INT, `Visa (Subclass)` STRING")
    n = shape.normalise_columns(df)
    assert n.columns == ["country_name", "visa_subclass"]
    r, skipped = shape.rename_present(n, {"country_name": "country", "absent": "y"})
    assert r.columns == ["country", "visa_subclass"] and skipped == ["absent"]
    k, missing = shape.keep_present(r, ["visa_subclass", "state"])
    assert k.columns == ["visa_subclass"] and missing == ["state"]
    d = shape.add_defaults(k, {"state": "AUS", "visa_subclass": "ignored"})
    assert d.first().state == "AUS" and d.first().visa_subclass == "x"
    with pytest.raises(ValueError, match="state_code"):
        shape.require_columns(d, ["state", "state_code"])
    fb = shape.rename_with_fallback(spark.createDataFrame([(1,)], "provider_code INT"),
                                    {"provider_id": ["cricos_provider_code", "provider_code"]})
    assert fb.columns == ["provider_id"]
    lin = shape.add_lineage(d, "src")
    assert {"_etl_source", "_etl_loaded_at"} <= set(lin.columns)


def test_value_column_and_report_type(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "label STRING, count_granted STRING, note STRING")
    assert shape.detect_value_column(df) == "count_granted"
    assert shape.detect_value_column(df.withColumnRenamed("note", "Total")) == "Total"
    texts = spark.createDataFrame([("none", "7"), ("many", "8")], "data_count_total STRING, x STRING")
    assert shape.detect_value_column(texts) == "x"  # named like a count, but without a number
    assert shape.detect_value_column(texts.select("data_count_total")) is None
    assert shape.classify_report(["Citizenship Country", "Nominated Occupation", "Visa Type"]) == "skilled"
    assert shape.classify_report(["Citizenship Country", "Visa Type"]) == "whm"
    assert shape.classify_report(["Nationality", "Sector"]) == shape.classify_report(["Sum of YTD Enrolments"]) == "education"
    assert shape.classify_report(["Visa Subclass", "Financial Year", "x"]) == "generic"
    assert shape.is_long_layout(["dim", "count"]) and not shape.is_long_layout(["dim", "2019"])


def test_number_counts_by_type_and_text_agree_with_the_cast(spark):
    texts = ["1", "1.", ".5", ".", "", "-", "1e5", "1e", "1d", "1.0F", "0x1p3", "nan", " -Inf ", "+infinity", "infinit", "\t12\n", "1-2", "2024-01-01", "1,000", "9" * 400, None]
    df = spark.createDataFrame([(x, i) for i, x in enumerate(texts)], "t STRING, i INT").select(
        "t", "i", F.when(F.col("i") > 3, F.col("i").cast("double") / 3).alias("d"), F.lit(float("nan")).alias("nan"), F.col("i").cast("decimal(38,9)").alias("dec"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")).alias("day"), F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("at"),
        (F.col("i") > 2).alias("yes"), F.array("i").alias("list"), F.encode("t", "utf-8").alias("bytes"), F.lit(None).alias("void"))
    counts = df.agg(*[shape._number_count(f.name, f.dataType).alias(f.name) for f in df.schema.fields]).first()
    cast = df.agg(*[F.count(F.col(c).cast("string").try_cast("double")).alias(c) for c in df.columns]).first()
    assert counts == cast and counts.t > 8 and counts.i == len(texts) and counts.day == 0


def test_roles_query_reads_each_table_once_for_its_measure(spark, monkeypatch):
    from tidemark.plans.catalog import QUERIES

    asked, detect = [], shape.detect_value_column
    monkeypatch.setattr(shape, "detect_value_column", lambda df, *more: asked.append(df.columns[0]) or detect(df, *more))
    rows = QUERIES["p10_p11_p19_roles_of_columns"](spark, "/root/testdata/sf0.001").collect()
    assert asked == ["l_orderkey", "o_orderkey", "c_custkey"]
    assert [(r.table_name, r.column_name) for r in rows if r.is_measure and r.table_name != "lineitem"] in (
        [("orders", "o_totalprice"), ("customer", "c_custkey")], [("customer", "c_custkey"), ("orders", "o_totalprice")])


def test_filename_context_and_view_dimensions(spark):
    names = ["03_2025_189_SUBMITTED_occupation_by_state.csv", "3-2025-190_Invited_Occupations_Points.csv", "notes.csv",
             "June_491_Submitted_State_English.csv", "11_2024_All_Lodged.csv", "491.csv"]
    df = spark.createDataFrame(list(enumerate(names)), "i INT, f STRING")
    ctx = shape.filename_context(F.col("f"))
    rows = [tuple(r)[1:] for r in df.select("i", *[c.alias(k) for k, c in ctx.items()]).orderBy("i").collect()]
    assert rows == [
        ("03/2025", "189", "SUBMITTED", "occupation_by_state"), ("03/2025", "190", "Invited", "Occupations_Points"),
        (None, None, None, "notes"), ("June", "491", "Submitted", "State_English"), ("11/2024", "All", "Lodged", "11_2024_All_Lodged"),
        (None, "491", None, "491")]  # where no part is left for the view it is the whole stem
    views = spark.createDataFrame([(1, "Occupations_Points"), (2, "State_English"), (3, "Groups")], "i INT, v STRING")
    got = views.select("i", *[c.alias(k) for k, c in shape.view_dimensions(F.col("v")).items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [("Occupations", "Points"), ("Nominated State", "English Test Score"), ("Occupation Groups", "Unknown")]


def test_roles_go_column_by_column():
    rules = [("anzsco_code", [("anzsco", "code"), "=anzsco"]), ("occupation_name", ["occupation", "title"]),
             ("state_territory", ["state", "territory"]), ("assessment_year", ["year"])]
    cols = ["occupation title", "anzsco_version", "anzsco_code", "anzsco", "state", "territory", "title", "year"]
    assert shape.assign_roles(cols, rules, repeatable=["state_territory"]) == {
        "occupation title": "occupation_name", "anzsco_code": "anzsco_code", "state": "state_territory",
        "territory": "state_territory", "year": "assessment_year"}


def test_data_start_rows(spark):
    rows = [("f", "", 0, ["F11 rates", None]), ("f", "", 1, ["Series ID", "FXRUSD"]), ("f", "", 2, ["", "x"]),
            ("f", "", 3, ["04-Jan-2010", "0.9"])]
    g = spark.createDataFrame(rows, "path STRING, sheet STRING, row_idx INT, cells ARRAY<STRING>")
    assert shape.data_start_rows(g).first().data_start == 3


def test_overwrite_and_count(spark, tmp_root):
    df = spark.range(7)
    assert sinks.overwrite_and_count(spark, df, f"{tmp_root}/plain") == 7
    assert sinks.overwrite_and_count(spark, df.limit(3), f"{tmp_root}/plain") == 3
