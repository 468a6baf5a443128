"""Coercion, period text, naming and key helpers."""

import hashlib

from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators.shape import assign_roles, norm_col


def test_norm_col_cases():
    cases = {"Country": "country", "Country Name": "country_name", "CO2 Emissions (kt)": "co2_emissions_kt",
             "  _test_  ": "test", "lf_period": "lf_period", "BP0015": "bp0015"}
    for raw, want in cases.items():
        assert norm_col(raw) == want


def test_norm_name_expr_matches_driver(spark):
    names = ["Country", "Country Name", "CO2 Emissions (kt)", "  _test_  ", "BP0015"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    got = [r.x for r in df.select(X.norm_name_expr("n").alias("x")).collect()]
    assert got == [norm_col(n) for n in names]


def test_lenient_numbers(spark):
    junk = ["1,234", "$5", "nan", "inf", "-", None, "12-13", "n.p.", " 42 ", "3.5"]
    df = spark.createDataFrame([(j,) for j in junk], "t STRING")
    out = df.select(X.lenient_double("t").alias("a"), X.strip_money("t").alias("b"),
                    X.strip_to_number("t").alias("c")).collect()
    assert [r.a for r in out] == [None, None, None, None, None, None, None, None, 42.0, 3.5]
    assert out[0].b == 1234.0 and out[1].b == 5.0
    assert out[0].c == 1234.0 and out[6].c is None  # '12-13' is not a number


def test_dates_periods(spark):
    df = spark.createDataFrame([("29-Jan-2010", "2006_01_01_00_00_00", "2005_06", "457 Temporary Work", "Dec")],
                               "d STRING, h STRING, fy STRING, lab STRING, mon STRING")
    r = df.select(
        X.parse_day_first_date("d").alias("d"), X.mangled_header_month("h").alias("h"),
        X.header_period("fy").alias("p"), X.fy_dash(F.lit("2025_26_to_30_april_2026")).alias("f"),
        X.leading_digits("lab").alias("l"), X.month_number("mon").alias("m"),
        X.month_label(F.lit(2026), F.lit(5)).alias("ml"), X.mangled_header_month(F.lit("total")).alias("none"),
    ).first()
    assert str(r.d) == "2010-01-29" and r.h == "2006-01" and r.p == "2005-06"
    assert r.f == "2025-26-to-30-april-2026" and r.l == "457" and r.m == 12 and r.ml == "May 2026"
    assert r.none is None


def test_location_id_matches_md5(spark):
    df = spark.createDataFrame([(" ABC ", "Main Campus")], "p STRING, n STRING")
    got = df.select(X.synth_location_id("p", "n").alias("x")).first().x
    assert got == hashlib.md5(b"ABC|main campus").hexdigest()[:16]


def test_role_assignment_order_and_collisions():
    cols = ["Visa Subclass", "Country of Birth", "Occupation", "Total"]
    rules = [("country", ["country"]), ("visa", ["visa", "subclass"]), ("occupation", ["occupation"]),
             ("value", ["total"])]
    roles = assign_roles(cols, rules)
    assert roles == {"Country of Birth": "country", "Visa Subclass": "visa", "Occupation": "occupation",
                     "Total": "value"}
    import pytest

    with pytest.raises(ValueError):
        assign_roles(["country visa"], [("country", ["country"]), ("visa", ["visa"])], on_collision="error")
