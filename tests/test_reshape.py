"""Unpivot, EAV, pivots, forward fill, last-wins."""

from pyspark.sql import functions as F

from tidemark.operators import reshape
from tidemark.operators.windows import forward_fill, last_wins


def test_forward_fill_restarts_per_sheet(spark):
    rows = [("s1", 0, "A"), ("s1", 1, None), ("s1", 2, None), ("s1", 3, "B"), ("s2", 0, None), ("s2", 1, "C")]
    df = spark.createDataFrame(rows, "sheet STRING, row_idx INT, label STRING")
    out = forward_fill(df, ["sheet"], "row_idx", ["label"]).orderBy("sheet", "row_idx").collect()
    assert [r.label for r in out] == ["A", "A", "A", "B", None, "C"]


def test_unpivot_and_year_columns(spark):
    df = spark.createDataFrame([("x", 1, 2, "n")], "id STRING, `2004-05` INT, `2005_06` INT, note STRING")
    years = reshape.year_columns(df.columns)
    assert years == ["2004-05", "2005_06"]
    out = reshape.unpivot_columns(df, ["id"], years, "financial_year", "v").collect()
    assert sorted((r.financial_year, r.v) for r in out) == [("2004-05", 1), ("2005_06", 2)]


def test_wide_to_eav_and_back(spark):
    df = spark.createDataFrame([("111111", "720.50", "np")], "code STRING, earnings STRING, employed STRING")
    eav = reshape.wide_to_eav(df, ["code"], ["earnings", "employed"], {"earnings": "Earnings", "employed": "Emp"})
    rows = {r.dimension: r for r in eav.collect()}
    assert rows["earnings"].value_num == 720.5 and rows["employed"].value_num is None
    assert rows["employed"].value_text == "np" and rows["earnings"].profile_measure == "Earnings"
    back = reshape.eav_to_columns(eav, ["code"], "dimension", "value_text", ["earnings", "employed"]).first()
    assert (back.earnings, back.employed) == ("720.50", "np")


def test_pivot_zero_fill_and_total(spark):
    df = spark.createDataFrame([("a", "2020", 1.0), ("a", "2021", 2.0), ("b", "2021", 5.0), (None, "2021", 9.0)],
                               "g STRING, y STRING, v DOUBLE")
    out = {r.g: r for r in reshape.pivot_zero_fill(df, ["g"], "y", ["2020", "2021"], "v").collect()}
    assert set(out) == {"a", "b"}
    assert out["b"]["2020"] == 0 and out["b"].grand_total == 5.0 and out["a"].grand_total == 3.0


def test_conditional_pivot_last_wins(spark):
    rows = [("c1", "189", 10, 1), ("c1", "189", 20, 2), ("c1", "190", 5, 1), ("c2", "491", 7, 3)]
    df = spark.createDataFrame(rows, "code STRING, visa STRING, ceiling INT, seq INT")
    out = {r.code: r for r in reshape.conditional_pivot_last_wins(
        df, "code", "visa", ["189", "190", "491"], {"ceiling": "ceiling_{v}"}, "seq").collect()}
    assert (out["c1"].ceiling_189, out["c1"].ceiling_190, out["c1"].ceiling_491) == (20, 5, None)
    assert out["c2"].ceiling_491 == 7


def test_last_wins_dedupe(spark):
    df = spark.createDataFrame([("2020-01-02", "FX", 1.0, 1), ("2020-01-02", "FX", 1.5, 2), ("2020-01-03", "FX", 2.0, 1)],
                               "d STRING, s STRING, v DOUBLE, load_seq INT")
    out = {r.d: r.v for r in last_wins(df, ["d", "s"], "load_seq").collect()}
    assert out == {"2020-01-02": 1.5, "2020-01-03": 2.0}


def test_union_by_name_missing_as_null(spark):
    a = spark.createDataFrame([(1, "x")], "k INT, a STRING")
    b = spark.createDataFrame([(2, 3.0)], "k INT, b DOUBLE")
    out = reshape.union_by_name([a, b]).orderBy("k").collect()
    assert out[0].b is None and out[1].a is None
    lab = reshape.label_and_union({"m1": a.select("k"), "m2": b.select("k")})
    assert sorted((r.k, r.measure) for r in lab.collect()) == [(1, "m1"), (2, "m2")]


def test_forward_fill_across_chunks(spark):
    rows = [("s1", i, "A" if i == 0 else ("B" if i == 7 else None)) for i in range(12)] + [("s2", 0, None), ("s2", 5, "C")]
    df = spark.createDataFrame(rows, "sheet STRING, row_idx INT, label STRING")
    out = forward_fill(df, ["sheet"], "row_idx", ["label"], chunk_rows=3).orderBy("sheet", "row_idx").collect()
    assert [r.label for r in out] == ["A"] * 7 + ["B"] * 5 + [None, "C"]


def test_latest_per_group(spark):
    from tidemark.operators.windows import latest_per_group

    df = spark.createDataFrame([("k", "2024-01", 5), ("k", "2024-03", 7), ("j", "2023-12", 1)], "c STRING, p STRING, v INT")
    got = {r.c: (r.p, r.v) for r in latest_per_group(df, ["c"], ["p"]).collect()}
    assert got == {"k": ("2024-03", 7), "j": ("2023-12", 1)}
