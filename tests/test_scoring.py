"""Percentile rank (vs pandas), opportunity score, recommendations, formatting."""

import math

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import scalars as X
from tidemark.operators import scoring
from tidemark.operators.windows import percentile_rank, percentile_rank_by_value_counts


def _ranks(spark, values, fn=percentile_rank):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, v DOUBLE")
    return [r.r for r in fn(df, "v", "r").orderBy("id").collect()]


def _same(a, b):
    return all((x is None and (y is None or math.isnan(y))) or (x is not None and abs(x - y) < 1e-9)
               for x, y in zip(a, b))


def test_rank_ties_and_nulls(spark):
    assert _ranks(spark, [10.0, 20.0, 20.0, None, 40.0]) == [25.0, 62.5, 62.5, None, 100.0]
    r = _ranks(spark, [10.0, None, 30.0])
    assert r[1] is None and r[0] < r[2]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float)), min_size=1, max_size=12))
def test_rank_matches_pandas(spark, values):
    expected = list(pd.Series(values, dtype="float64").rank(pct=True, na_option="keep") * 100)
    assert _same(_ranks(spark, values), expected)
    assert _same(_ranks(spark, values, percentile_rank_by_value_counts), expected)


def _inputs(spark):
    return spark.createDataFrame(
        [("A", 1000, 20.0, 300.0), ("B", 500, 5.0, None), ("C", 100, -10.0, 50.0), ("X", None, None, None)],
        "nationality STRING, current_volume BIGINT, growth_pct DOUBLE, visa_volume DOUBLE",
    )


def test_opportunity_scores(spark):
    out = scoring.opportunity_scores(_inputs(spark)).collect()
    assert out[0].nationality == "A"
    rows = {r.nationality: r for r in out}
    assert rows["A"].data_confidence_pct == 100.0
    assert set(rows["A"].weights_used) == {"growth", "market_size", "visa_pathway"}
    assert set(rows["B"].weights_used) == {"growth", "market_size"}
    assert abs(sum(rows["B"].weights_used.values()) - 1.0) < 1e-2
    assert abs(rows["B"].data_confidence_pct - 66.7) < 1e-9
    assert rows["X"].opportunity_score is None and rows["X"].data_confidence_pct == 0.0
    assert out[-1].nationality == "X"  # NULL score sorts last
    for r in out:
        assert "competition" not in (r.weights_used or {})


def test_recommendation_rules(spark):
    cases = [(None, None, None), (15.0, 5000.0, 2000.0), (15.0, 500.0, 2000.0), (-15.0, 1000.0, 2000.0),
             (2.0, 1000.0, 2000.0), (10.0, 2000.0, 2000.0), (-10.0, 1.0, 2000.0)]
    df = spark.createDataFrame(cases, "g DOUBLE, v DOUBLE, m DOUBLE")
    got = [r.t for r in df.select(scoring.recommendation(F.col("g"), F.col("v"), F.col("m")).alias("t")).collect()]
    assert "insufficient" in got[0].lower()
    assert "prioritize" in got[1].lower() and "+15.0%" in got[1]
    assert "emerging" in got[2].lower()
    assert "declining" in got[3].lower() and "-15.0%" in got[3]
    assert got[4].startswith("Stable market (+2.0% YoY)")
    assert "already large" in got[5]  # +10 exactly is strong growth
    assert "declining" in got[6].lower()  # -10 exactly is decline


def test_formatting_and_ratios(spark):
    df = spark.createDataFrame([(110.0, 100.0), (90.0, 100.0), (100.0, 0.0), (None, 5.0)], "c DOUBLE, p DOUBLE")
    got = [r.x for r in df.select(X.pct_change("c", "p").alias("x")).collect()]
    assert got[:3] == [10.0, -10.0, None] and got[3] is None
    r = spark.createDataFrame([(10.0, 4.0), (4.0, 0.0)], "a DOUBLE, b DOUBLE").select(
        X.safe_ratio("a", "b").alias("x")).collect()
    assert [x.x for x in r] == [2.5, None]
    f = spark.createDataFrame([(1234.0, 5.0), (None, float("nan"))], "n DOUBLE, p DOUBLE").select(
        X.fmt_number("n").alias("a"), X.fmt_pct("p", 1, signed=True).alias("b"),
        X.period_label(F.lit(2026), F.lit(2)).alias("c")).collect()
    assert (f[0].a, f[0].b, f[0].c) == ("1,234", "+5.0%", "2026-02")
    assert (f[1].a, f[1].b) == ("N/A", "N/A")


def test_bucketed_rank_many_ranges(spark):
    import random

    rnd = random.Random(7)
    values = [float(rnd.randint(0, 60)) if rnd.random() > 0.1 else None for _ in range(400)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id INT, v DOUBLE")
    got = [r.r for r in percentile_rank_by_value_counts(df, "v", "r", buckets=7).orderBy("id").collect()]
    expected = list(pd.Series(values, dtype="float64").rank(pct=True, na_option="keep") * 100)
    assert _same(got, expected)


def test_rank_within_partitions(spark):
    df = spark.createDataFrame([("p", 1.0), ("p", 2.0), ("q", 5.0), ("q", 5.0), ("q", None)], "g STRING, v DOUBLE")
    got = sorted((r.g, r.v, r.r) for r in percentile_rank(df, "v", "r", partition=["g"]).collect()
                 if r.v is not None)
    # pandas: two tied values share rank 1.5 of 2 -> 75 %
    assert got == [("p", 1.0, 50.0), ("p", 2.0, 100.0), ("q", 5.0, 75.0), ("q", 5.0, 75.0)]
    got2 = sorted((r.g, r.v, r.r) for r in percentile_rank_by_value_counts(df, "v", "r", partition=["g"]).collect()
                  if r.v is not None)
    assert got2 == got
