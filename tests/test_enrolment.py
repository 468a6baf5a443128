"""YTD semantics (Q1-Q3), accumulation, snapshots and growth."""

from pyspark.sql import functions as F

from tidemark.operators import enrolment as en
from tidemark.operators.windows import accumulate_ytd, deaccumulate_ytd

FACT = "enrol_year INT, enrol_month INT, nationality STRING, sector STRING, state_code STRING, " \
       "ytd_enrolments BIGINT, ytd_commencements BIGINT"


def fact(spark, rows):
    return spark.createDataFrame(rows, FACT)


def test_accumulate_densifies_and_runs(spark):
    monthly = spark.createDataFrame(
        [(2020, 1, "A", 5), (2020, 3, "A", 2), (2020, 2, "B", 4), (2021, 1, "A", 7)],
        "y INT, m INT, k STRING, v BIGINT",
    )
    out = accumulate_ytd(monthly, "y", "m", ["k"], ["v"]).orderBy("y", "k", "m").collect()
    got = [(r.y, r.m, r.k, r.v) for r in out]
    # published periods: 2020-01..03 and 2021-01; A carried through Feb; B starts in Feb
    assert got == [
        (2020, 1, "A", 5), (2020, 2, "A", 5), (2020, 3, "A", 7),
        (2020, 2, "B", 4), (2020, 3, "B", 4),
        (2021, 1, "A", 7),
    ]


def test_deaccumulate_inverts(spark):
    f = fact(spark, [(2020, 1, "A", "s", "x", 5, 0), (2020, 2, "A", "s", "x", 8, 0), (2020, 3, "A", "s", "x", 8, 0)])
    out = deaccumulate_ytd(f, "enrol_year", "enrol_month", ["nationality"], "ytd_enrolments", "flow")
    assert [r.flow for r in out.orderBy("enrol_month").collect()] == [5, 3, 0]


def test_never_sum_across_months_latest_month_per_year(spark):
    f = fact(spark, [
        (2020, 11, "A", "s", "x", 10, 1), (2020, 12, "A", "s", "x", 12, 2),
        (2021, 5, "A", "s", "x", 3, 1), (2021, 5, "B", "s", "x", 4, 1),
    ])
    out = en.at_latest_month_of_year(f).orderBy("enrol_year").collect()
    assert [(r.enrol_year, r.enrol_month, r.total_enrolments) for r in out] == [(2020, 12, 12), (2021, 5, 7)]


def test_scope_filtered_vs_global(spark):
    # C has rows in 2020-10 but none in the global latest month 2020-12
    f = fact(spark, [
        (2020, 10, "C", "s", "x", 9, 0), (2020, 12, "A", "s", "x", 12, 0),
    ])
    filt = en.at_latest_month_of_year(f, where=F.col("nationality") == "C", scope="filtered").collect()
    glob = en.at_latest_month_of_year(f, where=F.col("nationality") == "C", scope="global").collect()
    assert [(r.enrol_month, r.total_enrolments) for r in filt] == [(10, 9)]
    assert glob == []


def test_latest_period_and_growth(spark):
    f = fact(spark, [
        (2020, 6, "A", "s", "x", 100, 0), (2021, 6, "A", "s", "x", 150, 0), (2021, 6, "N", "s", "x", 5, 0),
        (2020, 6, "P", "s", "x", 7, 0), (2021, 3, "A", "s", "x", 1, 0),
    ])
    lp = en.latest_period(f).first()
    assert (lp.enrol_year, lp.enrol_month) == (2021, 6)
    g = {r.nationality: (r.current_total, r.previous_total) for r in en.country_growth_latest(f).collect()}
    # N only in current -> previous 0; P only in prior -> absent
    assert g == {"A": (150, 100), "N": (5, 0)}
    g2 = {r.nationality: (r.current_total, r.previous_total) for r in en.country_growth(f, 2021, 6, 2020).collect()}
    assert g2 == g


def test_empty_in_list_gives_typed_empty(spark):
    f = fact(spark, [(2020, 6, "A", "s", "x", 1, 0)])
    e = en.empty_like(f)
    assert e.count() == 0 and e.schema == f.schema
