"""Plan hygiene of every registered query of the star schema: no row-at-a-time Python, no cartesian
or nested-loop joins, and the flagship reads each source table once."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tidemark.plans.catalog import QUERIES

FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "CartesianProduct", "BroadcastNestedLoopJoin")
STREAMING = ("st2_", "st3_", "st4_", "st5_")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_or_cross_joins(spark):
    offenders = {}
    for name, fn in QUERIES.items():
        if name.startswith(STREAMING):
            continue
        plan = _plan(fn(spark, SF_SMALL))
        hit = [f for f in FORBIDDEN if f in plan]
        if hit:
            offenders[name] = hit
    assert offenders == {}


@pytest.mark.parametrize("name", ["a04_yearly_snapshot_totals", "m_enrol", "a05_sector_yearly_trend"])
def test_enrolment_queries_scan_orders_once(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet [^\n]*?/(\w+)\.parquet", plan)
    assert scans.count("orders") == 1, scans


@pytest.mark.parametrize("name", ["j02_country_growth", "b06_kpi_block", "a01_enrolment_by_country_at_latest"])
def test_latest_year_is_a_subquery_over_two_columns(spark, name):
    """Orders are read twice: the second time for the latest year alone, from customer and date; no window gathers the flows."""
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    # (a subquery is printed wherever it is named, and run once)
    read = {frozenset(re.findall(r"(o_\w+)#", cols)) for cols, table in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?/(\w+)\.parquet", plan) if table == "orders"}
    assert len(read) == 2 and {"o_custkey", "o_orderdate"} in read, read
    assert "Subquery" in plan and not re.search(r"max\(y#\d+\) windowspec", plan)
