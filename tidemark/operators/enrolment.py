"""Snapshot analytics over a year-to-date (YTD) cumulative fact.

The fact carries ``enrol_year``, ``enrol_month``, member columns and YTD
measures.  YTD figures must never be summed across months (Q1): every total
pins one (year, month) or the latest month of each year.  Comparisons between
years use the same month (Q2).  "Latest month of a year" is either taken from
the rows that pass the member filter (``scope="filtered"``) or from the whole
fact (``scope="global"``) (Q3).

All operators aggregate first and join afterwards: the first aggregate combines
map-side, and what is joined is one row per year or per member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import pct_change

YEAR, MONTH = "enrol_year", "enrol_month"
YTD, COMMENCE = "ytd_enrolments", "ytd_commencements"


def empty_like(df: DataFrame) -> DataFrame:
    """an empty IN-list gives an empty frame of the same schema (no scan)."""
    return df.limit(0)


def latest_period(fact: DataFrame) -> DataFrame:
    """One row (enrol_year, enrol_month): max year, then the max month within it."""
    best = F.max(F.struct(F.col(YEAR), F.col(MONTH))).alias("p")
    return fact.agg(best).select(F.col(f"p.{YEAR}").alias(YEAR), F.col(f"p.{MONTH}").alias(MONTH))


def pin_latest(agg: DataFrame) -> DataFrame:
    """Add ``__cy``/``__cm``, the latest (year, month) present in ``agg``.

    ``agg`` is the fact already aggregated to (year, month, members), so the
    single-partition window below sees at most |periods| x |members| rows (a
    bound set by the dimensions, not by the fact), and the fact is read once
    instead of once for the scalar and once for the join.
    """
    latest = F.max(F.struct(F.col(YEAR), F.col(MONTH))).over(Window.partitionBy())
    return agg.withColumn("__lp", latest).select(
        "*", F.col(f"__lp.{YEAR}").alias("__cy"), F.col(f"__lp.{MONTH}").alias("__cm")
    ).drop("__lp")


def snapshot_totals(
    fact: DataFrame,
    year: int,
    month: int,
    by: Sequence[str],
    where: Column | None = None,
    measure: str = YTD,
    out: str = "total_enrolments",
) -> DataFrame:
    """A01/A02/A03 with F01/F02/F03: sum of one YTD measure at one (year, month)."""
    df = fact.where((F.col(YEAR) == F.lit(year)) & (F.col(MONTH) == F.lit(month)))
    if where is not None:
        df = df.where(where)
    return df.groupBy(*by).agg(F.sum(measure).cast("long").alias(out))


def snapshot_at_latest(
    fact: DataFrame,
    by: Sequence[str],
    where: Column | None = None,
    measure: str = YTD,
    out: str = "total_enrolments",
) -> DataFrame:
    """A01-A03 pinned to the latest period of the whole fact (the member filter
    does not move the period).  One aggregate with conditional sums, then the
    latest period picked from that aggregate."""
    hit = F.lit(True) if where is None else where
    agg = fact.groupBy(YEAR, MONTH, *by).agg(
        F.sum(F.when(hit, F.col(measure))).alias("__v"), F.count_if(hit).alias("__hit")
    )
    pinned = pin_latest(agg).where(
        (F.col(YEAR) == F.col("__cy")) & (F.col(MONTH) == F.col("__cm")) & (F.col("__hit") > 0)
    )
    return pinned.groupBy(*by).agg(F.sum("__v").cast("long").alias(out))


def latest_month_per_year(fact: DataFrame) -> DataFrame:
    """J01 building block: (enrol_year, latest_month), one row per year."""
    return fact.groupBy(YEAR).agg(F.max(MONTH).alias("latest_month"))


def at_latest_month_of_year(
    fact: DataFrame,
    by: Sequence[str] = (),
    where: Column | None = None,
    scope: str = "filtered",
    measures: dict[str, str] | None = None,
) -> DataFrame:
    """A04/A05 via J01: per year, the totals at that year's latest month.

    ``scope="filtered"``: the latest month is taken among rows passing
    ``where``; ``"global"``: among all rows, so a member absent from the global
    latest month of a year has no row for that year.

    Plan: one aggregate to (year, month, *by), combined map-side, then a window
    over each year of that aggregate (at most 12 x |by| rows per year, bounded
    by the dimensions, not by the fact).  The fact is read once, never joined
    to itself.
    """
    if scope not in ("filtered", "global"):
        raise ValueError("scope must be 'filtered' or 'global'")
    measures = measures or {"total_enrolments": YTD}
    w_year = Window.partitionBy(YEAR)
    if scope == "filtered":
        base = fact if where is None else fact.where(where)
        agg = base.groupBy(YEAR, MONTH, *by).agg(
            *[F.sum(src).cast("long").alias(name) for name, src in measures.items()]
        )
        picked = agg.withColumn("__latest", F.max(MONTH).over(w_year)).where(F.col(MONTH) == F.col("__latest"))
        return picked.drop("__latest")
    hit = F.lit(True) if where is None else where
    agg = fact.groupBy(YEAR, MONTH, *by).agg(
        *[F.sum(F.when(hit, F.col(src))).cast("long").alias(name) for name, src in measures.items()],
        F.count_if(hit).alias("__hit"),
    )
    picked = agg.withColumn("__latest", F.max(MONTH).over(w_year)).where(
        (F.col(MONTH) == F.col("__latest")) & (F.col("__hit") > 0)
    )
    return picked.drop("__latest", "__hit")


def country_growth(fact: DataFrame, current_year: int, current_month: int, prior_year: int) -> DataFrame:
    """J02 (X15): per nationality, current total and same-month prior total (0 when absent).

    One scan with conditional sums replaces the two aggregates and the left
    join; members present only in the prior year are dropped, as a left join
    from the current side would.
    """
    df = fact.where(F.col(YEAR).isin(current_year, prior_year) & (F.col(MONTH) == F.lit(current_month)))
    is_cur = F.col(YEAR) == F.lit(current_year)
    agg = df.groupBy("nationality").agg(
        F.count_if(is_cur).alias("__ncur"),
        F.sum(F.when(is_cur, F.col(YTD))).cast("long").alias("current_total"),
        F.coalesce(F.sum(F.when(~is_cur, F.col(YTD))), F.lit(0)).cast("long").alias("previous_total"),
    )
    return agg.where(F.col("__ncur") > 0).drop("__ncur")


def country_growth_latest(fact: DataFrame) -> DataFrame:
    """J02 at the fact's latest period against the same month a year earlier
    (one read of the fact; see :func:`pin_latest`)."""
    agg = fact.groupBy(YEAR, MONTH, "nationality").agg(F.sum(YTD).alias("__t"))
    p = pin_latest(agg).where(
        F.col(YEAR).between(F.col("__cy") - 1, F.col("__cy")) & (F.col(MONTH) == F.col("__cm"))
    )
    is_cur = F.col(YEAR) == F.col("__cy")
    out = p.groupBy("nationality").agg(
        F.count_if(is_cur).alias("__ncur"),
        F.sum(F.when(is_cur, F.col("__t"))).cast("long").alias("current_total"),
        F.coalesce(F.sum(F.when(~is_cur, F.col("__t"))), F.lit(0)).cast("long").alias("previous_total"),
    )
    return out.where(F.col("__ncur") > 0).drop("__ncur")


def growth_movers(growth: DataFrame, min_previous: int = 100, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """F14 + X17 + W05: growth % on a minimum base, top-n rising and top-n falling.

    Ties are broken by nationality so the cut is deterministic.
    """
    g = growth.where(F.col("previous_total") >= F.lit(min_previous)).withColumn(
        "growth_pct", pct_change("current_total", "previous_total")
    )
    top = g.orderBy(F.col("growth_pct").desc_nulls_last(), F.col("nationality")).limit(n)
    bottom = g.orderBy(F.col("growth_pct").asc_nulls_last(), F.col("nationality")).limit(n)
    return top, bottom


def kpi_block(fact: DataFrame) -> DataFrame:
    """Current total at the latest period, the same month a year before (its
    own aggregate, not derived from J02) and the YoY change; one read."""
    agg = fact.groupBy(YEAR, MONTH).agg(F.sum(YTD).alias("__t"))
    p = pin_latest(agg).where(
        F.col(YEAR).between(F.col("__cy") - 1, F.col("__cy")) & (F.col(MONTH) == F.col("__cm"))
    )
    is_cur = F.col(YEAR) == F.col("__cy")
    out = p.groupBy("__cy", "__cm").agg(
        F.sum(F.when(is_cur, F.col("__t"))).cast("long").alias("current_total"),
        F.sum(F.when(~is_cur, F.col("__t"))).cast("long").alias("same_month_last_year"),
    )
    return out.select(
        F.col("__cy").alias(YEAR),
        F.col("__cm").alias(MONTH),
        "current_total",
        "same_month_last_year",
        F.round(pct_change("current_total", "same_month_last_year"), 6).alias("yoy_pct"),
    )


def distinct_sorted(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    """Distinct non-null values of one column, sorted."""
    d = df if where is None else df.where(where)
    return d.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def snapshot_month_per_year(fact: DataFrame, month: int, measure: str = YTD, out: str = "total_enrolments") -> DataFrame:
    """J09 input: per year, the total at one fixed month (e.g. 12 = full year)."""
    return fact.where(F.col(MONTH) == F.lit(month)).groupBy(YEAR).agg(F.sum(measure).cast("long").alias(out))
