"""Macro-indicator operators: yearly means and sums of long series, alignment with
the enrolment trend, coverage gaps and a guarded correlation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import left_year


def yearly_mean_by_date(
    df: DataFrame, date_col: str, value: str, out: str, where: Column | None = None
) -> DataFrame:
    """AVG(value) grouped by YEAR(date) (optionally one series / frequency, F01)."""
    d = df if where is None else df.where(where)
    return d.groupBy(F.year(date_col).alias("year")).agg(F.avg(value).alias(out))


def yearly_by_period_prefix(
    df: DataFrame, period_col: str, value: str, out: str, how: str = "avg", where: Column | None = None
) -> DataFrame:
    """A08 (mean) / A09 (sum): grouped by LEFT(period, 4)."""
    d = df if where is None else df.where(where)
    fn = {"avg": F.avg, "sum": F.sum}[how]
    return d.groupBy(left_year(period_col).alias("year")).agg(fn(value).alias(out))


def aggregate_or_member(df: DataFrame, column: str, member: str | None = None, total_label: str = "Total") -> DataFrame:
    """the aggregate label row when no member is asked for, else that member (Q6)."""
    return df.where(F.col(column) == F.lit(member if member is not None else total_label))


def distinct_like(df: DataFrame, column: str, patterns: Sequence[str], case_insensitive: bool = False) -> DataFrame:
    """F05 + A13: distinct values matching any LIKE pattern, sorted."""
    c = F.col(column)
    cond = None
    for p in patterns:
        m = c.ilike(p) if case_insensitive else c.like(p)
        cond = m if cond is None else cond | m
    return df.where(cond).select(column).distinct().orderBy(column)


def align_years(left: DataFrame, right: DataFrame, year: str = "year", how: str = "full") -> DataFrame:
    """Two yearly series side by side on the year text; ``full`` keeps gaps."""
    lk = left.withColumn(year, F.col(year).cast("string"))
    rk = right.withColumn(year, F.col(year).cast("string"))
    return lk.join(rk, [year], how)


def coverage_gaps(left: DataFrame, right: DataFrame, year: str = "year") -> DataFrame:
    """Years only in the left series and years only in the right series."""
    lk = left.select(F.col(year).cast("string").alias(year)).distinct()
    rk = right.select(F.col(year).cast("string").alias(year)).distinct()
    return lk.exceptAll(rk).withColumn("only_in", F.lit("left")).unionByName(
        rk.exceptAll(lk).withColumn("only_in", F.lit("right"))
    )


def guarded_corr(pairs: DataFrame, x: str, y: str, min_pairs: int = 3) -> DataFrame:
    """Pearson correlation over complete pairs; NULL below ``min_pairs`` pairs or
    when either side is constant (ANSI ``corr`` would raise on a zero variance)."""
    complete = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    xs, ys = F.col(x).cast("double"), F.col(y).cast("double")
    agg = complete.agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.stddev_pop(xs).alias("__sx"),
        F.stddev_pop(ys).alias("__sy"),
        F.covar_pop(xs, ys).alias("__cov"),
    )
    ok = (F.col("n_pairs") >= min_pairs) & (F.col("__sx") > 0) & (F.col("__sy") > 0)
    corr = F.when(ok, F.col("__cov") / (F.col("__sx") * F.col("__sy")))
    return agg.select("n_pairs", corr.alias("correlation"))


def guarded_sum(
    df: DataFrame, by: Sequence[str], value: str, out: str, measure_col: str = "measure", measure: str | None = None
) -> DataFrame:
    """P23 + A20: dynamic group-by sum that refuses to add up rates.

    Summing a ``*_pct`` measure, or summing over several measures at once, is a
    planning error; it is caught here on the driver before any job runs.
    """
    if measure is not None:
        if measure.endswith("_pct"):
            raise ValueError(f"refusing to sum rate measure {measure!r}")
        df = df.where(F.col(measure_col) == F.lit(measure))
    elif measure_col in df.columns and measure_col not in by:
        raise ValueError("sum over mixed measures: filter one measure or group by it")
    return df.groupBy(*by).agg(F.sum(value).alias(out))
