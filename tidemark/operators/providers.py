"""Provider landscape: counts by state, course joins, orphans, competition density."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import safe_ratio


def count_by(df: DataFrame, key: str, out: str, drop_null: bool = True) -> DataFrame:
    """A10: rows per key (NULL keys dropped), largest first."""
    d = df.where(F.col(key).isNotNull()) if drop_null else df
    return d.groupBy(key).agg(F.count(F.lit(1)).alias(out)).orderBy(F.col(out).desc(), F.col(key))


def table_count(df: DataFrame, out: str = "n") -> DataFrame:
    """Whole-table row count as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(out))


def courses_by_state(course: DataFrame, provider: DataFrame) -> DataFrame:
    """Courses counted by their provider's state (inner join)."""
    p = provider.select("provider_id", "state_code").where(F.col("state_code").isNotNull())
    j = course.select("provider_id").join(p, "provider_id", "inner")
    return j.groupBy("state_code").agg(F.count(F.lit(1)).alias("course_count"))


def courses_by_provider(course: DataFrame, provider: DataFrame, top_n: int = 20) -> DataFrame:
    """J03 + T02: top-N providers by course count (ties by name, then state)."""
    p = provider.select("provider_id", "provider_name", "state_code")
    j = course.select("provider_id").join(p, "provider_id", "inner")
    g = j.groupBy("provider_name", "state_code").agg(F.count(F.lit(1)).alias("course_count"))
    return g.orderBy(F.col("course_count").desc(), F.col("provider_name"), F.col("state_code").asc_nulls_last()).limit(
        top_n
    )


def competition_density(provider: DataFrame, course: DataFrame) -> DataFrame:
    """B05 (J07 + X18): providers and courses per state, full outer, 0-filled,
    courses per provider (NULL where a state has no provider)."""
    provs = provider.where(F.col("state_code").isNotNull()).groupBy("state_code").agg(
        F.count(F.lit(1)).alias("provider_count")
    )
    courses = courses_by_state(course, provider)
    j = provs.join(courses, "state_code", "full").na.fill(0, ["provider_count", "course_count"])
    return j.withColumn("courses_per_provider", safe_ratio("course_count", "provider_count"))


def competition_extremes(density: DataFrame) -> DataFrame:
    """The states with the highest and the lowest courses per provider."""
    d = density.where(F.col("courses_per_provider").isNotNull())
    return d.agg(
        F.max_by("state_code", F.struct("courses_per_provider", "state_code")).alias("highest_competition_state"),
        F.max("courses_per_provider").alias("highest_courses_per_provider"),
        F.min_by("state_code", F.struct("courses_per_provider", "state_code")).alias("lowest_competition_state"),
        F.min("courses_per_provider").alias("lowest_courses_per_provider"),
    )


def course_locations(course: DataFrame, bridge: DataFrame, location: DataFrame) -> DataFrame:
    """Courses to their delivery locations through the bridge (two equi-joins)."""
    b = bridge.select("cricos_code", "location_id")
    loc = location.select("location_id", "location_name", F.col("state_code").alias("location_state"))
    return course.select("cricos_code", "course_name").join(b, "cricos_code").join(loc, "location_id")
