"""Data-quality checks as DataFrames.

Every check is an aggregate that returns one row
``(check, table_name, observed, passed)``; a report is their union.  Nothing
is collected: a caller decides whether to act on ``passed``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import null_safe_key

CHECK_SCHEMA = "check STRING, table_name STRING, observed BIGINT, passed BOOLEAN"


def _row(agg: DataFrame, check: str, table: str, observed: Column, passed: Column) -> DataFrame:
    return agg.select(
        F.lit(check).alias("check"),
        F.lit(table).alias("table_name"),
        observed.cast("long").alias("observed"),
        passed.alias("passed"),
    )


def non_empty(df: DataFrame, table: str) -> DataFrame:
    """The table has at least one row."""
    agg = df.agg(F.count(F.lit(1)).alias("n"))
    return _row(agg, "non_empty", table, F.col("n"), F.col("n") > 0)


def null_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    """Rows with a NULL in any key column (expected 0)."""
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    agg = df.agg(F.count_if(any_null).alias("n"))
    return _row(agg, "null_keys", table, F.col("n"), F.col("n") == 0)


def duplicate_key_groups(df: DataFrame, keys: Sequence[str], blanks: Mapping[str, str] | None = None) -> DataFrame:
    """Key groups with more than one row; NULL key parts compare equal
    through their blank value (Q9)."""
    blanks = dict(blanks or {})
    cols = [null_safe_key(k, blanks[k]).alias(k) if k in blanks else F.col(k) for k in keys]
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str], blanks: Mapping[str, str] | None = None) -> DataFrame:
    """Number of duplicated key groups (expected 0)."""
    agg = duplicate_key_groups(df, keys, blanks).agg(F.count(F.lit(1)).alias("n"))
    return _row(agg, "duplicate_keys", table, F.col("n"), F.col("n") == 0)


def duplicate_rows_mask(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose (NULL-filled) key occurs more than once (keep=False)."""
    cols = [null_safe_key(k).alias(f"__k{i}") for i, k in enumerate(keys)]
    dup = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1)
    keyed = df.select("*", *cols)
    return keyed.join(dup, [f"__k{i}" for i in range(len(keys))], "left_semi").drop(
        *[f"__k{i}" for i in range(len(keys))]
    )


def orphans_count(child: DataFrame, parent: DataFrame, table: str, child_key: str, parent_key: str) -> DataFrame:
    """Child rows without a parent (expected 0)."""
    p = parent.select(F.col(parent_key).alias("__pk")).distinct()
    o = child.join(p, F.col(child_key) == F.col("__pk"), "left_anti")
    agg = o.agg(F.count(F.lit(1)).alias("n"))
    return _row(agg, "orphans", table, F.col("n"), F.col("n") == 0)


def distinct_count_equals(df: DataFrame, table: str, column: str, expected: int) -> DataFrame:
    """The number of distinct values of a column equals the expected count."""
    agg = df.agg(F.countDistinct(column).alias("n"))
    return _row(agg, f"distinct_{column}", table, F.col("n"), F.col("n") == expected)


def format_violations(df: DataFrame, table: str, column: str, pattern: str) -> DataFrame:
    """Values that are NULL, empty or do not match the pattern (expected 0)."""
    bad = F.col(column).isNull() | (F.trim(F.col(column)) == "") | ~F.col(column).rlike(pattern)
    agg = df.agg(F.count_if(bad).alias("n"))
    return _row(agg, f"format_{column}", table, F.col("n"), F.col("n") == 0)


def at_least(df: DataFrame, table: str, minimum: int) -> DataFrame:
    """The table holds at least ``minimum`` rows (seed minimum)."""
    agg = df.agg(F.count(F.lit(1)).alias("n"))
    return _row(agg, f"at_least_{minimum}", table, F.col("n"), F.col("n") >= minimum)


def in_range(df: DataFrame, table: str, column: str, lo: float | None, hi: float | None) -> DataFrame:
    """Values outside [lo, hi] (expected 0); NULLs are not counted."""
    c = F.col(column)
    out = F.lit(False)
    if lo is not None:
        out = out | (c < F.lit(lo))
    if hi is not None:
        out = out | (c > F.lit(hi))
    agg = df.agg(F.count_if(out).alias("n"))
    return _row(agg, f"range_{column}", table, F.col("n"), F.col("n") == 0)


def grain_guard(df: DataFrame, narrow: Sequence[str], wide: Sequence[str]) -> DataFrame:
    """Share of rows that collide on a narrower key, and whether the wider key
    is unique.  ``colliding_rows`` counts rows whose narrow key occurs more than
    once (the duplicate mask, as a loader's key check sees it).

    When the narrow key is part of the wide key the input is read once: counts
    per wide key (combined map-side) are rolled up to the narrow key.
    """
    if not set(narrow) <= set(wide):
        nk = df.groupBy(*[null_safe_key(k).alias(k) for k in narrow]).agg(F.count(F.lit(1)).alias("n"))
        narrow_stats = nk.agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0))).alias("colliding_rows"),
        )
        wk = df.groupBy(*[null_safe_key(k).alias(k) for k in wide]).agg(F.count(F.lit(1)).alias("n"))
        wide_stats = wk.agg(F.count_if(F.col("n") > 1).alias("wide_duplicate_groups"))
        j = narrow_stats.select("*", wide_stats.scalar().alias("wide_duplicate_groups"))
    else:
        wk = df.groupBy(*[null_safe_key(k).alias(k) for k in wide]).agg(F.count(F.lit(1)).alias("n"))
        nk = wk.groupBy(*narrow).agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 1).alias("wd"))
        j = nk.agg(
            F.sum("n").alias("rows"),
            F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0))).alias("colliding_rows"),
            F.sum("wd").alias("wide_duplicate_groups"),
        )
    return j.select(
        F.col("rows").cast("long").alias("rows"),
        F.col("colliding_rows").cast("long").alias("colliding_rows"),
        F.round(F.col("colliding_rows") / F.col("rows") * 100, 6).alias("colliding_pct"),
        (F.col("wide_duplicate_groups") == 0).alias("wide_key_unique"),
    )


def redundant_share(df: DataFrame, a: str, b: str) -> DataFrame:
    """Percentage of rows where two columns agree (NULL-safe)."""
    agg = df.agg(F.count_if(F.col(a).eqNullSafe(F.col(b))).alias("same"), F.count(F.lit(1)).alias("rows"))
    return agg.select("same", "rows", F.round(F.col("same") / F.col("rows") * 100, 6).alias("same_pct"))


def nulls_per_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULL count of every column in one aggregate, as (column_name, nulls)."""
    cols = list(columns or df.columns)
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column_name", "nulls")


def all_null_columns(df: DataFrame, table: str) -> DataFrame:
    """The columns of a table with rows that hold no value at all, as (table_name,
    column_name, rows); counted in one aggregate."""
    wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    long = wide.unpivot(["__rows"], list(df.columns), "column_name", "filled")
    return long.where((F.col("filled") == 0) & (F.col("__rows") > 0)).select(
        F.lit(table).alias("table_name"), "column_name", F.col("__rows").alias("rows"))


def known_empty(df: DataFrame, table: str, registry: Mapping[str, str]) -> DataFrame:
    """(table, rows, known_empty, reason): an empty table listed in the registry
    is explained rather than failed."""
    agg = df.agg(F.count(F.lit(1)).alias("n"))
    reason = registry.get(table)
    return agg.select(
        F.lit(table).alias("table_name"),
        F.col("n").cast("long").alias("rows"),
        F.lit(table in registry).alias("known_empty"),
        F.lit(reason).cast("string").alias("reason"),
        ((F.col("n") > 0) | F.lit(table in registry)).alias("passed"),
    )


def count_delta(before: DataFrame, after: DataFrame, tolerance_pct: float = 0.0) -> DataFrame:
    """Per table, rows before and after a rerun (or dry run vs load), the
    delta and whether it is within tolerance.  Inputs are (table_name, rows)."""
    b = before.select("table_name", F.col("rows").alias("rows_before"))
    a = after.select("table_name", F.col("rows").alias("rows_after"))
    j = b.join(a, "table_name", "full")
    delta = F.coalesce(F.col("rows_after"), F.lit(0)) - F.coalesce(F.col("rows_before"), F.lit(0))
    ok = F.abs(delta) <= F.coalesce(F.col("rows_before"), F.lit(0)) * F.lit(tolerance_pct / 100.0)
    return j.select("table_name", "rows_before", "rows_after", delta.alias("delta"), ok.alias("passed"))


def published_counts(spark, root: str, commit_number: int | None = None) -> DataFrame:
    """(table_name, rows) of every table live now, or as of a commit: one count each, united."""
    from tidemark.sources import sinks

    state = sinks.live_tables(spark, root) if commit_number is None else sinks.tables_at(spark, root, commit_number)
    out = spark.createDataFrame([], "table_name STRING, rows BIGINT")
    for name in sorted(state):
        df = sinks.read_table(spark, root, name, commit_number=commit_number)
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows"))
    return out


def rerun_check(spark, root: str, load: Callable[[], object], tolerance_pct: float = 0.0) -> DataFrame:
    """What ``load`` publishes under ``root``, run twice: rows of every table after the first run
    and after the second, the delta and whether it is within tolerance.  Both counts are of published versions."""
    from tidemark.sources import sinks

    load()
    first = sinks.last_commit(spark, root)
    load()
    return count_delta(published_counts(spark, root, first), published_counts(spark, root), tolerance_pct)


def report(checks: Sequence[DataFrame]) -> DataFrame:
    """One frame of all check rows."""
    out = checks[0]
    for c in checks[1:]:
        out = out.unionByName(c)
    return out


def keyed_table_checks(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    blanks: Mapping[str, str] | None = None,
    distinct: tuple[str, int] | None = None,
    formats: Mapping[str, str] | None = None,
) -> DataFrame:
    """G01 + G02 + G03 (+ G05, G06 on key columns) from one grouped pass.

    The table is grouped once by its (NULL-safe) key; the per-key counts give
    the row count, the rows with a NULL key part, the duplicated keys, the
    distinct count of one key column and the rows whose key column breaks a
    format.  The single stats row is turned into check rows by exploding an
    array, so the table is read once for all of them.
    """
    blanks = dict(blanks or {})
    formats = dict(formats or {})
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    grouped = df.groupBy(*[null_safe_key(k, blanks[k]).alias(k) if k in blanks else F.col(k) for k in keys]).agg(
        F.count(F.lit(1)).alias("__n"), F.count_if(any_null).alias("__nn")
    )
    aggs = [F.sum("__n").alias("rows"), F.sum("__nn").alias("null_rows"), F.count_if(F.col("__n") > 1).alias("dups")]
    if distinct:
        aggs.append(F.countDistinct(distinct[0]).alias("distinct"))
    for i, (c, pattern) in enumerate(formats.items()):
        bad = F.col(c).isNull() | (F.trim(F.col(c)) == "") | ~F.col(c).rlike(pattern)
        aggs.append(F.sum(F.when(bad, F.col("__n")).otherwise(F.lit(0))).alias(f"fmt{i}"))
    stats = grouped.agg(*aggs)

    def row(check: str, observed: Column, passed: Column) -> Column:
        return F.struct(F.lit(check).alias("check"), F.coalesce(observed, F.lit(0)).cast("long").alias("observed"),
                        passed.alias("passed"))

    rows_ = F.coalesce(F.col("rows"), F.lit(0))
    items = [
        row("non_empty", rows_, rows_ > 0),
        row("null_keys", F.col("null_rows"), F.coalesce(F.col("null_rows"), F.lit(0)) == 0),
        row("duplicate_keys", F.col("dups"), F.col("dups") == 0),
    ]
    if distinct:
        items.append(row(f"distinct_{distinct[0]}", F.col("distinct"), F.col("distinct") == distinct[1]))
    for i, c in enumerate(formats):
        items.append(row(f"format_{c}", F.col(f"fmt{i}"), F.coalesce(F.col(f"fmt{i}"), F.lit(0)) == 0))
    out = stats.select(F.explode(F.array(*items)).alias("r"))
    return out.select(F.col("r.check").alias("check"), F.lit(table).alias("table_name"), "r.observed", "r.passed")
