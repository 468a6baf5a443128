"""Reshape operators: unpivot, EAV, pivots, forward fill, unions.

Unpivot is ``DataFrame.unpivot`` (a narrow Expand, no shuffle); pivots are
grouped aggregates with a fixed value list so the output schema is known
without a pass over the data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import lenient_double


def unpivot_columns(
    df: DataFrame, ids: Sequence[str], values: Sequence[str] | None, name: str, value: str
) -> DataFrame:
    """Wide columns to long rows; ``values=None`` unpivots every
    non-id column (R05)."""
    vals = [c for c in df.columns if c not in ids] if values is None else list(values)
    return df.unpivot(list(ids), vals, name, value)


def year_columns(columns: Sequence[str], pattern: str = r"^\d{4}") -> list[str]:
    """the columns whose names look like a year (driver-side on the schema)."""
    import re

    rx = re.compile(pattern)
    return [c for c in columns if rx.match(c)]


def wide_to_eav(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    measure_by_dimension: Mapping[str, str],
    profile_year: str | None = None,
) -> DataFrame:
    """Wide sheet to (entity, measure, dimension, value_num, value_text)."""
    from tidemark.operators.joins import map_lookup

    long = df.select(*ids, *[F.col(c).cast("string").alias(c) for c in values]).unpivot(
        list(ids), list(values), "dimension", "value_text"
    )
    return long.select(
        *ids,
        map_lookup("dimension", measure_by_dimension).alias("profile_measure"),
        "dimension",
        lenient_double("value_text").alias("value_num"),
        "value_text",
        F.lit(profile_year).cast("string").alias("profile_year"),
    )


def eav_to_columns(df: DataFrame, keys: Sequence[str], dimension: str, value: str, picks: Sequence[str]) -> DataFrame:
    """Chosen EAV dimensions as columns (one aggregate, fixed column list)."""
    return df.groupBy(*keys).agg(
        *[F.max(F.when(F.col(dimension) == F.lit(p), F.col(value))).alias(p) for p in picks]
    )


def pivot_zero_fill(
    df: DataFrame, rows: Sequence[str], pivot_col: str, pivot_values: Sequence[str], value: str,
    total_col: str = "grand_total",
) -> DataFrame:
    """Pivot with zero fill and a row grand total; NULL row keys are dropped
    (as a pandas pivot_table drops them)."""
    clean = df.where(F.col(pivot_col).isNotNull())
    for r in rows:
        clean = clean.where(F.col(r).isNotNull())
    wide = clean.groupBy(*rows).pivot(pivot_col, list(pivot_values)).agg(F.sum(value)).na.fill(0, list(pivot_values))
    total: Column = sum((F.col(f"`{v}`") for v in pivot_values), F.lit(0))
    return wide.withColumn(total_col, total)


def conditional_pivot_last_wins(
    df: DataFrame,
    key: str,
    pivot_col: str,
    pivot_values: Sequence[str],
    measures: Mapping[str, str],
    seq: str,
    where: Column | None = None,
) -> DataFrame:
    """One row per key with ``<prefix><value>`` columns per measure; among
    several qualifying rows the last one (highest ``seq``) wins.

    ``measures`` maps a source column to an output pattern containing ``{v}``
    (for example ``{"ceiling": "ceiling_{v}"}``).  One grouped aggregate with
    ``max_by``; no pivot pass to discover values (they are fixed).
    """
    d = df if where is None else df.where(where)
    aggs = []
    for v in pivot_values:
        hit = F.col(pivot_col) == F.lit(v)
        for src, pattern in measures.items():
            aggs.append(F.max_by(F.when(hit, F.col(src)), F.when(hit, F.col(seq))).alias(pattern.format(v=v)))
    return d.groupBy(key).agg(*aggs)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Concatenate by column name, missing columns as NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def label_and_union(frames: Mapping[str, DataFrame], label_col: str = "measure") -> DataFrame:
    """Several sources to one long fact, each tagged with its measure label."""
    return union_by_name([f.withColumn(label_col, F.lit(k)) for k, f in frames.items()])


def crosstab_to_long(df: DataFrame, row_dim: str, col_dim: str, value: str) -> DataFrame:
    """A two-dimensional cross-tab (rows = one dimension, one column per value
    of the other) to ``(dim1, dim2, value)``; empty cells are dropped."""
    cols = [c for c in df.columns if c != row_dim]
    long = df.select(F.col(row_dim), *[F.col(f"`{c}`").cast("double").alias(c) for c in cols]).unpivot(
        [row_dim], cols, col_dim, value
    )
    return long.where(F.col(value).isNotNull())


def crosstab_periods_to_long(df: DataFrame, ids: Sequence[str], value: str, period: str = "period") -> DataFrame:
    """A country x period cross-tab whose period headers were mangled by name
    normalising (``2006_07``, ``2006``) to long rows with the period rebuilt
    (``2006-07``, ``2006``).  Only header columns that look like periods (F15)
    are unpivoted."""
    from tidemark.functions.scalars import header_period

    cols = year_columns([c for c in df.columns if c not in ids])
    long = df.unpivot(list(ids), cols, "__hdr", value)
    return long.select(*ids, header_period("__hdr").alias(period), value).where(F.col(value).isNotNull())
