"""Window-shaped operators: YTD accumulation and de-accumulation, latest row per
group, forward fill, last-wins dedupe, percentile rank.

Every window here is partitioned by a key whose groups are small by
construction (one series, one year of one member, one sheet); none is an
un-partitioned window over a large input.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def accumulate_ytd(
    monthly: DataFrame,
    year: str,
    month: str,
    keys: Sequence[str],
    measures: Sequence[str],
    out_year: str | None = None,
    out_month: str | None = None,
    out_measures: Sequence[str] | None = None,
    periods: DataFrame | None = None,
) -> DataFrame:
    """Monthly flows to a densified year-to-date fact.

    A member appears at every published (year, month) of a year from its first
    month with data onwards, carrying the running total of that year (the
    shape of a cumulative statistical release).  Published periods are the
    (year, month) pairs at which any member has data.

    Plan: each monthly row is fanned out to the months it counts towards (at
    most 12, so the expansion is bounded), summed per (year, month, member) -
    combined map-side.  Periods nobody published are dropped before the fan-out is
    summed, by a semi join with ``periods`` (year and month, at most 12 rows a year),
    or where none is given with a window over (year, month) afterwards, which reads the
    input once and suits facts that are small once summed.
    """
    out_year = out_year or year
    out_month = out_month or month
    out_measures = list(out_measures or measures)
    keys = list(keys)
    fanned = monthly.select(
        year,
        *keys,
        *measures,
        F.col(month).alias("__origin"),
        F.explode(F.sequence(F.col(month), F.lit(12))).alias("__m"),
    )
    if periods is not None:
        out = periods.select(F.col(year), F.col(month).alias("__m"))
        return fanned.join(out, [year, "__m"], "left_semi").groupBy(year, "__m", *keys).agg(
            *[F.sum(F.coalesce(F.col(m), F.lit(0))).cast("long").alias(o) for m, o in zip(measures, out_measures)],
        ).select(F.col(year).cast("int").alias(out_year), F.col("__m").cast("int").alias(out_month), *keys, *out_measures)
    summed = fanned.groupBy(year, "__m", *keys).agg(
        *[F.sum(F.coalesce(F.col(m), F.lit(0))).cast("long").alias(o) for m, o in zip(measures, out_measures)],
        F.max(F.col("__origin") == F.col("__m")).alias("__has"),
    )
    published = F.max("__has").over(Window.partitionBy(year, "__m"))
    return summed.withColumn("__pub", published).where(F.col("__pub")).select(
        F.col(year).cast("int").alias(out_year),
        F.col("__m").cast("int").alias(out_month),
        *keys,
        *out_measures,
    )


def deaccumulate_ytd(df: DataFrame, year: str, month: str, keys: Sequence[str], ytd: str, out: str) -> DataFrame:
    """YTD to the monthly flow, ``ytd - lag(ytd)`` within one year of one member."""
    w = Window.partitionBy(year, *keys).orderBy(month)
    return df.withColumn(out, F.col(ytd) - F.coalesce(F.lag(ytd).over(w), F.lit(0)))


def ytd_decreases(df: DataFrame, year: str, month: str, keys: Sequence[str], ytd: str) -> DataFrame:
    """Rows where a YTD figure falls against the previous month of the same year."""
    w = Window.partitionBy(year, *keys).orderBy(month)
    prev = F.lag(ytd).over(w)
    return (
        df.select(year, month, *keys, ytd, prev.alias("prev_ytd"))
        .where(F.col("prev_ytd").isNotNull() & (F.col(ytd) < F.col("prev_ytd")))
    )


def trend_label(df: DataFrame, partition: Sequence[str], order: str, value: str, out: str = "trend") -> DataFrame:
    """UP / DOWN / STABLE against the previous period of the same series."""
    w = Window.partitionBy(*partition).orderBy(order)
    prev = F.lag(value).over(w)
    label = (
        F.when(prev.isNull() | F.col(value).isNull(), F.lit(None).cast("string"))
        .when(F.col(value) > prev, F.lit("UP"))
        .when(F.col(value) < prev, F.lit("DOWN"))
        .otherwise(F.lit("STABLE"))
    )
    return df.withColumn(out, label)


def latest_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = True) -> DataFrame:
    """The row of each group with the greatest (or least) ``order`` tuple.

    A hash aggregate of ``max(struct(order..., row))``: partial aggregation keeps
    one candidate per group per task, so a group holding a third of all rows is
    reduced map-side instead of being sorted whole in one task."""
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"__o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(f"__v_{c}") for c in others])
    pick = F.max(packed) if descending else F.min(packed)
    agg = df.groupBy(*keys).agg(pick.alias("__r"))
    return agg.select(*keys, *[F.col("__r")[f"__v_{c}"].alias(c) for c in others])


def last_wins(df: DataFrame, keys: Sequence[str], seq: str) -> DataFrame:
    """Keep, for each key, the row loaded last (highest ``seq``).

    Expressed as ``max_by`` in a hash aggregate: partial aggregation combines
    map-side, so a hot key is reduced before the shuffle instead of being sorted
    whole in one task as a ``row_number`` window would.
    """
    others = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c) for c in others])
    agg = df.groupBy(*keys).agg(F.max_by(packed, F.col(seq)).alias("__row"))
    return agg.select(*keys, *[F.col("__row")[c].alias(c) for c in others])


def forward_fill(
    df: DataFrame, partition: Sequence[str], order: str, columns: Sequence[str], chunk_rows: int = 1_000_000
) -> DataFrame:
    """Merged-cell labels carried down in row order, restarting per sheet.

    A sheet may be huge (a third of all rows), so the fill is done in two
    phases instead of one window over the whole sheet:

    1. rows are cut into chunks of ``chunk_rows`` consecutive positions; each
       chunk is filled on its own (a window over one chunk);
    2. the last label of every chunk (one row per chunk) gives, by a running
       window over the chunks of a sheet, the value carried into the next
       chunk; it fills what the chunk-local pass left empty.

    ``order`` must be an integer position (row index).
    """
    parts = list(partition)
    chunk = F.floor(F.col(order) / F.lit(chunk_rows)).alias("__chunk")
    d = df.withColumn("__chunk", chunk)
    w_local = Window.partitionBy(*parts, "__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = d.withColumns({f"__l_{c}": F.last(F.col(c), ignorenulls=True).over(w_local) for c in columns})
    # last non-null label per chunk: one row per chunk, reduced map-side
    summary = d.groupBy(*parts, "__chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"__s_{c}") for c in columns]
    )
    w_prev = Window.partitionBy(*parts).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *parts, "__chunk", *[F.last(F.col(f"__s_{c}"), ignorenulls=True).over(w_prev).alias(f"__c_{c}") for c in columns]
    )
    j = local.join(carry, [*parts, "__chunk"], "left")
    return j.select(
        *[F.coalesce(F.col(f"__l_{c}"), F.col(f"__c_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns]
    )


def percentile_rank(df: DataFrame, value: str, out: str, partition: Sequence[str] = ()) -> DataFrame:
    """Pandas ``rank(pct=True) * 100``: average rank of ties over the non-null
    count; NULL stays NULL.  Spark's ``percent_rank`` and ``cume_dist`` differ.

    Single pass of windows over ``df`` (no self-join, so the input plan is not
    recomputed).  Meant for per-entity frames (one row per country); every row
    of a partition meets in one task, so for ranking a large fact use
    :func:`percentile_rank_by_value_counts`.
    """
    parts = list(partition)
    v = F.col(value)
    order = Window.partitionBy(*parts).orderBy(v.asc_nulls_last())
    ties = Window.partitionBy(*parts, value)
    whole = Window.partitionBy(*parts)
    pr = (F.rank().over(order) + (F.count(F.lit(1)).over(ties) - F.lit(1)) / F.lit(2.0)) / F.count(v).over(
        whole
    ) * F.lit(100.0)
    return df.withColumn(out, F.when(v.isNotNull(), pr))


def percentile_rank_by_value_counts(
    df: DataFrame, value: str, out: str, partition: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """W01 for large inputs: rank the distinct values, not the rows.

    A per-value count (``groupBy(value)``, combined map-side, so a value held by
    a third of all rows is one row after the partial aggregate) is ranked by a
    running sum over the distinct values.  With a ``partition`` the running sum
    is a window per partition.  Without one, the distinct values are cut into
    ``buckets`` value ranges (by default one for every 100,000 distinct values, so a
    task's share does not grow with the data; boundaries from ``approxQuantile``: only the
    boundary numbers reach the driver); each range runs its own window, and a
    prefix over the per-range totals (one row per range) supplies the offset.
    No task ever holds all values.  The rank is joined back on the value.
    """
    parts = list(partition)
    counts = df.where(F.col(value).isNotNull()).groupBy(*parts, value).agg(F.count(F.lit(1)).alias("__n"))
    if parts:
        w_run = Window.partitionBy(*parts).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        w_all = Window.partitionBy(*parts)
        ranked = counts.select(
            *parts,
            value,
            (
                (F.sum("__n").over(w_run) - F.col("__n") + (F.col("__n") + F.lit(1)) / F.lit(2.0))
                / F.sum("__n").over(w_all)
                * F.lit(100.0)
            ).alias(out),
        )
        return df.join(ranked, [*parts, value], "left")
    if buckets is None:
        buckets = 1 + counts.count() // 100_000
    probs = [i / buckets for i in range(1, buckets)]
    bounds = sorted({b for b in counts.approxQuantile(value, probs, min(0.001, 0.2 / buckets)) if b is not None}) if probs else []
    arr = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<double>")
    bucket = F.size(F.filter(arr, lambda b: b < F.col(value)))
    c = counts.withColumn("__b", bucket)
    per = c.groupBy("__b").agg(F.sum("__n").alias("__bn"))  # one row per range
    prefix = per.select(
        "__b",
        F.coalesce(F.sum("__bn").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        .alias("__before"),
        F.sum("__bn").over(Window.partitionBy()).alias("__total"),
    )
    w_run = Window.partitionBy("__b").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = c.join(prefix, "__b").select(
        value,
        (
            (F.col("__before") + F.sum("__n").over(w_run) - F.col("__n") + (F.col("__n") + F.lit(1)) / F.lit(2.0))
            / F.col("__total")
            * F.lit(100.0)
        ).alias(out),
    )
    return df.join(ranked, [value], "left")
