"""Deterministic opportunity scoring and rule-based recommendations.

All arithmetic is column expressions; the percentile ranks come from
:func:`tidemark.operators.windows.percentile_rank`, which ranks distinct values
(one row per nationality here) rather than sorting the raw fact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scalars import pct_change, python_round
from tidemark.operators.enrolment import MONTH, YEAR, YTD, pin_latest
from tidemark.operators.windows import percentile_rank

# ---------------------------------------------------------------------------
# Component weights, thresholds and recommendation texts that the
# published scoring method defines.
WEIGHTS = {"growth": 0.40, "market_size": 0.35, "visa_pathway": 0.25}
GROWTH_THRESHOLD_STRONG = 10.0
GROWTH_THRESHOLD_DECLINE = -10.0
MSG_INSUFFICIENT = (
    "Insufficient historical data for a rule-based recommendation "
    "(requires at least two comparable years of enrolment data)."
)
MSG_STRONG_LARGE = (
    "Strong growth (+{g} YoY) in an already large market -- prioritize marketing investment and course capacity."
)
MSG_STRONG_EMERGING = "Strong growth (+{g} YoY) in an emerging market -- consider early investment ahead of scale."
MSG_DECLINING = "Declining market ({g} YoY) -- monitor closely and investigate cause before increasing investment."
MSG_STABLE = "Stable market ({g} YoY) -- maintain current marketing effort."
# Components never scored (no per-country linkage exists for them).
EXCLUDED_COMPONENTS = ("competition",)
# ---------------------------------------------------------------------------

def opportunity_inputs(fact: DataFrame, visa: DataFrame, visa_country: str = "country_name",
                       visa_value: str = "value") -> DataFrame:
    """B01 (A12, J06, X15, X17): one row per nationality at the latest period: current volume, growth %
    against the same month a year earlier (NULL without a non-zero base), and
    visa volume (NULL when the country has no visa record at all, never 0).

    Plan: the latest period is a one-row aggregate joined by equality; current
    and prior come from one conditional aggregate; visa volume is aggregated
    per country before the (left) join.
    """
    agg = fact.groupBy(YEAR, MONTH, "nationality").agg(F.sum(YTD).alias("__t"))
    snap = pin_latest(agg).where(
        F.col(YEAR).between(F.col("__cy") - 1, F.col("__cy")) & (F.col(MONTH) == F.col("__cm"))
    )
    is_cur = F.col(YEAR) == F.col("__cy")
    vols = snap.groupBy("nationality").agg(
        F.count_if(is_cur).alias("__ncur"),
        F.count_if(~is_cur).alias("__nprev"),
        F.sum(F.when(is_cur, F.col("__t"))).alias("current_volume"),
        F.sum(F.when(~is_cur, F.col("__t"))).alias("prior_volume"),
    ).where(F.col("__ncur") > 0)
    vols = vols.withColumn("prior_volume", F.when(F.col("__nprev") > 0, F.col("prior_volume")))
    visa_vol = (
        visa.where(F.col(visa_country).isNotNull())
        .groupBy(F.col(visa_country).alias("nationality"))
        .agg(F.sum(visa_value).alias("visa_volume"))
    )
    out = vols.join(visa_vol, "nationality", "left")
    return out.select(
        "nationality",
        F.col("current_volume").cast("long").alias("current_volume"),
        pct_change("current_volume", "prior_volume").alias("growth_pct"),
        F.col("visa_volume").cast("double").alias("visa_volume"),
    )


def opportunity_scores(inputs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Percentile-ranked components, weights of missing components spread
    over the present ones, score to 1 dp, confidence %, weights map; sorted by
    score descending with NULL last (T04)."""
    weights = dict(weights or WEIGHTS)
    for bad in EXCLUDED_COMPONENTS:
        weights.pop(bad, None)
    df = percentile_rank(inputs, "growth_pct", "growth_score")
    df = percentile_rank(df, "current_volume", "market_size_score")
    df = percentile_rank(df, "visa_volume", "visa_score")
    sources = {"growth": "growth_score", "market_size": "market_size_score", "visa_pathway": "visa_score"}
    present = {k: F.col(sources[k]).isNotNull() for k in weights}
    total_w: Column = sum((F.when(present[k], F.lit(w)).otherwise(F.lit(0.0)) for k, w in weights.items()), F.lit(0.0))
    weighted: Column = sum(
        (F.coalesce(F.col(sources[k]) * F.lit(w), F.lit(0.0)) for k, w in weights.items()), F.lit(0.0)
    )
    n_present: Column = sum((present[k].cast("int") for k in weights), F.lit(0))
    score = F.when(total_w > 0, python_round(weighted / total_w, 1))
    confidence = F.round(n_present.cast("double") / F.lit(float(len(weights))) * F.lit(100.0), 1)
    wmap = F.map_filter(
        F.create_map(
            *[x for k, w in weights.items() for x in (F.lit(k), F.when(present[k], F.round(F.lit(w) / total_w, 3)))]
        ),
        lambda k, v: v.isNotNull(),
    )
    out = df.select(
        *inputs.columns,
        "growth_score",
        "market_size_score",
        "visa_score",
        score.alias("opportunity_score"),
        confidence.alias("data_confidence_pct"),
        wmap.alias("weights_used"),
    )
    return out.orderBy(F.col("opportunity_score").desc_nulls_last(), F.col(inputs.columns[0]))


def weights_text(c: str = "weights_used") -> Column:
    """Stable text of a weights map: `key=value` pairs sorted by key, ';'-joined."""
    entries = F.array_sort(F.map_entries(F.col(c)))
    return F.array_join(
        F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), F.format_number(e["value"], 3))), ";"
    )


def recommendation(growth: Column, volume: Column, median: Column) -> Column:
    """Ordered rules on growth +/-10 % and the market median volume."""
    g1 = F.format_string("%.1f%%", growth)
    gs = F.format_string("%+.1f%%", growth)

    def fill(template: str, g: Column) -> Column:
        head, tail = template.split("{g}")
        return F.concat(F.lit(head), g, F.lit(tail))

    return (
        F.when(growth.isNull() | volume.isNull() | median.isNull(), F.lit(MSG_INSUFFICIENT))
        .when((growth >= GROWTH_THRESHOLD_STRONG) & (volume >= median), fill(MSG_STRONG_LARGE, g1))
        .when((growth >= GROWTH_THRESHOLD_STRONG) & (volume < median), fill(MSG_STRONG_EMERGING, g1))
        .when(growth <= GROWTH_THRESHOLD_DECLINE, fill(MSG_DECLINING, g1))
        .otherwise(fill(MSG_STABLE, gs))
    )


def median_of(df: DataFrame, column: str, out: str = "median_volume") -> DataFrame:
    """Exact, interpolated median (not an approximate percentile)."""
    return df.agg(F.median(column).alias(out))


def recommendations(inputs: DataFrame) -> DataFrame:
    """B03 over every nationality, against the median current volume."""
    # one row per nationality: the median is a window over that bounded frame,
    # so the inputs are not computed a second time for a scalar subquery
    med = F.median("current_volume").over(Window.partitionBy())
    return inputs.select(
        "nationality",
        "growth_pct",
        "current_volume",
        med.alias("median_volume"),
        recommendation(F.col("growth_pct"), F.col("current_volume"), med).alias("recommendation"),
    )


def sector_yoy(fact: DataFrame) -> DataFrame:
    """Sector totals at the latest period against the same month a year before;
    full outer (0-filled): a new sector has a NULL change, a vanished one -100.
    One read of the fact (see :func:`pin_latest`)."""
    agg = fact.groupBy(YEAR, MONTH, "sector").agg(F.sum(YTD).alias("__t"))
    snap = pin_latest(agg).where(
        F.col(YEAR).between(F.col("__cy") - 1, F.col("__cy")) & (F.col(MONTH) == F.col("__cm"))
    )
    is_cur = F.col(YEAR) == F.col("__cy")
    out = snap.groupBy("sector").agg(
        F.coalesce(F.sum(F.when(is_cur, F.col("__t"))), F.lit(0)).cast("long").alias("current_total"),
        F.coalesce(F.sum(F.when(~is_cur, F.col("__t"))), F.lit(0)).cast("long").alias("previous_total"),
    )
    return out.withColumn("yoy_pct", F.round(pct_change("current_total", "previous_total"), 6))
