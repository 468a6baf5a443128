"""Source loaders (L05) composed from the operators: read the landed files,
tidy them into the target fact, publish.  Each returns the rows it loaded so
:func:`tidemark.operators.runs.run_sources` can isolate and summarise them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.shape import add_lineage, header_rows, grid_to_table
from tidemark.operators.windows import last_wins
from tidemark.sources import sinks
from tidemark.sources.readers import read_series_csv
from tidemark.sources.xlsx import read_grid

EXCHANGE_RATE_KEY = ["rate_date", "series_id"]


def load_exchange_rates(spark: SparkSession, landing: str, root: str, dry_run: bool = False) -> int:
    """RBA-style composition (S01, X05, X01, R02, P13, F09, W04, K01): series CSVs
    to fact_exchange_rate; a later file (by name) overrides an earlier one for
    the same (date, series)."""
    long = read_series_csv(spark, landing)
    fact = long.select(
        F.col("date").alias("rate_date"), "series_id", "value", "title", "units", "frequency",
        F.col("path").alias("__file"),
    ).dropna(subset=["rate_date", "series_id"])
    fact = last_wins(fact, EXCHANGE_RATE_KEY, "__file").drop("__file")
    fact = add_lineage(fact, "rba")
    res = sinks.upsert(spark, fact, root, "fact_exchange_rate", EXCHANGE_RATE_KEY, dry_run=dry_run)
    return res.rows_written


def load_workbook_table(
    spark: SparkSession, landing: str, root: str, table: str, hint: str, columns: Sequence[str],
    key: Sequence[str], fill: Sequence[str] = (), dry_run: bool = False,
) -> int:
    """Workbook composition (S06, P04, P01, R12, K04): every sheet's rows below its
    detected header, merged labels filled down, published as a full replace."""
    from tidemark.operators.windows import forward_fill

    grid = read_grid(spark, landing)
    hdr = header_rows(grid, hint=hint, min_nonnull=3)
    tidy = grid_to_table(grid, hdr, columns)
    if fill:
        tidy = forward_fill(tidy, ["path", "sheet"], "row_idx", fill)
    tidy = add_lineage(tidy.drop("row_idx"), table)
    res = sinks.replace_table(spark, tidy, root, table, list(key), dry_run=dry_run)
    return res.rows_written


def load_enrolment_grains(
    spark: SparkSession, basic: DataFrame, detailed: DataFrame, root: str,
    basic_key: Sequence[str], detailed_key: Sequence[str],
) -> tuple[int, int]:
    """The basic and the detailed enrolment releases are two grains of one
    population: each is validated on its own key and published to its own
    table; they are never unioned (a guard refuses a detailed key that is not
    strictly wider than the basic one)."""
    if not (set(basic_key) < set(detailed_key)):
        raise ValueError("the detailed key must strictly extend the basic key")
    b = sinks.replace_table(spark, basic, root, "fact_student_enrolment", list(basic_key))
    d = sinks.replace_table(spark, detailed, root, "fact_student_enrolment_detailed", list(detailed_key))
    return b.rows_written, d.rows_written


def table_counts(spark: SparkSession, root: str, tables: Sequence[str]) -> DataFrame:
    """One (table_name, rows) row per published table, as a UNION ALL of counts."""
    parts = []
    for t in tables:
        df = sinks.read_table(spark, root, t)
        if df is None:
            parts.append(spark.createDataFrame([(t, 0)], "table_name STRING, rows BIGINT"))
        else:
            parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table_name"), "rows"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def missing_tables(spark: SparkSession, root: str, required: Sequence[str]) -> list[str]:
    """Required tables that have no published version."""
    return [t for t in required if sinks.current_version(spark, root, t) is None]


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required columns absent from a frame (schema only, no job)."""
    return [c for c in required if c not in df.columns]


# ---------------------------------------------------------------------------
# Education enrolment releases

# Fixed conventions of the enrolment release sheets.
ENROLMENT_SKIP_SHEETS = ("note", "content", "glossary", "source", "readme")
ENROLMENT_HEADER_HINTS = r"year|month|nationality|sector|state"
ENROLMENT_SYNONYMS = {
    "ytd_enrolments": "data_ytd_enrolments",
    "enrolments": "data_ytd_enrolments",
    "ytd_commencements": "data_ytd_commencements",
    "commencements": "data_ytd_commencements",
    "providertype": "provider_type",
}
BASIC_COLUMNS = ("year", "month", "nationality", "state", "sector", "provider_type", "new_to_australia",
                 "ends_this_year", "data_ytd_enrolments", "data_ytd_commencements", "total")
DETAILED_COLUMNS = ("year", "month", "region", "nationality", "state", "provider_type", "sector",
                    "broad_field_of_education", "narrow_field_of_education", "detailed_field_of_education",
                    "level_of_study", "foundation", "new_to_australia", "ends_this_year", "data_ytd_enrolments",
                    "data_ytd_commencements", "data_as_at_1st_month", "data_enrolments_for_month",
                    "data_commencements_for_month", "total")
BASIC_KEY = ("enrol_year", "enrol_month", "nationality", "state_code", "sector", "provider_type",
             "new_to_australia", "ends_this_year")
DETAILED_KEY = BASIC_KEY + ("region", "broad_field", "narrow_field", "detailed_field", "level_of_study", "foundation")
_TARGET_NAMES = {
    "year": "enrol_year", "month": "enrol_month", "state": "state_code",
    "data_ytd_enrolments": "ytd_enrolments", "data_ytd_commencements": "ytd_commencements",
    "broad_field_of_education": "broad_field", "narrow_field_of_education": "narrow_field",
    "detailed_field_of_education": "detailed_field", "data_as_at_1st_month": "as_at_first_month",
    "data_enrolments_for_month": "monthly_enrolments", "data_commencements_for_month": "monthly_commencements",
}
_NUMERIC = {"data_ytd_enrolments", "data_ytd_commencements", "data_as_at_1st_month", "data_enrolments_for_month",
            "data_commencements_for_month", "total"}


def parse_enrolment_grid(grid: DataFrame, grain: str = "basic") -> DataFrame:
    """Enrolment sheets (any number, any header position) to the typed fact of
    one grain.  Month labels map to numbers (an unknown label is NULL and the
    row is dropped, never 0); counts are lenient numbers; the detailed
    release's ``total`` column repeats the YTD figure and is dropped (check it
    with :func:`tidemark.operators.quality.redundant_share` first)."""
    from tidemark.functions.scalars import lenient_double, month_number
    from tidemark.operators.filters import drop_empty_rows, drop_null_in, sheets_excluding

    cols = BASIC_COLUMNS if grain == "basic" else DETAILED_COLUMNS
    g = sheets_excluding(grid, ENROLMENT_SKIP_SHEETS)
    hdr = header_rows(g, hint=ENROLMENT_HEADER_HINTS, max_scan_rows=15)
    t = grid_to_table(g, hdr, cols, synonyms=ENROLMENT_SYNONYMS)
    t = drop_empty_rows(t, list(cols))
    typed = t.select(
        F.col("year").try_cast("double").cast("int").alias("year"),
        month_number("month").alias("month"),
        *[lenient_double(c).cast("long").alias(c) if c in _NUMERIC else F.trim(F.col(c)).alias(c)
          for c in cols if c not in ("year", "month")],
    )
    typed = drop_null_in(typed, ["year", "month"])
    if grain != "basic":
        typed = typed.drop("total")
    return typed.withColumnsRenamed({k: v for k, v in _TARGET_NAMES.items() if k in typed.columns})
