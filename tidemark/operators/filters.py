"""Row filters used while tidying releases."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_equal(df: DataFrame, **params) -> DataFrame:
    """equality on bound parameters; F02: a parameter given as ``None`` adds
    no predicate; F03: a list or tuple becomes an IN list (empty list -> empty
    frame of the same schema)."""
    out = df
    for col, val in params.items():
        if val is None:
            continue
        if isinstance(val, (list, tuple, set, frozenset)):
            if not val:
                return df.limit(0)
            out = out.where(F.col(col).isin(*sorted(val)))
        else:
            out = out.where(F.col(col) == F.lit(val))
    return out


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    """``IS NOT NULL`` on each column."""
    out = df
    for c in columns:
        out = out.where(F.col(c).isNotNull())
    return out


def like_any(c: str, patterns: Sequence[str], case_insensitive: bool = False) -> Column:
    """LIKE patterns ORed (``ilike`` when case-insensitive, as the source
    collation was)."""
    col = F.col(c)
    cond = F.lit(False)
    for p in patterns:
        cond = cond | (col.ilike(p) if case_insensitive else col.like(p))
    return cond


def matches(c: str, pattern: str) -> Column:
    """regular-expression predicate (e.g. numeric text, ISO date, 6-digit code)."""
    return F.coalesce(F.col(c).rlike(pattern), F.lit(False))


SIX_DIGIT_CODE = r"^\d{6}$"
NUMERIC_TEXT = r"^[0-9]+(\.[0-9]+)?$"
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def drop_empty_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """rows where every (given) column is NULL are dropped."""
    return df.dropna(how="all", subset=list(columns) if columns else None)


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """columns that are NULL in every row are dropped; one aggregate counts
    the non-null cells of every column and only that row reaches the driver."""
    if not df.columns:
        return df
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)]).first()
    keep = [c for i, c in enumerate(df.columns) if counts[f"c{i}"]]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def drop_null_in(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """rows with a NULL in any of ``subset`` are dropped."""
    return df.dropna(how="any", subset=list(subset))


def exclude_totals(df: DataFrame, columns: Sequence[str], token: str = "Total") -> DataFrame:
    """rows whose label contains ``token`` in any of ``columns`` are dropped;
    a NULL label is kept."""
    out = df
    for c in columns:
        out = out.where(F.col(c).isNull() | ~F.col(c).contains(token))
    return out


def positive(df: DataFrame, column: str) -> DataFrame:
    """strictly positive counts only."""
    return df.where(F.col(column) > 0)


def sheets_excluding(df: DataFrame, tokens: Sequence[str], sheet_col: str = "sheet") -> DataFrame:
    """drop sheets whose (lower-cased) name holds any of the tokens."""
    rx = "|".join(t.lower() for t in tokens)
    return df.where(~F.lower(F.col(sheet_col)).rlike(rx))


def sheets_matching(df: DataFrame, tokens: Sequence[str], sheet_col: str = "sheet") -> DataFrame:
    """keep sheets whose name holds any of the tokens."""
    rx = "|".join(t.lower() for t in tokens)
    return df.where(F.lower(F.col(sheet_col)).rlike(rx))


def minimum_base(df: DataFrame, column: str, minimum: float) -> DataFrame:
    """rows whose base volume reaches ``minimum`` (before ranking growth)."""
    return df.where(F.col(column) >= F.lit(minimum))


NATIONAL_LABELS = ("NATIONAL", "ALL", "", "NAN")


def national_only(df: DataFrame, state_col: str = "state", labels: Sequence[str] = NATIONAL_LABELS) -> DataFrame:
    """F16: national rows: the state is NULL or one of the national labels."""
    s = F.upper(F.trim(F.col(state_col)))
    return df.where(F.col(state_col).isNull() | s.isin(*labels))


def route_sheet(sheet: Column, routes: Mapping[str, str]) -> Column:
    """Entity of a sheet by the first substring rule that matches its name
    (order matters: 'course location' must be tested before 'course')."""
    name = F.lower(sheet)
    out = F.lit(None).cast("string")
    for needle, entity in reversed(list(routes.items())):
        out = F.when(name.contains(needle), F.lit(entity)).otherwise(out)
    return out


# Fixed routing rules of the provider register workbook, in priority order.
PROVIDER_SHEET_ROUTES = {
    "institution": "provider",
    "provider": "provider",
    "course location": "course_location",
    "course": "course",
    "location": "location",
}
