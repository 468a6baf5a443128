"""Header detection, column naming and projection.

Two kinds of operator live here:

* schema-level helpers that run on the driver over ``df.columns`` only (no
  data is touched): name normalising, conditional rename, keep-if-present,
  keyword role assignment, required-column checks, layout sniffing;
* grid operators over the untyped sheet grid ``(path, sheet, row_idx,
  cells)``: header detection per sheet as one aggregate, and the projection of
  data rows below the header into named columns.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import norm_name_expr


# ---------------------------------------------------------------------------
# Driver-side schema helpers


def norm_col(name: str) -> str:
    """Trim, lower, runs of characters outside [a-z0-9] to '_', strip '_'."""
    return re.sub(r"[^a-z0-9]+", "_", name.strip().lower()).strip("_")


def normalise_columns(df: DataFrame) -> DataFrame:
    """P01 over every column name."""
    return df.toDF(*[norm_col(c) for c in df.columns])


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> tuple[DataFrame, list[str]]:
    """Rename only the columns that exist; report the skipped ones."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    skipped = [k for k in mapping if k not in df.columns]
    return df.withColumnsRenamed(present), skipped


def keep_present(df: DataFrame, wanted: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Project the wanted columns that exist; report the missing ones."""
    keep = [c for c in wanted if c in df.columns]
    return df.select(*keep), [c for c in wanted if c not in df.columns]


def rename_with_fallback(df: DataFrame, synonyms: Mapping[str, Sequence[str]]) -> DataFrame:
    """For each target, rename the first synonym present (use B as A only
    when A itself is absent)."""
    out = df
    for target, names in synonyms.items():
        if target in out.columns:
            continue
        for n in names:
            if n in out.columns:
                out = out.withColumnRenamed(n, target)
                break
    return out


def assign_roles(
    columns: Sequence[str], rules: Sequence[tuple[str, Sequence[str | Sequence[str]]]], on_collision: str = "skip",
    repeatable: Sequence[str] = (),
) -> dict[str, str]:
    """Keyword role assignment, column by column: a column takes the first rule
    that matches it (case-insensitive).  A rule is a list of alternatives; a plain one is
    a text the name contains, one starting with ``=`` is the whole name, and a tuple
    asks for all of its parts.  A role is given once, to the first column
    (``on_collision="skip"``), a second column for it being an error with ``"error"``; with
    ``"allow"``, and for ``repeatable`` roles, every matching column takes it.
    """
    def holds(part: str | Sequence[str], name: str) -> bool:
        if not isinstance(part, str):
            return all(holds(p, name) for p in part)
        return name == part[1:].lower() if part.startswith("=") else part.lower() in name

    roles: dict[str, str] = {}
    given: dict[str, str] = {}
    for c in columns:
        matching = [role for role, alternatives in rules if any(holds(a, c.lower()) for a in alternatives)]
        if not matching:
            continue
        role = matching[0]
        if on_collision == "error" and (len(set(matching)) > 1 or role in given):
            raise ValueError(f"column {c!r} matches roles {matching}" if len(set(matching)) > 1
                             else f"columns {given[role]!r} and {c!r} match role {role!r}")
        if role in given and on_collision != "allow" and role not in repeatable:
            continue
        given.setdefault(role, c)
        roles[c] = role
    return roles


def add_defaults(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Constant columns added only when absent."""
    add = {k: F.lit(v) for k, v in defaults.items() if k not in df.columns}
    return df.withColumns(add) if add else df


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise naming every missing column, before any action runs."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def is_long_layout(columns: Sequence[str], value_names: Sequence[str] = ("count", "value", "eoi_count")) -> bool:
    """Already long (has a value column) or a cross-tab to unpivot."""
    lc = {c.lower() for c in columns}
    return any(v in lc for v in value_names)


def add_lineage(df: DataFrame, source: str, with_file: bool = False) -> DataFrame:
    """`_etl_source`, `_etl_loaded_at` (and the file name when read from files)."""
    cols = {"_etl_source": F.lit(source), "_etl_loaded_at": F.current_timestamp()}
    if with_file:
        cols["_etl_file"] = F.col("_metadata.file_name")
    return df.withColumns(cols)


#: Fixed words of measure names.
VALUE_KEYWORDS = ("total", "sum of", "count", "enrolment", "enrollment", "grant", "grants", "data", "value", "values")


#: The forms of text that a cast to double may take; it decides on what matches.  Other text costs no failed parse.
NUMBER_TEXT = (r"^[\x00-\x20]*[+-]?(?:(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?[dDfF]?"
               r"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][+-]?[0-9]+[dDfF]?|(?i:nan|inf|infinity))[\x00-\x20]*$")


def _number_count(name: str, kind: T.DataType) -> Column:
    """How many of a column's values read as numbers: all that are there of a numeric one, none of dates, times and booleans."""
    c = F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return F.count(c)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
        return F.count(F.lit(None))
    text = c.cast("string")
    return F.count(F.when(text.rlike(NUMBER_TEXT), text.try_cast("double")))


def detect_value_column(df: DataFrame, keywords: Sequence[str] = VALUE_KEYWORDS) -> str | None:
    """The measure column: ``Total`` when present, else among the columns that hold any
    number the one with the most keyword hits, then the most numbers; the first column on
    ties, ``None`` where no column holds a number.  One aggregate counts the numbers of
    every column; only that one row reaches the driver."""
    if "Total" in df.columns:
        return "Total"
    if not df.columns:
        return None
    counts = df.agg(*[_number_count(f.name, f.dataType).alias(f"c{i}") for i, f in enumerate(df.schema.fields)]).first()
    found = [(sum(k in c.lower() for k in keywords), counts[f"c{i}"], -i, c) for i, c in enumerate(df.columns) if counts[f"c{i}"]]
    return max(found)[3] if found else None


def classify_report(columns: Sequence[str]) -> str:
    """P20: report type from its field names, as they are written."""
    fields = set(columns)
    if {"Citizenship Country", "Nominated Occupation"} <= fields:
        return "skilled"
    if {"Citizenship Country", "Visa Type"} <= fields:
        return "whm"
    if {"Sector", "Nationality"} <= fields or any("YTD Enrolments" in f for f in fields):
        return "education"
    return "generic"


# ---------------------------------------------------------------------------
# Grid operators


def _hint(cells: str, pattern: str) -> Column:
    return F.exists(F.col(cells), lambda c: F.lower(c).rlike(pattern))


def _non_null(cells: str) -> Column:
    return F.size(F.filter(F.col(cells), lambda c: c.isNotNull() & (F.trim(c) != "")))


def header_rows(
    grid: DataFrame,
    hint: str | None = None,
    min_nonnull: int | None = None,
    all_hints: Sequence[str] = (),
    max_scan_rows: int = 20,
    out: str = "header_row",
) -> DataFrame:
    """Per (path, sheet), the first row among the first ``max_scan_rows``
    that contains ``hint`` (regex, case-insensitive) and/or has at least
    ``min_nonnull`` filled cells and/or contains every phrase in ``all_hints``;
    row 0 when none qualifies.  With no hint and no minimum, the rule is "more
    than 2 filled cells" (P03).  One grouped aggregate over the grid.  That a header lies among the scanned
    rows is stated on the result, so that a join with the grid by row reads these alone."""
    cond = F.lit(True)
    if hint is not None:
        cond = cond & _hint("cells", hint)
    for h in all_hints:
        cond = cond & _hint("cells", h)
    if min_nonnull is not None:
        cond = cond & (_non_null("cells") >= min_nonnull)
    if hint is None and min_nonnull is None and not all_hints:
        cond = _non_null("cells") > 2
    scan = grid.where(F.col("row_idx") < max_scan_rows)
    found = scan.groupBy("path", "sheet").agg(F.min(F.when(cond, F.col("row_idx"))).alias(out))
    return found.select("path", "sheet", F.coalesce(F.col(out), F.lit(0)).alias(out)).where(F.col(out) < max(max_scan_rows, 1))


def data_start_rows(grid: DataFrame, max_scan_rows: int = 20, out: str = "data_start") -> DataFrame:
    """The first row whose first cell parses as a date (blank excluded)."""
    from tidemark.functions.scalars import parse_day_first_date

    first = F.element_at(F.col("cells"), 1)
    is_date = first.isNotNull() & (F.trim(first) != "") & parse_day_first_date(first).isNotNull()
    scan = grid.where(F.col("row_idx") < max_scan_rows)
    return scan.groupBy("path", "sheet").agg(F.min(F.when(is_date, F.col("row_idx"))).alias(out))


def grid_to_table(
    grid: DataFrame, headers: DataFrame, columns: Sequence[str], header_col: str = "header_row",
    synonyms: Mapping[str, str] | None = None,
) -> DataFrame:
    """Rows below each sheet's header as named columns.

    Header names are normalised (P01, plus optional synonyms) and matched to
    ``columns`` per sheet, so sheets whose columns sit in different positions
    still line up; the first header cell with a wanted name wins.  Each sheet's
    header row becomes one row of normalised names; every data row joins its
    sheet's names (an equi-join on (path, sheet) against one row per sheet) and
    picks its cells by position.  No cell is exploded into its own row and
    nothing is regrouped, so the cost is one pass over the grid; the result
    schema is the fixed ``columns`` list.
    """
    h = headers.select("path", "sheet", F.col(header_col).alias("__hdr"))
    syn = F.create_map(*[F.lit(x) for kv in (synonyms or {}).items() for x in kv]) if synonyms else None

    def canon(c: Column) -> Column:
        n = norm_name_expr(c)
        return F.coalesce(F.try_element_at(syn, n), n) if syn is not None else n

    names = (
        grid.join(h, ["path", "sheet"])
        .where(F.col("row_idx") == F.col("__hdr"))
        .select("path", "sheet", "__hdr", F.transform(F.col("cells"), canon).alias("__names"))
    )
    body = grid.join(names, ["path", "sheet"]).where(F.col("row_idx") > F.col("__hdr"))
    picked = []
    for c in columns:
        pos = F.array_position(F.col("__names"), F.lit(c)).cast("int")
        picked.append(F.when(pos > 0, F.try_element_at(F.col("cells"), pos)).alias(c))
    return body.select("path", "sheet", "row_idx", *picked)


FILENAME_PATTERN = r"^(\d{1,2})[_-](\d{4})[_-](.+)$"
#: Fixed visa tokens sought in file names of another shape.
VISA_TOKENS = ("189", "190", "491", "All")
#: Fixed names of abbreviated view dimensions.
DIMENSION_NAMES = {"English": "English Test Score", "State": "Nominated State", "AustralianStudy": "Australian Study",
                   "RegionalStudy": "Regional Study", "ProfYear": "Professional Year", "CommunityLang": "Community Language",
                   "Groups": "Occupation Groups"}


def filename_context(file_col: Column) -> dict[str, Column]:
    """``{M or MM}{_ or -}{YYYY}{_ or -}{visa}_{status}_{view}`` to columns.  In a name of
    another shape the first visa token counts, with the part before it as the month,
    the one after it as status and the rest as view; absent parts are NULL, but the view
    is the whole stem wherever no part is left for it."""
    stem = F.regexp_replace(file_col, r"\.[^.]*$", "")

    def group(i: int) -> Column:
        return F.nullif(F.regexp_extract(stem, FILENAME_PATTERN, i), F.lit(""))

    def rest(parts: Column, first: Column) -> Column:
        left = F.size(parts) - first + 1
        return F.when(left > 0, F.array_join(F.slice(parts, first, F.greatest(left, F.lit(1))), "_"))

    dated = group(1).isNotNull()
    tail, loose = F.split(group(3), "_"), F.split(stem, "_")
    at = F.array_min(F.filter(F.transform(loose, lambda x, i: F.when(x.isin(*VISA_TOKENS), i + 1)), lambda x: x.isNotNull()))

    def near(step: int) -> Column:
        return F.when(at + step >= 1, F.try_element_at(loose, F.greatest(at + step, F.lit(1))))

    return {
        "as_at_month": F.when(dated, F.concat(F.lpad(group(1), 2, "0"), F.lit("/"), group(2))).otherwise(near(-1)),
        "visa_type": F.when(dated, F.try_element_at(tail, F.lit(1))).otherwise(near(0)),
        "eoi_status": F.when(dated, F.try_element_at(tail, F.lit(2))).otherwise(near(1)),
        "source_view": F.coalesce(F.when(dated, rest(tail, F.lit(3))).when(at.isNotNull(), rest(loose, at + 2)), stem),
    }


def view_dimensions(view: Column, abbreviations: Mapping[str, str] = DIMENSION_NAMES) -> dict[str, Column]:
    """Dimension names from a view name ``First_Second``: split at the first ``_``, known
    abbreviations written out; ``Unknown`` where there is no second part."""
    parts = F.split(view, "_", 2)
    names = F.create_map(*[F.lit(x) for kv in abbreviations.items() for x in kv]) if abbreviations else None

    def expand(c: Column) -> Column:
        return F.coalesce(F.try_element_at(names, c), c) if names is not None else c

    return {
        "dimension_1_name": expand(F.element_at(parts, 1)),
        "dimension_2_name": F.coalesce(expand(F.try_element_at(parts, F.lit(2))), F.lit("Unknown")),
    }
