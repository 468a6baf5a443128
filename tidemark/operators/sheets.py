"""Rows of release sheets whose columns are known only by their headings.

A grid is ``(path, sheet, row_idx, cells)``; every sheet names its columns in a header row of its own.
The headings are data here, so one plan serves sheets of any layout: each sheet's
header gives one row of positions, which the sheet's rows join.  A sheet may hold most rows of a
release, so its rows are dealt over parts of it for that join.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scalars import norm_name_expr, parse_day_first_date
from tidemark.operators.windows import forward_fill

Rule = Callable[[Column], Column]
ROW = ("path", "sheet", "row_idx")
SHEET = ("path", "sheet", "__hdr")
#: Parts that the rows of one sheet are dealt over.
SHEET_PARTS = 64


def contains_any(*words: str) -> Rule:
    """A rule that holds for names that contain any of ``words``; a word ``a+b`` asks for both."""
    def holds(name: Column) -> Column:
        out = F.lit(False)
        for w in words:
            both = F.lit(True)
            for part in w.split("+"):
                both = both & name.contains(part)
            out = out | both
        return out

    return holds


def is_any(*names: str) -> Rule:
    return lambda name: name.isin(*names)


def _headed(grid: DataFrame, headers: DataFrame, header_col: str, places: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows below each sheet's header, with what ``places`` makes of the header's normalised names: it gets
    (``SHEET``, ``__names``) and is worked out once a sheet.  Every part of a sheet joins a copy of it."""
    h = headers.select("path", "sheet", F.col(header_col).alias("__hdr"))
    names = grid.join(h, ["path", "sheet"]).where(F.col("row_idx") == F.col("__hdr")).select(
        *SHEET, F.transform("cells", lambda c: F.coalesce(norm_name_expr(c), F.lit(""))).alias("__names"))
    placed = places(names).withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(SHEET_PARTS - 1))))
    filled = F.exists("cells", lambda c: c.isNotNull() & (F.trim(c) != ""))
    dealt = grid.withColumn("__part", F.pmod(F.xxhash64("row_idx"), F.lit(SHEET_PARTS)).cast("int"))
    return dealt.join(placed, ["path", "sheet", "__part"]).where((F.col("row_idx") > F.col("__hdr")) & filled)


def _cell(position: Column) -> Column:
    return F.when(position > 0, F.nullif(F.trim(F.try_element_at("cells", position.cast("int"))), F.lit("")))


def named_rows(grid: DataFrame, headers: DataFrame, columns: Mapping[str, Sequence[str]], header_col: str = "header_row") -> DataFrame:
    """P09 by sheet: each wanted column from the first of its names that the sheet has (a later name
    counts only where all earlier ones are absent); NULL where it has none."""
    def position(names: Sequence[str]) -> Column:
        found = [F.array_position("__names", n) for n in names]
        return F.coalesce(*[F.when(p > 0, p) for p in found], F.lit(0))

    body = _headed(grid, headers, header_col, lambda h: h.select(*SHEET, *[position(names).alias(f"__at{i}") for i, names in enumerate(columns.values())]))
    return body.select(*ROW, *[_cell(F.col(f"__at{i}")).alias(c) for i, c in enumerate(columns)])


def melted_rows(
    grid: DataFrame, headers: DataFrame, ids: Sequence[tuple[str, Rule]], name: str, value: str,
    value_names: str | None = None, header_col: str = "header_row", fill: Sequence[str] = (),
) -> DataFrame:
    """P10/P11 + R01/R05 by sheet: a column takes the first id role whose rule its heading meets, each role
    going to its first column; other columns (whose headings match ``value_names``, if given) become
    rows of (ids, name, value).  A sheet without any id column gives no rows; an empty cell gives none.  Merged labels
    of the ``fill`` roles are carried down the sheet first (R12), from rows without values too."""
    roles = F.transform("__names", lambda n: F.coalesce(*[F.when(rule(n), F.lit(role)) for role, rule in ids]))
    wanted = F.filter(F.transform("__names", lambda n, i: F.struct((i + 1).alias("at"), n.alias("name"))),
                      lambda x: F.element_at("__roles", x["at"].cast("int")).isNull() & (x["name"] != "")
                      & (x["name"].rlike(value_names) if value_names else F.lit(True)))
    at = [F.coalesce(F.array_position("__roles", role), F.lit(0)).alias(f"__at{i}") for i, (role, _) in enumerate(ids)]
    body = _headed(grid, headers, header_col, lambda h: h.withColumn("__roles", roles).where(F.exists("__roles", lambda r: r.isNotNull()))
                   .select(*SHEET, *at, wanted.alias("__values")))
    kept = body.select(*ROW, *[_cell(F.col(f"__at{i}")).alias(role) for i, (role, _) in enumerate(ids)],
                         F.transform("__values", lambda x: F.struct(x["name"].alias("n"), F.nullif(F.trim(F.try_element_at("cells", x["at"].cast("int"))), F.lit("")).alias("v"))).alias("__cells"))
    if fill:
        kept = forward_fill(kept, ["path", "sheet"], "row_idx", list(fill))
    cells = kept.withColumn("__cell", F.explode("__cells"))
    return cells.where("__cell.v IS NOT NULL").select(*ROW, *[role for role, _ in ids], F.col("__cell.n").alias(name), F.col("__cell.v").alias(value))


#: Fixed labels of the rows above a sheet's series, normalised, and the columns they give.
SERIES_LABELS = {"series_id": "series_id", "unit": "unit", "units": "unit", "series_type": "series_type"}


def series_rows(grid: DataFrame, max_scan_rows: int = 20) -> DataFrame:
    """R02 on sheets: (path, sheet, period, series_id, value text, title, unit, series_type) of sheets that
    hold one series a column below rows of metadata.

    A data row's first cell is a date, a metadata row's is its label (row 0 without one holds
    the titles).  Metadata rows lie among the first ``max_scan_rows`` and give one row for
    each column, which the data cells join by position.
    """
    first = F.trim(F.try_element_at("cells", F.lit(1)))
    day = F.coalesce(parse_day_first_date(first), F.try_to_timestamp(first, F.lit("yyyy-MM-dd HH:mm:ss")).cast("date"), F.try_to_timestamp(first, F.lit("yyyy-MM-dd")).cast("date"))
    marked = grid.withColumn("__day", F.when(F.coalesce(first, F.lit("")) != "", day))
    label = F.when(F.col("row_idx") == 0, F.lit("title"))
    for text, column in SERIES_LABELS.items():
        label = F.when(norm_name_expr(first) == text, F.lit(column)).otherwise(label)
    above = marked.where((F.col("row_idx") < max_scan_rows) & F.col("__day").isNull()).withColumn("__label", label).where("__label IS NOT NULL")
    cells = above.select("path", "sheet", "__label", F.posexplode("cells").alias("__at", "__text")).where("__at > 0")
    series = cells.groupBy("path", "sheet", "__at").agg(*[F.max(F.when(F.col("__label") == c, F.nullif(F.trim("__text"), F.lit("")))).alias(c)
                                                          for c in ("title", "unit", "series_type", "series_id")]).where("series_id IS NOT NULL")
    data = marked.where("__day IS NOT NULL").select("path", "sheet", "row_idx", F.date_format("__day", "yyyy-MM").alias("period"), F.posexplode("cells").alias("__at", "__text"))
    return data.where("__at > 0").join(series, ["path", "sheet", "__at"]).select(
        *ROW, "period", "series_id", F.col("__text").alias("value"), "title", "unit", "series_type")
