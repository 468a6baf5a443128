"""Scalar column functions (coercion, period text, formatting).

Every function maps ``Column -> Column`` and is built from Spark built-ins, so
it stays inside whole-stage code generation; none of them needs Python on the
row path.  ANSI mode is assumed on, hence ``try_*`` wherever input is text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# Fixed values that must equal the source publications' conventions.
# Month names (English, full and three-letter) map to month numbers 1-12.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)
# Date layouts tried, in order, for day-first publication dates such as
# 29-Jan-2010, 29/01/2010, 2010-01-29 and 29-January-2010.
DAY_FIRST_FORMATS = ("d-MMM-yyyy", "d/M/yyyy", "yyyy-MM-dd", "d-MMMM-yyyy", "d MMM yyyy")
# ---------------------------------------------------------------------------


def nan_to_null(c: ColumnOrName) -> Column:
    """NaN and +/-inf become NULL (missing is not a number)."""
    col = _c(c)
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), F.lit(None)).otherwise(col)


def lenient_double(c: ColumnOrName) -> Column:
    """Trim, cast to double, junk becomes NULL; 'nan'/'inf' text too."""
    out = F.trim(_c(c).cast("string")).try_cast("double")
    return nan_to_null(out)


def strip_to_number(c: ColumnOrName) -> Column:
    """Keep digits, '.', '-' only, then lenient cast."""
    return lenient_double(F.regexp_replace(_c(c).cast("string"), r"[^\d.\-]", ""))


def strip_money(c: ColumnOrName) -> Column:
    """Drop '$' and ',' then lenient cast."""
    return lenient_double(F.regexp_replace(_c(c).cast("string"), r"[\$,]", ""))


def zero_fill_long(c: ColumnOrName) -> Column:
    """NULL to 0, then a whole number."""
    return F.coalesce(_c(c), F.lit(0)).cast("long")


def parse_day_first_date(c: ColumnOrName, formats: tuple[str, ...] = DAY_FIRST_FORMATS) -> Column:
    """First layout that parses wins; blank or bad text is NULL."""
    txt = F.trim(_c(c).cast("string"))
    return F.coalesce(*[F.try_to_timestamp(txt, F.lit(f)).cast("date") for f in formats])


def date_text(c: ColumnOrName, layout: str = "yyyy-MM-dd") -> Column:
    """Date to `YYYY-MM-DD` (or `yyyy-MM` with that layout)."""
    return F.date_format(_c(c), layout)


def mangled_header_month(c: ColumnOrName) -> Column:
    """`2006_01_01_00_00_00` (a date header after name normalising) to `2006-01`."""
    y = F.regexp_extract(_c(c), r"^(\d{4})_(\d{2})", 1)
    m = F.regexp_extract(_c(c), r"^(\d{4})_(\d{2})", 2)
    return F.when(y != "", F.concat(y, F.lit("-"), m))


def header_period(c: ColumnOrName) -> Column:
    """Header text to `YYYY` or `YYYY-YY` (underscore separators become '-')."""
    fy = F.regexp_extract(_c(c), r"^(\d{4}[_-]\d{2})", 1)
    yr = F.regexp_extract(_c(c), r"^(\d{4})", 1)
    return F.when(fy != "", F.replace(fy, F.lit("_"), F.lit("-"))).when(yr != "", yr)


def fy_dash(c: ColumnOrName) -> Column:
    """Every '_' to '-' (also inside suffixes, as the query layer does)."""
    return F.replace(_c(c), F.lit("_"), F.lit("-"))


def left_year(c: ColumnOrName) -> Column:
    """The first four characters of a period text."""
    return F.substring(_c(c), 1, 4)


def leading_digits(c: ColumnOrName) -> Column:
    """X11: `457 Temporary Work` to `457`; no leading digits gives NULL."""
    return F.nullif(F.regexp_extract(F.trim(_c(c)), r"^(\d+)", 1), F.lit(""))


def title_part(c: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """A regex capture from a title; no match gives NULL."""
    return F.nullif(F.regexp_extract(_c(c), pattern, group), F.lit(""))


def trim_keep_null(c: ColumnOrName) -> Column:
    """Trim text; NULL stays NULL (never the text 'nan' or 'None')."""
    return F.trim(_c(c).cast("string"))


def month_number(c: ColumnOrName) -> Column:
    """Month label (full name, 3-letter abbreviation, or digits) to 1-12, else NULL."""
    txt = F.lower(F.trim(_c(c).cast("string")))
    out = F.lit(None).cast("int")
    for i, name in enumerate(MONTH_NAMES, start=1):
        out = F.when((txt == name) | (txt == name[:3]), F.lit(i)).otherwise(out)
    num = txt.try_cast("int")
    return F.when(num.between(1, 12), num).otherwise(out)


def pct_change(cur: ColumnOrName, prev: ColumnOrName) -> Column:
    """(cur - prev) / prev * 100; NULL when either side is NULL or prev is 0."""
    cur_c, prev_c = _c(cur).cast("double"), _c(prev).cast("double")
    return F.when(prev_c != 0, (cur_c - prev_c) / prev_c * F.lit(100.0))


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Num / den; NULL on a NULL side or a zero denominator."""
    den_c = _c(den).cast("double")
    return F.when(den_c != 0, _c(num).cast("double") / den_c)


def fill_rate(invitations: ColumnOrName, ceiling: ColumnOrName) -> Column:
    """Invitations / ceiling x 100."""
    return safe_ratio(invitations, ceiling) * F.lit(100.0)


def annualise_weekly(c: ColumnOrName) -> Column:
    """Weekly text amount as DECIMAL(14,2) times 52."""
    return _c(c).try_cast("decimal(14,2)") * F.lit(52)


def fmt_number(c: ColumnOrName, decimals: int = 0) -> Column:
    """Thousands separators; NULL/NaN become `N/A`."""
    col = nan_to_null(_c(c).cast("double"))
    return F.coalesce(F.format_number(col, decimals), F.lit("N/A"))


def fmt_pct(c: ColumnOrName, decimals: int = 1, signed: bool = False) -> Column:
    """Percent text, `+` for positive values when ``signed``."""
    col = nan_to_null(_c(c).cast("double"))
    body = F.concat(F.format_number(col, decimals), F.lit("%"))
    if signed:
        body = F.concat(F.when(col > 0, F.lit("+")).otherwise(F.lit("")), body)
    return F.coalesce(body, F.lit("N/A"))


def period_label(year: ColumnOrName, month: ColumnOrName | None = None) -> Column:
    """`YYYY` or `YYYY-MM`."""
    y = _c(year).cast("int").cast("string")
    if month is None:
        return y
    return F.concat(y, F.lit("-"), F.lpad(_c(month).cast("int").cast("string"), 2, "0"))


def truncate_text(c: ColumnOrName, n: int = 2000) -> Column:
    """Keep the first ``n`` characters of an error text."""
    return F.substring(_c(c), 1, n)


def month_label(year: ColumnOrName, month: ColumnOrName) -> Column:
    """(2026, 5) to `May 2026`."""
    return F.date_format(F.make_date(_c(year), _c(month), F.lit(1)), "MMMM yyyy")


def absolute_url(href: ColumnOrName, base: str | Column) -> Column:
    """A site-relative href joined to the site base."""
    h, b = _c(href), F.lit(base) if isinstance(base, str) else base
    return F.when(h.startswith("/"), F.concat(F.rtrim(b, F.lit("/")), h)).otherwise(h)


def python_round(c: ColumnOrName, digits: int) -> Column:
    """Half-even rounding, the rule Python's ``round`` applies to exact halves."""
    return F.bround(_c(c), digits)


def norm_name_expr(c: ColumnOrName) -> Column:
    """P01 on data: trim, lower, runs of other characters to '_', strip '_'."""
    s = F.regexp_replace(F.lower(F.trim(_c(c))), r"[^a-z0-9]+", "_")
    return F.regexp_replace(s, r"^_+|_+$", "")


def synth_location_id(provider: ColumnOrName, name: ColumnOrName) -> Column:
    """First 16 hex of md5(UPPER(TRIM(provider)) || '|' || LOWER(TRIM(name)))."""
    key = F.concat(
        F.upper(F.trim(F.coalesce(_c(provider).cast("string"), F.lit("")))),
        F.lit("|"),
        F.lower(F.trim(F.coalesce(_c(name).cast("string"), F.lit("")))),
    )
    return F.substring(F.md5(key), 1, 16)


def null_safe_key(c: ColumnOrName, blank: str = "") -> Column:
    """NULL-as-a-value key column (COALESCE to '' or '0')."""
    return F.coalesce(_c(c).cast("string"), F.lit(blank))


def code_level(c: ColumnOrName, n: int) -> Column:
    """P25: hierarchy level of a classification code = its first ``n`` characters."""
    return F.substring(_c(c), 1, n)
