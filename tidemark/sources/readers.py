"""File readers for landed releases (CSV, SDMX CSV, JSON message logs, release
pages), all as distributed scans.  Workbooks are in :mod:`tidemark.sources.xlsx`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.scalars import absolute_url, lenient_double, month_number, parse_day_first_date

# Fixed labels (lower case) of the metadata rows in a statistical-series CSV.
SERIES_META_LABELS = {"title": "title", "units": "units", "frequency": "frequency", "series id": "series_id", "series_id": "series_id"}
SERIES_ID_LABELS = ("series id", "series_id")


def read_csv(spark: SparkSession, path: str, schema: str | None = None, **options) -> DataFrame:
    """Header CSV (a UTF-8 BOM is stripped), one splittable scan."""
    r = spark.read.option("header", True).option("encoding", options.pop("encoding", "UTF-8"))
    for k, v in options.items():
        r = r.option(k, v)
    if schema:
        r = r.schema(schema)
    return r.csv(path)


def file_encodings(spark: SparkSession, path: str, glob: str = "*.csv", fallback: str = "ISO-8859-1") -> DataFrame:
    """(path, encoding) of each file: UTF-8 where every line is valid UTF-8, else ``fallback``.
    Lines are judged where they are read, so a large file is split over tasks."""
    lines = spark.read.option("pathGlobFilter", glob).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    valid = F.every(F.call_function("is_valid_utf8", "value"))
    return lines.groupBy("path").agg(F.when(valid, F.lit("UTF-8")).otherwise(F.lit(fallback)).alias("encoding"))


def read_csv_any_encoding(spark: SparkSession, path: str, schema: str, glob: str = "*.csv", fallback: str = "ISO-8859-1", **options) -> DataFrame:
    """Header CSVs of which each file is UTF-8 or, failing that, ``fallback``; ``_path``, ``_at``
    (where the block begins that a row was read in) and ``_encoding`` say which.  One splittable scan for each encoding that occurs; the driver knows the files' names, as any scan's does.
    No file at all is an error, as for other readers."""
    found = file_encodings(spark, path, glob, fallback).collect()
    out = None
    for encoding in sorted({r["encoding"] for r in found}):
        paths = [r["path"] for r in found if r["encoding"] == encoding]
        reader = spark.read.schema(schema).options(**{"header": True, "encoding": encoding, **options})
        part = reader.csv(paths).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_at"),
                                        F.lit(encoding).alias("_encoding"))
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise FileNotFoundError(f"{path}: no file {glob} with a line")
    return out


def _series_width(spark: SparkSession, path: str, glob: str) -> int:
    """Columns of the widest file, from its "Series ID" line (commas inside quotes only
    make it wider than needed).  A file without that line is an error."""
    lines = spark.read.option("pathGlobFilter", glob).text(path).select(F.col("_metadata.file_path").alias("path"), "value")
    label = F.lower(F.trim(F.regexp_extract("value", r'^\ufeff?"?([^",]*)', 1)))
    width = F.when(label.isin(*SERIES_ID_LABELS), F.length(F.regexp_replace("value", "[^,]", "")) + 1)
    per_file = lines.groupBy("path").agg(F.max(width).alias("width"))
    found = per_file.agg(F.max("width").alias("width"), F.min(F.when(F.col("width").isNull(), F.col("path"))).alias("bad")).first()
    if found["bad"] is not None:
        raise ValueError(f"{found['bad']}: no 'Series ID' row")
    return found["width"] or 1


def read_series_csv(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """S01 end to end as one splittable CSV scan (no Python on the rows): long rows
    ``(path, date, series_id, value, title, units, frequency)``.

    Every line is read against an all-text schema as wide as the widest file's
    "Series ID" line says (a short row gets a NULL tail), tagged with its file.
    Metadata lines are recognised by their label, in any case, and data lines by a first
    cell that parses as a day-first date, so line order is never needed and a large
    file is split across tasks.  The metadata (a handful of lines per file) is turned
    into one row per (file, position) and joined to the exploded data cells.  A file
    without a "Series ID" row raises.
    """
    width = _series_width(spark, path, glob)
    raw = (
        spark.read.schema(", ".join(f"c{i} STRING" for i in range(width))).option("header", False)
        .option("mode", "PERMISSIVE").option("pathGlobFilter", glob).csv(path)
        .select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("c0", "^\ufeff", "").alias("c0"),
                F.array(*[F.col(f"c{i}") for i in range(1, width)]).cast("array<string>").alias("cells"))
    )
    label = F.lower(F.trim(F.col("c0")))
    names = sorted(set(SERIES_META_LABELS.values()))
    meta = raw.where(label.isin(*SERIES_META_LABELS)).select("path", label.alias("label"), F.posexplode("cells").alias("pos", "v"))
    wide_meta = meta.groupBy("path", "pos").agg(
        *[F.max(F.when(F.col("label").isin(*[k for k, v in SERIES_META_LABELS.items() if v == n]), F.trim("v"))).alias(n) for n in names]
    ).where(F.col("series_id") != "")
    data = raw.select("path", parse_day_first_date("c0").alias("date"), "cells").where(F.col("date").isNotNull())
    cells = data.select("path", "date", F.posexplode("cells").alias("pos", "raw")).where(F.col("raw").isNotNull())
    j = cells.join(wide_meta, ["path", "pos"], "inner")
    return j.select(
        "path", "date", "series_id", lenient_double("raw").alias("value"), "title", "units", "frequency"
    ).where(F.col("value").isNotNull())


def read_sdmx_csv(
    spark: SparkSession, path: str, start_period: str | None = None, end_period: str | None = None
) -> DataFrame:
    """S05 (+ P12): SDMX labelled CSV, optional period bounds on TIME_PERIOD,
    standard renames and a lenient numeric value."""
    df = read_csv(spark, path)
    if start_period:
        df = df.where(F.col("TIME_PERIOD") >= F.lit(start_period))
    if end_period:
        df = df.where(F.col("TIME_PERIOD") <= F.lit(end_period))
    renames = {"TIME_PERIOD": "period", "OBS_VALUE": "value_text", "MEASURE": "measure", "REGION": "region"}
    df = df.withColumnsRenamed({k: v for k, v in renames.items() if k in df.columns})
    return df.withColumn("value", lenient_double("value_text")).where(F.col("value").isNotNull())


def newest_file(spark: SparkSession, path: str, glob: str) -> str | None:
    """The newest matching file by name (only file names are listed)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    row = files.agg(F.max("path").alias("p")).first()
    return row["p"] if row else None


def first_available(spark: SparkSession, candidates: Sequence[tuple[str, str]]) -> tuple[str, str] | None:
    """The first (folder, glob) in the fallback chain that holds a file; a folder that
    is not there holds none, any other failure is raised."""
    from pyspark.errors import AnalysisException

    for folder, glob in candidates:
        try:
            if newest_file(spark, folder, glob):
                return folder, glob
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def file_context(df: DataFrame) -> DataFrame:
    """Release context from each row's source file name."""
    from tidemark.operators.shape import filename_context

    ctx = filename_context(F.col("_metadata.file_name"))
    return df.select("*", *[c.alias(k) for k, c in ctx.items()])


# ---------------------------------------------------------------------------
# JSON message logs

#: Depth to which a message is searched for its data pages.
PAGE_DEPTH = 8
def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """A message log - either a JSON list of messages or an object with
    ``requests`` and ``responses`` lists - one row per message: method, id, dir, ts and the
    message's JSON.  A message may be an object or an object written as a string."""
    raw = spark.read.option("wholetext", True).text(path)
    # as text, a string item is the JSON it holds and an object item its own JSON, in its own order
    none = F.array().cast("array<string>")
    both = F.from_json("value", "requests array<string>, responses array<string>")
    halves = F.concat(F.coalesce(both["requests"], none), F.coalesce(both["responses"], none))
    items = F.when(F.col("value").rlike(r"^\ufeff?\s*\["), F.from_json(F.regexp_replace("value", "^\ufeff", ""), "array<string>")).otherwise(halves)
    return with_envelope(raw.select(F.explode(items).alias("json")))


def with_envelope(messages: DataFrame) -> DataFrame:
    """method, id, dir (``dir`` or ``direction``) and ts beside each message's ``json``."""
    def get(*names: str) -> F.Column:
        return F.coalesce(*[F.get_json_object("json", f"$.{n}") for n in names])

    return messages.select(get("method", "data.method").alias("method"), get("id", "data.id").try_cast("bigint").alias("id"),
                           get("dir", "direction").alias("dir"), get("ts").alias("ts"), "json")


PAGES_KEY, MATRIX_KEY, CELL_TEXT, CELL_NUMBER = "qDataPages", "qMatrix", "qText", "qNum"
_NUMBER_TYPES = "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$"


def _variant(v: Column, kind: str, path: str = "$") -> Column:
    return F.try_variant_get(v, path, kind)


def page_lists(part: Column, depth: int = PAGE_DEPTH) -> Column:
    """Every list of data pages inside the variant ``part``, as an array of (steps, pages): steps is
    the way to it.  The search goes level by level, to ``depth`` levels below the
    part; an object that has the pages' key is not searched further."""
    node = "array<struct<steps: array<string>, v: variant>>"
    steps = F.array().cast("array<string>")

    def inside(n: Column) -> Column:
        items = F.transform(_variant(n["v"], "array<variant>"), lambda x, i: F.struct(
            F.concat(n["steps"], F.array(F.concat(F.lit("["), i.cast("string"), F.lit("]")))).alias("steps"), x.alias("v")))
        fields = F.transform(F.map_entries(_variant(n["v"], "map<string,variant>")), lambda e: F.struct(
            F.concat(n["steps"], F.array(F.concat(F.lit("['"), e["key"], F.lit("']")))).alias("steps"), e["value"].alias("v")))
        return F.coalesce(items, fields, F.array().cast(node))

    def pages(n: Column) -> Column:
        return _variant(n["v"], "variant", f"$.{PAGES_KEY}")

    def level(state: Column, at: Column) -> Column:
        met = F.transform(F.filter(state["open"], lambda n: pages(n).isNotNull()), lambda n: F.struct(n["steps"].alias("steps"), pages(n).alias("v")))
        rest = F.flatten(F.transform(F.filter(state["open"], lambda n: pages(n).isNull()), inside))
        return F.struct(F.when(at < depth, rest).otherwise(F.array().cast(node)).alias("open"), F.concat(state["met"], met).alias("met"))

    start = F.struct(F.array(F.struct(steps.alias("steps"), part.alias("v"))).alias("open"), F.array().cast(node).alias("met"))
    met = F.aggregate(F.sequence(F.lit(0), F.lit(depth)), start, level, lambda s: s["met"])
    full = F.transform(met, lambda m: F.struct(m["steps"].alias("steps"), _variant(m["v"], "array<variant>").alias("pages")))
    return F.filter(full, lambda m: F.size(m["pages"]) > 0)


def _text_order(steps: Column, json: Column, root: Column) -> Column:
    """Where a list stands in the message's text: for each step the place of its key in its object
    or its index.  A variant keeps an object's fields sorted, so the text is asked."""
    def place(step: Column, i: Column) -> Column:
        parent = F.concat(root, F.array_join(F.slice(steps, F.lit(1), i), ""))
        keys = F.call_function("json_object_keys", F.call_function("get_json_object", json, parent))
        name = F.regexp_extract(step, r"^\['(.*)'\]$", 1)
        return F.when(step.startswith("['"), F.array_position(keys, name)).otherwise(F.regexp_extract(step, r"(\d+)", 1).cast("long"))

    return F.transform(steps, place)


def first_pages(json: Column) -> Column:
    """The first list of data pages of a message (array of variants): sought in ``data``, or in the whole message
    where there is none, in the order of the text; empty lists do not count."""
    message = F.try_parse_json(json)
    data = _variant(message, "variant", "$.data")
    lists = page_lists(F.coalesce(data, message))
    root = F.when(data.isNotNull(), F.lit("$.data")).otherwise(F.lit("$"))

    def earlier(a: Column, b: Column) -> Column:
        x, y = _text_order(a["steps"], json, root), _text_order(b["steps"], json, root)
        return F.when(x < y, F.lit(-1)).when(x > y, F.lit(1)).otherwise(F.lit(0))

    chosen = F.when(F.size(lists) > 1, F.array_sort(lists, earlier)).otherwise(lists)
    return F.try_element_at(chosen, F.lit(1))["pages"]


def hypercube_cells(messages: DataFrame) -> DataFrame:
    """R13 + X27: the data pages of received messages to rows: (id, ts, page_idx, row_idx, col_idx,
    text, number).  A message that names a direction counts only if it is ``recv``; one that
    is no JSON gives no rows.  The search walks the message's VARIANT, so everything is
    expressions: pages, rows and cells are generated from it one below the other."""
    kept = messages.where(F.col("json").isNotNull() & (F.coalesce("dir", F.lit("recv")) == "recv"))
    paged = kept.select("id", "ts", F.posexplode(first_pages(F.col("json"))).alias("page_idx", "page"))
    rows = paged.select("id", "ts", "page_idx", F.posexplode(_variant(F.col("page"), "array<variant>", f"$.{MATRIX_KEY}")).alias("row_idx", "row"))
    cells = rows.select("id", "ts", "page_idx", "row_idx", F.posexplode(_variant(F.col("row"), "array<variant>")).alias("col_idx", "cell"))
    number = _variant(F.col("cell"), "variant", f"$.{CELL_NUMBER}")
    return cells.where(F.schema_of_variant("cell").startswith("OBJECT")).select(
        "id", "ts", "page_idx", "row_idx", "col_idx", _variant(F.col("cell"), "string", f"$.{CELL_TEXT}").alias("text"),
        F.when(F.schema_of_variant(number).rlike(_NUMBER_TYPES), _variant(number, "double")).alias("number"))


def method_histogram(messages: DataFrame, n: int = 15) -> DataFrame:
    """Most frequent message methods."""
    return messages.groupBy("method").agg(F.count(F.lit(1)).alias("n")).orderBy(
        F.col("n").desc(), F.col("method")
    ).limit(n)


# ---------------------------------------------------------------------------
# Release pages

# Fixed page conventions: a heading "<Month> <YYYY> Latest data|All data" is
# followed by its workbook link (an anchor with class "file type-xlsx").
RELEASE_HEADING = r"<h[1-6][^>]*>\s*([A-Za-z]+)\s+(\d{4})\s+(Latest data|All data)\s*</h[1-6]>"
XLSX_LINK = r'<a [^>]*class="[^"]*type-xlsx[^"]*"[^>]*href="([^"]+)"'
KIND_BY_LABEL = {"Latest data": "latest_data", "All data": "all_data"}


def release_links(pages: DataFrame, base_url: str) -> DataFrame:
    """B12 (+ X24, X25, X14): each release heading with the first workbook link
    that follows it, as (page_id, year, month, kind, url).  Pages are split
    before every heading, so each block holds one heading and its links."""
    from tidemark.operators.joins import map_lookup

    blocks = pages.select(
        "page_id", F.posexplode(F.split("html", r"(?=<h[1-6][^>]*>)")).alias("pos", "block")
    )
    h = blocks.select(
        "page_id",
        F.regexp_extract("block", RELEASE_HEADING, 1).alias("month_name"),
        F.regexp_extract("block", RELEASE_HEADING, 2).alias("year"),
        F.regexp_extract("block", RELEASE_HEADING, 3).alias("label"),
        F.regexp_extract("block", XLSX_LINK, 1).alias("href"),
    ).where((F.col("label") != "") & (F.col("href") != ""))
    return h.select(
        "page_id",
        F.col("year").cast("int").alias("year"),
        month_number("month_name").alias("month"),
        map_lookup("label", KIND_BY_LABEL).alias("kind"),
        absolute_url("href", base_url).alias("url"),
    )


def allowed_url(url: F.Column, host: str | F.Column, path_prefix: str = "/download/", last_segment: str = "xlsx") -> F.Column:
    """https only, exact host, path under the prefix, given last segment."""
    path = F.parse_url(url, F.lit("PATH"))
    last = F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
    return F.coalesce(
        (F.parse_url(url, F.lit("PROTOCOL")) == "https")
        & (F.parse_url(url, F.lit("HOST")) == host)
        & path.startswith(path_prefix)
        & (F.lower(last) == last_segment),
        F.lit(False),
    )


def newest_complete_release(links: DataFrame, kinds: Sequence[str] = ("latest_data", "all_data")) -> DataFrame:
    """The latest (year, month) offering every kind of file; one row or none."""
    g = links.groupBy("year", "month").agg(F.collect_set("kind").alias("kinds"))
    complete = g.where(F.size(F.array_intersect("kinds", F.array(*[F.lit(k) for k in kinds]))) == len(kinds))
    best = complete.agg(F.max(F.struct("year", "month")).alias("p"))
    return best.where(F.col("p").isNotNull()).select("p.year", "p.month")
