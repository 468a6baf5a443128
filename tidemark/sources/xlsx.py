"""Workbook readers run inside Spark tasks.

A workbook is a ZIP of XML parts.  ``binaryFile`` lists and loads the files;
``mapInPandas`` parses each workbook in the task that holds it (standard
library ``zipfile`` + ``xml.etree``), emitting the untyped grid
``(path, sheet, row_idx, cells)`` or pivot-cache records.  Everything after
the parse (header detection, typing, unpivot) is Spark expressions.
Parallelism is one task per file; a large workbook is streamed with
``iterparse`` so only one row is held at a time.
"""

from __future__ import annotations

import contextlib
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
REL_NS = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
PKG_REL_NS = "{http://schemas.openxmlformats.org/package/2006/relationships}"

GRID_SCHEMA = "path STRING, sheet STRING, row_idx INT, cells ARRAY<STRING>"
PIVOT_RECORD_SCHEMA = "path STRING, record_idx BIGINT, field_idx INT, kind STRING, value STRING"
PIVOT_FIELD_SCHEMA = "path STRING, field_idx INT, field_name STRING, item_idx INT, item_value STRING"
PARTS_SCHEMA = "path STRING, part STRING"

_COL_RX = re.compile(r"([A-Z]+)(\d+)")


def _col_index(ref: str) -> int:
    m = _COL_RX.match(ref or "")
    if not m:
        return -1
    n = 0
    for ch in m.group(1):
        n = n * 26 + (ord(ch) - 64)
    return n - 1


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    out = []
    for _, el in ET.iterparse(z.open("xl/sharedStrings.xml")):
        if el.tag == NS + "si":
            out.append("".join(t.text or "" for t in el.iter(NS + "t")))
            el.clear()
    return out


def _sheet_paths(z: zipfile.ZipFile) -> list[tuple[str, str]]:
    wb = ET.parse(z.open("xl/workbook.xml")).getroot()
    rels = {}
    if "xl/_rels/workbook.xml.rels" in z.namelist():
        for r in ET.parse(z.open("xl/_rels/workbook.xml.rels")).getroot().iter(PKG_REL_NS + "Relationship"):
            rels[r.get("Id")] = r.get("Target")
    out = []
    for i, s in enumerate(wb.iter(NS + "sheet"), start=1):
        target = rels.get(s.get(REL_NS + "id"), f"worksheets/sheet{i}.xml")
        target = target.lstrip("/")
        out.append((s.get("name"), target if target.startswith("xl/") else f"xl/{target}"))
    return out


def parse_workbook(path: str, content: bytes) -> Iterator[tuple[str, str, int, list[str | None]]]:
    """Yield ``(path, sheet, row_idx, cells)`` for every row of every sheet.
    Row indices are 0-based sheet row numbers (gaps kept as empty rows)."""
    z = zipfile.ZipFile(io.BytesIO(content))
    shared = _shared_strings(z)
    for sheet, part in _sheet_paths(z):
        if part not in z.namelist():
            continue
        expected, rows = 0, None
        for event, el in ET.iterparse(z.open(part), events=("start", "end")):
            if event == "start":
                rows = el if el.tag == NS + "sheetData" else rows
                continue
            if el.tag != NS + "row":
                continue
            r = int(el.get("r", expected + 1)) - 1
            while expected < r:
                yield path, sheet, expected, []
                expected += 1
            cells: list[str | None] = []
            for c in el.iter(NS + "c"):
                idx = _col_index(c.get("r", ""))
                if idx < 0:
                    idx = len(cells)
                while len(cells) < idx:
                    cells.append(None)
                t = c.get("t")
                v = c.find(NS + "v")
                if t == "s" and v is not None:
                    val = shared[int(v.text)]
                elif t == "inlineStr":
                    val = "".join(x.text or "" for x in c.iter(NS + "t"))
                else:
                    val = v.text if v is not None else None
                cells.append(val)
            yield path, sheet, r, cells
            expected = r + 1
            if rows is not None:
                rows.clear()  # drops the row itself too, not only what it holds


# Rows handed to Arrow per output batch: a large workbook is emitted in pieces,
# so a task never holds all of its rows at once.
CHUNK_ROWS = 100_000


def _chunked(rows: Iterator[tuple], columns: list[str]) -> Iterator[pd.DataFrame]:
    buf: list[tuple] = []
    for row in rows:
        buf.append(row)
        if len(buf) >= CHUNK_ROWS:
            yield pd.DataFrame(buf, columns=columns)
            buf = []
    if buf:
        yield pd.DataFrame(buf, columns=columns)


@contextlib.contextmanager
def _naming(path: str):
    """A file that is no readable workbook fails the load, with its path."""
    try:
        yield
    except (zipfile.BadZipFile, KeyError, ET.ParseError) as e:
        raise ValueError(f"{path}: not a readable workbook ({type(e).__name__}: {e})") from e


def _grid_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def rows():
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with _naming(path):
                    yield from parse_workbook(path, bytes(content))

    yield from _chunked(rows(), ["path", "sheet", "row_idx", "cells"])


def read_grid(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """Every cell of every sheet of the matching workbooks."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInPandas(_grid_batches, GRID_SCHEMA)


def decode_with_fallback(content: bytes, first: str = "utf-8-sig", fallback: str = "latin-1") -> str:
    """UTF-8 (BOM stripped) when valid, else Latin-1."""
    try:
        return content.decode(first)
    except UnicodeDecodeError:
        return content.decode(fallback)


# ---------------------------------------------------------------------------
# Pivot cache


def parse_pivot_caches(path: str, content: bytes):
    """Yield ``(source, fields, records)`` for every pivot cache of the workbook: fields
    ``(field_idx, field_name, item values)``, records ``(record_idx, field_idx, kind,
    value)``.  ``kind`` is x (index into the field's shared items), n (number), s (inline
    string), m (missing), b/d/e (other).  ``source`` is the path, with ``#2`` and so on
    for the caches after the first."""
    z = zipfile.ZipFile(io.BytesIO(content))
    found = [(int(m[1]), n) for n in z.namelist() if (m := re.match(r"xl/pivotCache/pivotCacheDefinition(\d+)\.xml$", n))]
    for k, (number, name) in enumerate(sorted(found), start=1):
        fields = []
        for fi, cf in enumerate(ET.parse(z.open(name)).getroot().iter(NS + "cacheField")):
            si = cf.find(NS + "sharedItems")
            fields.append((fi, cf.get("name"), [] if si is None else [it.get("v") for it in si]))
        part = f"xl/pivotCache/pivotCacheRecords{number}.xml"
        yield path if k == 1 else f"{path}#{k}", fields, _pivot_records(z, part) if part in z.namelist() else iter(())


def _pivot_records(z: zipfile.ZipFile, part: str):
    ri, whole = 0, None
    for event, el in ET.iterparse(z.open(part), events=("start", "end")):
        if event == "start":
            whole = el if whole is None else whole
        elif el.tag == NS + "r":
            for fi, cell in enumerate(el):
                yield ri, fi, cell.tag.replace(NS, ""), cell.get("v")
            ri += 1
            whole.clear()


def read_pivot_cache(spark: SparkSession, path: str, glob: str = "*.xlsx") -> tuple[DataFrame, DataFrame]:
    """(fields, records) frames; decode with :func:`decode_pivot_records`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")

    def fields_fn(batches):
        for pdf in batches:
            rows = []
            for p, c in zip(pdf["path"], pdf["content"]):
                with _naming(p):
                    for source, fields, _ in parse_pivot_caches(p, bytes(c)):
                        for fi, name, items in fields:
                            if not items:
                                rows.append((source, fi, name, None, None))
                            for ii, v in enumerate(items):
                                rows.append((source, fi, name, ii, v))
            yield pd.DataFrame(rows, columns=["path", "field_idx", "field_name", "item_idx", "item_value"])

    def records_fn(batches):
        def rows():
            for pdf in batches:
                for p, c in zip(pdf["path"], pdf["content"]):
                    with _naming(p):
                        for source, _, recs in parse_pivot_caches(p, bytes(c)):
                            for ri, fi, k, v in recs:
                                yield source, ri, fi, k, v

        yield from _chunked(rows(), ["path", "record_idx", "field_idx", "kind", "value"])

    return files.mapInPandas(fields_fn, PIVOT_FIELD_SCHEMA), files.mapInPandas(records_fn, PIVOT_RECORD_SCHEMA)


def decode_pivot_records(fields: DataFrame, records: DataFrame) -> DataFrame:
    """S10 decode: ``x`` cells look up the field's shared item (equi-join on
    (path, field_idx, item_idx)); n/s keep their value; m is NULL.  Output is
    long: (path, record_idx, field_name, value); pad/trim to the field count is
    implicit (a record cell without a field is dropped, a missing cell is
    absent)."""
    items = fields.where(F.col("item_idx").isNotNull()).select(
        F.col("path").alias("__ipath"), F.col("field_idx").alias("__ifield"), F.col("item_idx").alias("__iitem"),
        F.col("item_value").alias("__ivalue"),
    )
    names = fields.select("path", "field_idx", "field_name").distinct()
    r = records.withColumn("__item", F.when(F.col("kind") == "x", F.col("value").try_cast("int")))
    j = r.join(
        items,
        (F.col("path") == F.col("__ipath")) & (F.col("field_idx") == F.col("__ifield"))
        & (F.col("__item") == F.col("__iitem")),
        "left",
    )
    val = (
        F.when(F.col("kind") == "x", F.col("__ivalue"))
        .when(F.col("kind") == "m", F.lit(None).cast("string"))
        .otherwise(F.col("value"))
    )
    out = j.select("path", "record_idx", "field_idx", val.alias("value"))
    return out.join(names, ["path", "field_idx"], "inner").select("path", "record_idx", "field_name", "value")


# ---------------------------------------------------------------------------
# Workbook sanity (S11) and file digests

REQUIRED_PARTS = ("[Content_Types].xml", "xl/workbook.xml")
MIN_WORKBOOK_BYTES = 10_000


def workbook_parts(spark: SparkSession, path: str, glob: str = "*.xlsx") -> DataFrame:
    """ZIP part names per file (empty for non-ZIP files)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")

    def fn(batches):
        for pdf in batches:
            rows = []
            for p, c in zip(pdf["path"], pdf["content"]):
                try:
                    rows.extend((p, n) for n in zipfile.ZipFile(io.BytesIO(bytes(c))).namelist())
                except zipfile.BadZipFile:
                    continue
            yield pd.DataFrame(rows, columns=["path", "part"])

    return files.mapInPandas(fn, PARTS_SCHEMA)


def workbook_checks(spark: SparkSession, path: str, glob: str = "*.xlsx",
                    min_bytes: int = MIN_WORKBOOK_BYTES, required=REQUIRED_PARTS) -> DataFrame:
    """Per file - size, ZIP magic, SHA-256 and whether the required parts
    exist; ``valid`` combines them."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    base = files.select(
        "path",
        F.col("length").alias("size_bytes"),
        (F.substring("content", 1, 2) == F.lit(b"PK")).alias("zip_magic"),
        F.sha2("content", 256).alias("sha256"),
    )
    parts = workbook_parts(spark, path, glob).where(F.col("part").isin(*required))
    found = parts.groupBy("path").agg(F.countDistinct("part").alias("n_required"))
    out = base.join(found, "path", "left").withColumn("n_required", F.coalesce(F.col("n_required"), F.lit(0)))
    return out.withColumn(
        "valid", (F.col("size_bytes") >= min_bytes) & F.col("zip_magic") & (F.col("n_required") == len(required))
    )
