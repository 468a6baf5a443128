"""Readers on generated files: workbook grid, pivot cache, series CSV, message
log, release pages, workbook sanity."""

import io
import json
import os
import zipfile

import pytest
from pyspark.sql import functions as F

from tidemark.operators.shape import header_rows
from tidemark.sources import readers, xlsx

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


from tests_helpers import write_workbook as _workbook


def test_grid_and_header_detection(spark, tmp_root):
    d = os.path.join(tmp_root, "wb")
    os.makedirs(d)
    _workbook(os.path.join(d, "a.xlsx"), {
        "Data": [["Table 1: Country of birth"], [], ["Country", "Year", "Count"], ["India", 2024, 5], ["Chile", 2024, 3]],
        "Other": [["Country", "Year", "Count"], ["Nepal", 2023, 1]],
    })
    g = xlsx.read_grid(spark, d)
    rows = g.where(F.col("sheet") == "Data").orderBy("row_idx").collect()
    assert [r.row_idx for r in rows] == [0, 1, 2, 3, 4]
    assert rows[3].cells == ["India", "2024", "5"]
    hdr = {r.sheet: r.header_row for r in header_rows(g, hint="country", min_nonnull=3).collect()}
    assert hdr == {"Data": 2, "Other": 0}
    naive = {r.sheet: r.header_row for r in header_rows(g, hint="country").collect()}
    assert naive["Data"] == 0  # a title row holding the hint fools the hint-only rule


def test_pivot_cache_decode(spark, tmp_root):
    d = os.path.join(tmp_root, "pc")
    os.makedirs(d)
    fields = [("Nationality", ["India", "China"]), ("Sector", ["VET"]), ("Total", [])]
    records = [[("x", 0), ("x", 0), ("n", 1)], [("x", 1), ("m", None), ("n", 7)], [("s", "Nepal"), ("x", 0), ("n", 2)]]
    _workbook(os.path.join(d, "p.xlsx"), {"S": [["x"]]}, pivot=(fields, records))
    f, r = xlsx.read_pivot_cache(spark, d)
    dec = xlsx.decode_pivot_records(f, r)
    wide = dec.groupBy("record_idx").pivot("field_name", ["Nationality", "Sector", "Total"]).agg(F.first("value"))
    got = sorted(tuple(x) for x in wide.orderBy("record_idx").collect())
    assert got == [(0, "India", "VET", "1"), (1, "China", None, "7"), (2, "Nepal", "VET", "2")]


def test_workbook_checks(spark, tmp_root):
    d = os.path.join(tmp_root, "chk")
    os.makedirs(d)
    _workbook(os.path.join(d, "good.xlsx"), {"S": [["a"]]}, pad_to=20000)
    _workbook(os.path.join(d, "small.xlsx"), {"S": [["a"]]})
    with open(os.path.join(d, "page.xlsx"), "w") as fh:
        fh.write("<html>not a workbook</html>" * 500)
    with zipfile.ZipFile(os.path.join(d, "noparts.xlsx"), "w") as z:
        z.writestr("other.txt", os.urandom(20000).hex())
    res = {os.path.basename(r.path): r.valid for r in xlsx.workbook_checks(spark, d).collect()}
    assert res == {"good.xlsx": True, "small.xlsx": False, "page.xlsx": False, "noparts.xlsx": False}


def test_series_csv(spark, tmp_root):
    d = os.path.join(tmp_root, "csv")
    os.makedirs(d)
    text = (
        "﻿F11.1 EXCHANGE RATES\n"
        "Title,AUD/USD Exchange Rate,Trade-weighted Index\n"
        "Units,USD,Index\n"
        "Frequency,Daily,Daily\n"
        "Series ID,FXRUSD,FXRTWI\n"
        "29-Jan-2010,0.8929,68.9\n"
        "01-Feb-2010,0.8850\n"  # short row: missing tail
        "02-Feb-2010,n.a.,70.1\n"
    )
    with open(os.path.join(d, "f11.csv"), "w", encoding="utf-8") as fh:
        fh.write(text)
    out = readers.read_series_csv(spark, d).orderBy("date", "series_id").collect()
    got = [(str(r.date), r.series_id, r.value, r.units) for r in out]
    assert got == [("2010-01-29", "FXRTWI", 68.9, "Index"), ("2010-01-29", "FXRUSD", 0.8929, "USD"),
                   ("2010-02-01", "FXRUSD", 0.885, "USD"), ("2010-02-02", "FXRTWI", 70.1, "Index")]


def test_latin1_fallback():
    assert xlsx.decode_with_fallback("Côte".encode("latin-1")) == "Côte"
    assert xlsx.decode_with_fallback("﻿abc".encode("utf-8")) == "abc"


def test_message_log_cells(spark, tmp_root):
    msg = {"requests": [json.dumps({"method": "GetLayout", "id": 1})],
           "responses": [json.dumps({"method": "GetHyperCubeData", "id": 2, "result": {"qDataPages": [
               {"qMatrix": [[{"qText": "261313", "qNum": 261313}, {"qText": "Software Engineer"}],
                            [{"qText": "261312", "qNum": 261312}, {"qText": "Developer"}]]}]}})]}
    p = os.path.join(tmp_root, "log.json")
    with open(p, "w") as fh:
        json.dump(msg, fh)
    m = readers.read_messages(spark, p)
    cells = readers.hypercube_cells(m).orderBy("row_idx", "col_idx").collect()
    assert [(c.row_idx, c.col_idx, c.text) for c in cells] == [
        (0, 0, "261313"), (0, 1, "Software Engineer"), (1, 0, "261312"), (1, 1, "Developer")]
    hist = {r.method: r.n for r in readers.method_histogram(m).collect()}
    assert hist == {"GetLayout": 1, "GetHyperCubeData": 1}


def _block(label, href):
    return (f'<h3>{label}</h3><ul><li><a class="file type-xlsx" href="{href}">'
            '<span>Download</span></a></li></ul>')


def test_release_pages(spark):
    base = "https://releases.example.org"
    pages = {
        1: _block("May 2026 Latest data", "/download/1/may-latest/xlsx") + _block("May 2026 All data", "/download/2/x/xlsx")
        + _block("December 2025 Latest data", "/download/3/x/xlsx") + _block("December 2025 All data", "/download/4/x/xlsx"),
        2: _block("June 2026 Latest data", "/download/5/x/xlsx") + _block("May 2026 Latest data", "/download/1/x/xlsx")
        + _block("May 2026 All data", "/download/2/x/xlsx"),
        3: _block("June 2026 Latest data", "/download/5/x/xlsx") + _block("May 2026 All data", "/download/2/x/xlsx"),
    }
    df = spark.createDataFrame([(k, v) for k, v in pages.items()], "page_id INT, html STRING")
    links = readers.release_links(df, base)
    for pid, want in ((1, (2026, 5)), (2, (2026, 5)), (3, None)):
        got = readers.newest_complete_release(links.where(F.col("page_id") == pid)).collect()
        assert (tuple(got[0]) if got else None) == want
    urls = spark.createDataFrame([(f"{base}/download/1/x/xlsx",), ("https://evil.example.com/download/x/xlsx",),
                                  ("http://releases.example.org/download/1/x/xlsx",), (f"{base}/other/x/xlsx",),
                                  (f"{base}/download/1/x/pdf",)], "u STRING")
    ok = [r.ok for r in urls.select(readers.allowed_url(F.col("u"), "releases.example.org").alias("ok")).collect()]
    assert ok == [True, False, False, False, False]


def test_detailed_enrolment_sheet_keeps_every_dimension(spark, tmp_root):
    """Fixture A1: three detailed rows; month Dec -> 12; provider_type kept; total
    dropped; the 8-column basic key rejects them, the 14-column key accepts."""
    import pytest

    from tidemark.operators.quality import redundant_share
    from tidemark.plans import loaders
    from tidemark.sources import sinks

    header = ["Year", "Month", "Region", "Nationality", "State", "ProviderType", "Sector",
              "Broad_Field_Of_Education", "Narrow_Field_Of_Education", "Detailed_Field_Of_Education",
              "Level_Of_Study", "Foundation", "New_to_Australia", "Ends_This_Year", "DATA_YTD_Enrolments",
              "DATA_YTD_Commencements", "DATA_As_at_1st_Month", "DATA_Enrolments_for_Month",
              "DATA_Commencements_for_Month", "Total"]
    rows = [
        [2024, "Dec", "Americas", "Chile", "SA", "Non Government", "ELICOS", "Society and Culture",
         "Language and Literature", "ELICOS", "Non AQF Award", "No", "No", "No", 8, 8, 7, 8, 1, 8],
        [2024, "Dec", "Americas", "Chile", "SA", "Non Government", "ELICOS", "Natural and Physical Sciences",
         "Other Natural and Physical Sciences", "Medical Science", "Bachelor Degree", "No", "No", "No", 5, 2, 5, 5, 0, 5],
        [2024, "Dec", "South-East Asia", "Vietnam", "NSW", "Government", "Higher Education", "Information Technology",
         "Other Information Technology", "Information Technology, n.e.c.", "Bachelor Degree", "No", "Yes", "No",
         12, 12, 10, 12, 2, 12],
    ]
    d = os.path.join(tmp_root, "edu")
    os.makedirs(d)
    _workbook(os.path.join(d, "detailed.xlsx"), {"Notes": [["About this release"]],
                                                  "Data": [["Detailed enrolments"], [], header, *rows]})
    grid = xlsx.read_grid(spark, d)
    raw = loaders.parse_enrolment_grid(grid, "detailed")
    out = raw.collect()
    assert len(out) == 3 and all(r.enrol_month == 12 for r in out)
    assert "provider_type" in raw.columns and "total" not in raw.columns
    with_total = loaders.parse_enrolment_grid(grid, "basic")
    assert redundant_share(with_total, "total", "ytd_enrolments").first().same_pct == 100.0
    with pytest.raises(sinks.LoadError):
        sinks.replace_table(spark, raw, os.path.join(tmp_root, "pub"), "basic", list(loaders.BASIC_KEY))
    ok = sinks.replace_table(spark, raw, os.path.join(tmp_root, "pub"), "detailed", list(loaders.DETAILED_KEY))
    assert ok.rows_written == 3


def test_alias_csv_with_quoted_comma(spark, tmp_root):
    p = os.path.join(tmp_root, "aliases.csv")
    with open(p, "w", encoding="utf-8-sig") as fh:
        fh.write("canonical_name,iso_alpha2,name_education\n"
                 'South Korea,KR,"Korea, Republic of"\nIndia,IN,India\n')
    df = readers.read_csv(spark, p, schema="canonical_name STRING, iso_alpha2 STRING, name_education STRING")
    got = {r.canonical_name: r.name_education for r in df.collect()}
    assert got == {"South Korea": "Korea, Republic of", "India": "India"}


def test_series_csv_is_as_wide_as_its_files(spark, tmp_root):
    d = os.path.join(tmp_root, "wide")
    os.makedirs(d)
    n = 1500
    with open(os.path.join(d, "w.csv"), "w") as fh:
        fh.write("F99\ntitle," + ",".join(f'"T, {i}"' for i in range(n)) + "\nseries_id," + ",".join(f"S{i}" for i in range(n)) + "\n")
        fh.write("01-Jan-2020," + ",".join(str(i) for i in range(n)) + "\n")
    out = readers.read_series_csv(spark, d)
    got = {r.series_id: (r.value, r.title) for r in out.collect()}
    assert len(got) == n and got["S1499"] == (1499.0, "T, 1499")
    with open(os.path.join(d, "bad.csv"), "w") as fh:
        fh.write("Title,a\n01-Jan-2020,1\n")
    with pytest.raises(ValueError, match="bad.csv"):
        readers.read_series_csv(spark, d)


def test_message_log_of_objects(spark, tmp_root):
    page = {"qDataPages": [{"qMatrix": [[{"qText": "a", "qNum": 1}, {"qText": "b", "qNum": "NaN"}]]}]}
    log = [{"dir": "recv", "ts": "t1", "data": {"id": 7, "result": {"x": [{"deep": page}]}}},
           {"dir": "sent", "ts": "t2", "data": {"result": page}}, {"direction": "recv", "data": {"nothing": 1}}]
    p = os.path.join(tmp_root, "list.json")
    with open(p, "w") as fh:
        json.dump(log, fh)
    cells = readers.hypercube_cells(readers.read_messages(spark, p)).orderBy("col_idx").collect()
    assert [(c.id, c.ts, c.col_idx, c.text, c.number) for c in cells] == [(7, "t1", 0, "a", 1.0), (7, "t1", 1, "b", None)]


def test_broken_workbook_fails_with_its_path(spark, tmp_root):
    d = os.path.join(tmp_root, "broken")
    os.makedirs(d)
    _workbook(os.path.join(d, "a.xlsx"), {"S": [["a"]]})
    with open(os.path.join(d, "torn.xlsx"), "wb") as fh:
        fh.write(b"PK not really")
    with pytest.raises(Exception, match="torn.xlsx"):
        xlsx.read_grid(spark, d).collect()


def _cells_of(spark, *messages):
    rows = [(i, None, json.dumps(m) if not isinstance(m, str) else m) for i, m in enumerate(messages)]
    df = spark.createDataFrame(rows, "id BIGINT, dir STRING, json STRING").withColumn("ts", F.lit("t"))
    return {r.id: r.text for r in readers.hypercube_cells(df).collect()}


def test_data_pages_at_any_place(spark):
    def page(text):
        return {"qDataPages": [{"qMatrix": [[{"qText": text}]]}]}

    def under(levels, part):
        for i in range(levels):
            part = [0, part] if i % 2 else {"k": part, "a": {"x": None}}
        return part

    eight, nine = under(8, page("eight")), under(9, page("nine"))
    assert _cells_of(spark, {"data": page("top")}, {"data": eight}, {"data": nine}, page("whole message"), {"data": {"qDataPages": None, "b": page("no")}},
                     {"data": {"z": page("first in the text"), "a": page("later")}}, {"data": {"z": {"qDataPages": []}, "a": page("not empty")}},
                     {"data": [page("one"), page("two")]}, {"data": {"s": json.dumps(page("text only"))}}, "no json", "[1, 2]", "7",
                     {"data": {"x": {"q": [{"b.c": {"deep": page("dotted")}}], "p": page("after")}}}) == {
        0: "top", 1: "eight", 3: "whole message", 5: "first in the text", 6: "not empty", 7: "one", 12: "dotted"}


def test_cells_of_every_kind(spark):
    matrix = [[{"qText": "a", "qNum": 1}, "no cell", {"qNum": 2.5}], [], [{"qText": "c", "qNum": "3"}, {"qText": None, "qNum": True}, {"qText": "d", "qNum": 1e300}]]
    m = json.dumps({"data": {"qDataPages": [{"other": 1}, {"qMatrix": matrix}, {"qMatrix": None}]}})
    df = spark.createDataFrame([(1, "t", "recv", m), (2, "t", "sent", m), (3, "t", None, None)], "id BIGINT, ts STRING, dir STRING, json STRING")
    out = readers.hypercube_cells(df)
    assert "MapIn" not in out._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.page_idx, r.row_idx, r.col_idx): (r.text, r.number) for r in out.collect()}
    assert got == {(1, 1, 0, 0): ("a", 1.0), (1, 1, 0, 2): (None, 2.5), (1, 1, 2, 0): ("c", None), (1, 1, 2, 1): (None, None), (1, 1, 2, 2): ("d", 1e300)}
