"""Test helpers: a minimal xlsx writer (inline strings, optional pivot cache)."""

import os
import zipfile

NS = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
R_NS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def write_workbook(path, sheets, pivot=None, pad_to=0):
    """Write a minimal xlsx: sheets = {name: [[cell, ...], ...]} (inline strings)."""
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("[Content_Types].xml", "<Types/>")
        wb = "".join(f'<sheet name="{n}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{NS}" xmlns:r="{R_NS}"><sheets>{wb}</sheets></workbook>')
        rels = "".join(
            f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml" '
            f'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet"/>'
            for i in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels",
                   f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{rels}'
                   '</Relationships>')
        for i, rows in enumerate(sheets.values(), 1):
            body = []
            for r, row in enumerate(rows, 1):
                cells = []
                for c, v in enumerate(row):
                    if v is None:
                        continue
                    ref = f"{chr(65 + c)}{r}"
                    if isinstance(v, (int, float)):
                        cells.append(f'<c r="{ref}"><v>{v}</v></c>')
                    else:
                        cells.append(f'<c r="{ref}" t="inlineStr"><is><t>{v}</t></is></c>')
                body.append(f'<row r="{r}">{"".join(cells)}</row>')
            z.writestr(f"xl/worksheets/sheet{i}.xml", f'<worksheet xmlns="{NS}"><sheetData>{"".join(body)}'
                                                       "</sheetData></worksheet>")
        if pivot:
            fields, records = pivot
            fx = "".join(
                f'<cacheField name="{n}"><sharedItems>{"".join(f"<s v={chr(34)}{x}{chr(34)}/>" for x in items)}'
                "</sharedItems></cacheField>" for n, items in fields)
            z.writestr("xl/pivotCache/pivotCacheDefinition1.xml",
                       f'<pivotCacheDefinition xmlns="{NS}"><cacheFields>{fx}</cacheFields></pivotCacheDefinition>')
            rx = "".join("<r>" + "".join(f'<{k} v="{v}"/>' if v is not None else f"<{k}/>" for k, v in rec) + "</r>"
                         for rec in records)
            z.writestr("xl/pivotCache/pivotCacheRecords1.xml", f'<pivotCacheRecords xmlns="{NS}">{rx}</pivotCacheRecords>')
        if pad_to:
            z.writestr("xl/media/pad.bin", os.urandom(pad_to))


