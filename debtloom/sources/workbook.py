"""A small spreadsheet writer for reports. Rows pass through the driver partition by partition; none is left out."""

from __future__ import annotations

import zipfile
from collections.abc import Mapping
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame

#: Rows that the format allows in a sheet, the heading among them; a longer table goes on in further sheets.
SHEET_ROWS = 1_048_576

_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def _column(n: int) -> str:
    out = ""
    while n:
        n, r = divmod(n - 1, 26)
        out = chr(65 + r) + out
    return out


def _cell(r: int, c: int, v: object) -> str:
    at = f"{_column(c)}{r}"
    if v is None:
        return ""
    if isinstance(v, bool):
        v = "Yes" if v else "No"
    if isinstance(v, (int, float)):
        return f'<c r="{at}"><v>{v}</v></c>'
    text = "".join(x for x in str(v) if x >= " " or x in "\n\t")
    return f'<c r="{at}" t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'


def _write_sheets(z: zipfile.ZipFile, name: str, df: DataFrame, at: int, ns: str) -> tuple[list[str], int]:
    """The names of the sheets a table takes, from number ``at`` on, and its rows."""
    names: list[str] = []
    rows, total, more = df.toLocalIterator(), 0, True
    head = f'{_HEAD}<worksheet {ns}><sheetViews><sheetView workbookViewId="0"><pane ySplit="1" topLeftCell="A2" state="frozen"/></sheetView></sheetViews><sheetData>'
    row = next(rows, None)
    while more:
        names.append(name[:31] if not names else f"{name[:25]} ({len(names) + 1})")
        with z.open(f"xl/worksheets/sheet{at + len(names) - 1}.xml", "w", force_zip64=True) as f:
            f.write((head + f'<row r="1">{"".join(_cell(1, c, n) for c, n in enumerate(df.columns, 1))}</row>').encode())
            r = 1
            while row is not None and r < SHEET_ROWS:
                r += 1
                total += 1
                f.write(f'<row r="{r}">{"".join(_cell(r, c, v) for c, v in enumerate(row, 1))}</row>'.encode())
                row = next(rows, None)
            f.write(b"</sheetData></worksheet>")
        more = row is not None
    return names, total


def write_workbook(path: str, sheets: Mapping[str, DataFrame]) -> dict[str, int]:
    """Write each table to a sheet, or several, with its column names on top; returns the rows of each."""
    counts: dict[str, int] = {}
    names: list[str] = []
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    kind, rel = "application/vnd.openxmlformats-officedocument.spreadsheetml", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, df in sheets.items():
            more, counts[name] = _write_sheets(z, name, df, len(names) + 1, ns)
            names += more
        every = list(enumerate(names, 1))
        z.writestr("[Content_Types].xml", f'{_HEAD}<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>' + "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i, _ in every) + "</Types>")
        z.writestr("_rels/.rels", f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="rId1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        z.writestr("xl/workbook.xml", f'{_HEAD}<workbook {ns} xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in every) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", f'{_HEAD}<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{i}" Type="{rel}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i, _ in every) + "</Relationships>")
    return counts
