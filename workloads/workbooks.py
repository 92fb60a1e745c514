"""Workbooks made by Spark tasks from table rows, as input for the workbook reader."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


# Fixed values of the file format.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE_REL = "http://schemas.openxmlformats.org/package/2006/relationships"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'


def letters(position: int) -> str:
    """Column letters of a zero-based position."""
    text = ""
    while position >= 0:
        text = chr(65 + position % 26) + text
        position = position // 26 - 1
    return text


def workbook_bytes(sheets: dict[str, list[list]], date_style: bool = True, date1904: bool = False) -> bytes:
    """A minimal workbook. Cells: None, bool, number, text, or ("date", serial number)."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        entries, links = [], []
        for number, (name, rows) in enumerate(sheets.items(), 1):
            entries.append(f'<sheet name="{_escape(name)}" sheetId="{number}" r:id="rId{number}"/>')
            links.append(
                f'<Relationship Id="rId{number}" Type="{_REL}/worksheet" '
                f'Target="worksheets/sheet{number}.xml"/>'
            )
            book.writestr(f"xl/worksheets/sheet{number}.xml", _sheet(rows))
        settings = '<workbookPr date1904="1"/>' if date1904 else ""
        book.writestr(
            "xl/workbook.xml",
            f'{_HEAD}<workbook xmlns="{_MAIN}" xmlns:r="{_REL}">{settings}'
            f'<sheets>{"".join(entries)}</sheets></workbook>',
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            f'{_HEAD}<Relationships xmlns="{_PACKAGE_REL}">{"".join(links)}</Relationships>',
        )
        if date_style:
            book.writestr(
                "xl/styles.xml",
                f'{_HEAD}<styleSheet xmlns="{_MAIN}"><cellXfs count="2">'
                '<xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
            )
    return out.getvalue()


def _sheet(rows: list[list]) -> str:
    lines, names = [], []
    for number, row in enumerate(rows, 1):
        while len(names) < len(row):
            names.append(letters(len(names)))
        cells = "".join([_cell(f"{name}{number}", value) for name, value in zip(names, row)])
        lines.append(f'<row r="{number}">{cells}</row>')
    return f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>{"".join(lines)}</sheetData></worksheet>'


def _cell(reference: str, value) -> str:
    if value is None:
        return ""
    kind = type(value)
    if kind is int or kind is float:
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    if isinstance(value, tuple):
        return f'<c r="{reference}" s="1"><v>{value[1]}</v></c>'
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (int, float)):
        return f'<c r="{reference}"><v>{value!r}</v></c>'
    return f'<c r="{reference}" t="inlineStr"><is><t>{_escape(value)}</t></is></c>'


def _escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;").replace('"', "&quot;")


def workbooks_of(rows: DataFrame, sheet: str, date_column: str) -> DataFrame:
    """``(path, content)``: one workbook per Arrow batch of ``rows``, nothing shuffled.

    ``date_column`` holds days since 1899-12-30 and becomes a date cell.
    """
    names = rows.columns
    dated = names.index(date_column)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            lines = [list(names)]
            for values in zip(*[column.to_pylist() for column in batch.columns]):
                line = list(values)
                line[dated] = ("date", line[dated])
                lines.append(line)
            first = "-".join(str(v) for v in lines[1])
            content = workbook_bytes({sheet: lines})
            yield pa.RecordBatch.from_pydict({"path": [f"{first}.xlsx"], "content": [content]})

    return rows.mapInArrow(build, "path string, content binary")


__all__ = ["letters", "workbook_bytes", "workbooks_of"]
