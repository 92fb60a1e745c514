"""Workbooks as a table of sheet rows.

An ``.xlsx`` file cannot be split, so the unit of work is one file: Spark spreads files
over tasks, and each task opens a file once, however many series are read from it, and
streams its rows out in batches. Everything after that is ordinary DataFrame work.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterable, Iterator
from datetime import datetime, timedelta
from functools import lru_cache
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import column_index
from tidemark.schema import SHEET_ROW
from tidemark.sources.snapshots import read_files

ROWS_PER_BATCH = 8192
CHUNK_BYTES = 1 << 16

# Fixed values of the file format: XML names, built-in date formats, the two day zeros.
NAMESPACE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
MAIN = f"{{{NAMESPACE}}}"
ROW, CELL, VALUE, TEXT, PHONETIC = (f"{NAMESPACE}}}{tag}" for tag in ("row", "c", "v", "t", "rPh"))
RELATION_ID = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
DATE_FORMAT_IDS = frozenset([*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)])
DAY_ZERO = datetime(1899, 12, 30)
DAY_ZERO_1904 = datetime(1904, 1, 1)

_ARROW_ROW = pa.schema(
    [
        ("path", pa.string()),
        ("sheet", pa.string()),
        ("row_idx", pa.int32()),
        ("cells", pa.list_(pa.string())),
    ]
)


def read_workbooks(
    spark: SparkSession,
    path: str | list[str],
    sheets: Iterable[str] | None = None,
    glob: str = "*.xlsx",
) -> DataFrame:
    """Sheet rows of all workbooks under ``path``."""
    return sheet_rows(read_files(spark, path, glob), sheets)


def sheet_rows(files: DataFrame, sheets: Iterable[str] | None = None) -> DataFrame:
    """``(path, sheet, row_idx, cells)`` of a table of ``(path, content)``.

    ``row_idx`` and the positions in ``cells`` count from 0 at the top left; blank cells
    are null. Cells with a date format become ISO text, other numbers keep their text.
    """
    wanted = None if sheets is None else frozenset(sheets)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                if content.is_valid:
                    yield from _batches(_rows(path.as_py(), content.as_buffer(), wanted))

    return files.select("path", "content").mapInArrow(read, SHEET_ROW)


def cells_of_rows(rows: DataFrame) -> DataFrame:
    """Long form ``(path, sheet, row_idx, col_idx, value)`` without the blank cells."""
    return rows.select(
        "path", "sheet", "row_idx", F.posexplode("cells").alias("col_idx", "value")
    ).where(F.col("value").isNotNull())


def _batches(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS_PER_BATCH:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    arrays = [pa.array(column, type=f.type) for column, f in zip(zip(*rows), _ARROW_ROW)]
    return pa.RecordBatch.from_arrays(arrays, schema=_ARROW_ROW)


def _rows(path: str, content, wanted: frozenset[str] | None) -> Iterator[tuple]:
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        names, day_zero = _sheets(book)
        strings = _shared_strings(book)
        date_styles = _date_styles(book)
        for name, part in names:
            if wanted is None or name in wanted:
                with book.open(part) as stream:
                    for row_idx, cells in _sheet(stream, strings, date_styles, day_zero):
                        yield path, name, row_idx, cells


def _sheets(book: zipfile.ZipFile) -> tuple[list[tuple[str, str]], datetime]:
    tree = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    target = {link.get("Id"): link.get("Target") for link in links}
    found = []
    for sheet in tree.iter(f"{MAIN}sheet"):
        part = target[sheet.get(RELATION_ID)]
        found.append((sheet.get("name"), part[1:] if part.startswith("/") else f"xl/{part}"))
    settings = tree.find(f"{MAIN}workbookPr")
    since_1904 = settings is not None and settings.get("date1904") in ("1", "true")
    return found, DAY_ZERO_1904 if since_1904 else DAY_ZERO


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    texts = []
    with book.open("xl/sharedStrings.xml") as stream:
        for _, node in ElementTree.iterparse(stream):
            if node.tag == f"{MAIN}si":
                texts.append(_text(node))
                node.clear()
    return texts


def _text(node: ElementTree.Element) -> str:
    # Phonetic runs (rPh) repeat the text and are not part of the value.
    parts = [child.text or "" for child in node.findall(f"{MAIN}t")]
    parts += [t.text or "" for run in node.findall(f"{MAIN}r") for t in run.findall(f"{MAIN}t")]
    return "".join(parts)


def _date_styles(book: zipfile.ZipFile) -> frozenset[int]:
    if "xl/styles.xml" not in book.namelist():
        return frozenset()
    tree = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {
        int(f.get("numFmtId")): _is_date_format(f.get("formatCode") or "")
        for f in tree.iter(f"{MAIN}numFmt")
    }
    formats = tree.find(f"{MAIN}cellXfs")
    ids = [] if formats is None else [int(x.get("numFmtId") or 0) for x in formats]
    return frozenset(
        i for i, number in enumerate(ids) if custom.get(number, number in DATE_FORMAT_IDS)
    )


def _is_date_format(code: str) -> bool:
    bare = re.sub(r'"[^"]*"|\\.|\[(?![hms]+\])[^\]]*\]', "", code.lower())
    return re.search(r"[ymdhs]", bare) is not None and "general" not in bare


def _sheet(
    stream, strings: list[str], date_styles: frozenset[int], day_zero: datetime
) -> Iterator[tuple[int, list[str | None]]]:
    sheet = _SheetParser(strings, date_styles, day_zero)
    while chunk := stream.read(CHUNK_BYTES):
        sheet.parser.Parse(chunk, False)
        yield from sheet.finished
        sheet.finished.clear()
    sheet.parser.Parse(b"", True)
    yield from sheet.finished


class _SheetParser:
    """Event handlers of one sheet; holds the rows just finished. The handlers run for every
    element, so they share local names in place of attributes."""

    def __init__(self, strings: list[str], date_styles: frozenset[int], day_zero: datetime):
        self.finished = finished = []
        self.parser = parser = expat.ParserCreate(namespace_separator="}")
        row_idx, position, style, kind = -1, 0, 0, "n"
        cells: list[str | None] = []
        text: list[str] = []
        wanted = phonetic = False

        def start(name: str, attributes: dict[str, str]) -> None:
            nonlocal row_idx, position, style, kind, cells, wanted, phonetic
            if name == VALUE:
                wanted = True
            elif name == CELL:
                reference = attributes.get("r")
                position = _position(reference) if reference else len(cells)
                kind = attributes.get("t", "n")
                style = int(attributes.get("s", 0))
                text.clear()
            elif name == TEXT:
                wanted = wanted or not phonetic
            elif name == ROW:
                number = attributes.get("r")
                row_idx = int(number) - 1 if number else row_idx + 1
                cells = []
            elif name == PHONETIC:
                phonetic = True

        def data(piece: str) -> None:
            if wanted:
                text.append(piece)

        def end(name: str) -> None:
            nonlocal wanted, phonetic
            if name == VALUE or name == TEXT:
                wanted = False
            elif name == CELL:
                if position >= len(cells):
                    cells.extend([None] * (position + 1 - len(cells)))
                if not text:
                    cells[position] = None
                elif kind == "n" and style not in date_styles:
                    cells[position] = "".join(text)
                else:
                    cells[position] = value("".join(text))
            elif name == ROW:
                finished.append((row_idx, cells))
            elif name == PHONETIC:
                phonetic = False

        def value(found: str) -> str | None:
            if kind == "n":
                return _date_text(found, day_zero)
            if kind == "s":
                return strings[int(found)]
            if kind == "b":
                return "True" if found == "1" else "False"
            return None if kind == "e" else found

        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler = start, end
        parser.CharacterDataHandler = data


@lru_cache(maxsize=1 << 14)
def _date_text(days: str, day_zero: datetime) -> str:
    return (day_zero + timedelta(milliseconds=round(float(days) * 86_400_000))).isoformat(sep=" ")


@lru_cache(maxsize=None)
def _column(letters: str) -> int:
    return column_index(letters)


def _position(reference: str) -> int:
    return _column(reference.rstrip("0123456789"))
