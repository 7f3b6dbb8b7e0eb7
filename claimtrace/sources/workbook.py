"""Workbook files as rows of cells.

Spark has no reader for xlsx, so this is the one place where Python opens the
files: one task per group of files, each sheet streamed from the zip archive. A
sheet has at most 1,048,576 rows by format, so no file can grow beyond that.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import datetime, timedelta
from io import BytesIO
from typing import NamedTuple
from xml.etree import ElementTree
from zipfile import ZipFile

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The reader runs on executors, which need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Wanted(NamedTuple):
    """A sheet to read: its role, its name, and whether the active sheet may stand in."""

    role: str
    sheet: str
    or_active: bool


# Sheets of the known workbooks, smallest file taken for a workbook.
SHIPMENT_SHEETS = (Wanted("shipments", "Sheet1", True),)
RMA_SHEETS = (Wanted("credits", "Summary", True), Wanted("claims", "Data", False))
SMALLEST_FILE = 100
# Numbers of the built-in date formats.
DATE_FORMATS = frozenset((*range(14, 23), 45, 46, 47))

GRID = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("role", T.StringType()),
        T.StructField("row", T.LongType()),
        T.StructField("cells", T.ArrayType(T.StringType())),
        T.StructField("error", T.StringType()),
    ]
)

_BATCH = 5_000


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _elements(stream, parent: str, name: str):
    """The elements of one name below ``parent``, each dropped from memory once used."""
    holder = None
    for event, element in ElementTree.iterparse(stream, events=("start", "end")):
        if event == "start":
            if holder is None and _local(element.tag) == parent:
                holder = element
        elif holder is not None and _local(element.tag) == name:
            yield element
            holder.clear()


def _plain_text(element) -> str:
    """All text runs of a string item, without phonetic guides."""
    parts = []
    for child in element:
        kind = _local(child.tag)
        if kind == "t":
            parts.append(child.text or "")
        elif kind == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _is_date_code(code: str) -> bool:
    """A number format with a date or time letter outside quotes, brackets and escapes."""
    i, bare = 0, []
    while i < len(code):
        c = code[i]
        if c == '"' or c == "[":
            end = code.find('"' if c == '"' else "]", i + 1)
            i = len(code) if end < 0 else end + 1
        elif c in "\\_*":
            i += 2
        else:
            bare.append(c.lower())
            i += 1
    first_section = "".join(bare).split(";")[0]
    return any(c in "dmyhs" for c in first_section.replace("general", ""))


def _date_styles(book: ZipFile) -> frozenset[int]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in book.namelist():
        return frozenset()
    custom: dict[int, str] = {}
    styles: list[int] = []
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    for section in root:
        if _local(section.tag) == "numFmts":
            for item in section:
                custom[int(item.get("numFmtId"))] = item.get("formatCode") or ""
        elif _local(section.tag) == "cellXfs":
            styles = [int(item.get("numFmtId") or 0) for item in section]
    return frozenset(
        i
        for i, number in enumerate(styles)
        if (_is_date_code(custom[number]) if number in custom else number in DATE_FORMATS)
    )


def _shared_strings(book: ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    with book.open("xl/sharedStrings.xml") as stream:
        return [_plain_text(item) for item in _elements(stream, "sst", "si")]


def _sheets(book: ZipFile) -> tuple[dict[str, str], str | None, bool]:
    """Sheet name to archive member, name of the active sheet, and the date system."""
    targets = {
        item.get("Id"): item.get("Target")
        for item in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    }
    names, active, from_1904 = {}, 0, False
    for section in ElementTree.fromstring(book.read("xl/workbook.xml")):
        kind = _local(section.tag)
        if kind == "workbookPr":
            from_1904 = section.get("date1904") in ("1", "true")
        elif kind == "bookViews" and len(section):
            active = int(section[0].get("activeTab") or 0)
        elif kind == "sheets":
            for sheet in section:
                link = next(v for k, v in sheet.attrib.items() if _local(k) == "id")
                target = targets[link]
                names[sheet.get("name")] = (
                    target.lstrip("/") if target.startswith("/") else "xl/" + target
                )
    order = list(names)
    return names, order[min(active, len(order) - 1)] if order else None, from_1904


def _date_text(serial: float, from_1904: bool) -> str:
    """A day number as ``YYYY-MM-DD HH:MM:SS``; below one day only the time."""
    moment = timedelta(milliseconds=round(serial * 86_400_000))
    if 0 <= serial < 1:
        return str((datetime(1900, 1, 1) + moment).time())
    if from_1904:
        return str(datetime(1904, 1, 1) + moment)
    # The 1900 system counts a 29 February 1900 that never was.
    start = datetime(1899, 12, 31) if serial < 60 else datetime(1899, 12, 30)
    return str(start + moment)


def _cell_text(cell, strings: list[str], dates: frozenset[int], from_1904: bool) -> str | None:
    """Text of a cell value; None for an empty cell."""
    kind = cell.get("t") or "n"
    value = None
    for child in cell:
        name = _local(child.tag)
        if name == "v":
            value = child.text
        elif name == "is" and kind == "inlineStr":
            return _plain_text(child)
    if value is None:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "True" if value == "1" else "False"
    if kind == "d":
        return value.replace("T", " ").rstrip("Z")
    if kind != "n":
        return value
    if int(cell.get("s") or 0) in dates:
        return _date_text(float(value), from_1904)
    # Whole numbers keep all digits and get no decimal point.
    return str(float(value)) if any(c in value for c in ".eE") else str(int(value))


def _column(letters: str) -> int:
    """Zero-based column of the letters of a reference such as ``AB12``."""
    number = 0
    for c in letters.upper():
        number = number * 26 + ord(c) - 64
    return number - 1


def _rows(book: ZipFile, member: str, strings, dates, from_1904):
    """Row number and cells of each row that has any value."""
    number = 0
    columns: dict[str, int] = {}
    with book.open(member) as stream:
        for row in _elements(stream, "sheetData", "row"):
            number = int(row.get("r") or number + 1)
            cells: list[str | None] = []
            for cell in row:
                letters = (cell.get("r") or "").rstrip("0123456789")
                if letters and letters not in columns:
                    columns[letters] = _column(letters)
                column = columns[letters] if letters else len(cells)
                cells.extend([None] * (column + 1 - len(cells)))
                cells[column] = _cell_text(cell, strings, dates, from_1904)
            if any(c is not None for c in cells):
                yield number, cells


def _read(path: str, name: str, content: bytes, wanted: Sequence[Wanted]):
    """Grid rows of one workbook; an unreadable one yields a single row with the error."""
    if content is None or len(content) < SMALLEST_FILE:
        yield path, name, None, None, None, "empty or too small"
        return
    try:
        with ZipFile(BytesIO(content)) as book:
            members, active, from_1904 = _sheets(book)
            strings, dates = _shared_strings(book), _date_styles(book)
            for want in wanted:
                sheet = want.sheet if want.sheet in members else None
                if sheet is None and want.or_active:
                    sheet = active
                if sheet is None:
                    continue
                for number, cells in _rows(book, members[sheet], strings, dates, from_1904):
                    yield path, name, want.role, number, cells, None
    except Exception as error:  # one bad file must not stop the others
        yield path, name, None, None, None, f"{type(error).__name__}: {error}"


def scan_workbook(files: DataFrame, wanted: Sequence[Wanted]) -> DataFrame:
    """Rows of the wanted sheets: ``path file_name role row cells error``.

    ``files`` needs ``path``, ``file_name`` and ``content``. Empty rows are left out.
    """
    names = [field.name for field in GRID.fields]
    sheets = tuple(tuple(w) for w in wanted)

    def read_files(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        roles = [Wanted(*w) for w in sheets]
        rows: list = []
        for batch in batches:
            for path, name, content in batch.itertuples(index=False):
                for row in _read(path, name, content, roles):
                    rows.append(row)
                    if len(rows) >= _BATCH:
                        yield pd.DataFrame(rows, columns=names)
                        rows = []
        if rows:
            yield pd.DataFrame(rows, columns=names)

    return files.select("path", "file_name", "content").mapInPandas(read_files, GRID)
