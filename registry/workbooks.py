"""Workbooks and CSV lines made from table rows, as input for the readers."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from datetime import date, datetime
from io import BytesIO
from xml.sax.saxutils import escape
from zipfile import ZIP_DEFLATED, ZipFile

import pandas as pd
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_FILE = 5_000
_NAMESPACE = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def _letters(column: int) -> str:
    text = ""
    column += 1
    while column:
        column, rest = divmod(column - 1, 26)
        text = chr(65 + rest) + text
    return text


def _cell(reference: str, value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool):
        return f'<c r="{reference}" t="b"><v>{int(value)}</v></c>'
    if isinstance(value, (datetime, date)):
        if not isinstance(value, datetime):
            value = datetime(value.year, value.month, value.day)
        gap = value.replace(tzinfo=None) - datetime(1899, 12, 30)
        serial = gap.days + gap.seconds / 86400 + gap.microseconds / 86_400_000_000
        return f'<c r="{reference}" s="1"><v>{serial!r}</v></c>'
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        return f'<c r="{reference}"><v>{value}</v></c>'
    return f'<c r="{reference}" t="inlineStr"><is><t xml:space="preserve">{escape(str(value))}</t></is></c>'


def write_workbook(sheets: dict[str, Sequence[Sequence]], active: int = 0) -> bytes:
    """Bytes of a workbook; a sheet is a list of rows, an empty row stays empty."""
    out = BytesIO()
    with ZipFile(out, "w", ZIP_DEFLATED) as book:
        book.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{_NAMESPACE}" xmlns:r="{_LINKS}"><bookViews>'
            f'<workbookView activeTab="{active}"/></bookViews><sheets>'
            + "".join(
                f'<sheet name="{escape(name)}" sheetId="{i}" r:id="rId{i}"/>'
                for i, name in enumerate(sheets, 1)
            )
            + "</sheets></workbook>",
        )
        book.writestr(
            "xl/_rels/workbook.xml.rels",
            "<Relationships>"
            + "".join(
                f'<Relationship Id="rId{i}" Target="worksheets/sheet{i}.xml"/>'
                for i in range(1, len(sheets) + 1)
            )
            + "</Relationships>",
        )
        book.writestr(
            "xl/styles.xml",
            f'<styleSheet xmlns="{_NAMESPACE}"><numFmts count="1">'
            '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/></numFmts>'
            '<cellXfs count="2"><xf numFmtId="0"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        )
        for i, rows in enumerate(sheets.values(), 1):
            lines = []
            for r, row in enumerate(rows, 1):
                cells = "".join(_cell(f"{_letters(c)}{r}", v) for c, v in enumerate(row))
                lines.append(f'<row r="{r}">{cells}</row>')
            book.writestr(
                f"xl/worksheets/sheet{i}.xml",
                f'<worksheet xmlns="{_NAMESPACE}"><sheetData>{"".join(lines)}</sheetData></worksheet>',
            )
    return out.getvalue()


def as_workbooks(
    rows: DataFrame, sheet: str, header: Sequence[str], above: Sequence[Sequence] = (), name: str = "book"
) -> DataFrame:
    """The rows as workbooks of up to ``ROWS_PER_FILE`` rows: ``path file_name content``.

    Each task writes the rows it has. The rows are spread over all cores first,
    because writing and reading workbooks takes far longer than moving the rows.
    """
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    head = [list(r) for r in above] + [list(header)]

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = 0
        part = TaskContext.get().partitionId()
        for batch in batches:
            for start in range(0, len(batch), ROWS_PER_FILE):
                chunk = batch.iloc[start : start + ROWS_PER_FILE]
                data = [
                    [None if pd.isna(v) else v for v in row]
                    for row in chunk.itertuples(index=False, name=None)
                ]
                file_name = f"{name}_{part}_{number}.xlsx"
                number += 1
                yield pd.DataFrame(
                    {
                        "path": ["/" + file_name],
                        "file_name": [file_name],
                        "content": [write_workbook({sheet: head + data})],
                    }
                )

    return rows.mapInPandas(write, "path string, file_name string, content binary")


def as_lines(rows: DataFrame, file_number: Column, place: Column, line: Column, header: str) -> DataFrame:
    """The rows as lines of CSV files, every file with its header line.

    The given tables are single files, so their rows are spread over all cores, as
    the blocks of real files would be.
    """
    rows = rows.repartition(rows.sparkSession.sparkContext.defaultParallelism)
    numbered = rows.select(
        file_number.cast("bigint").alias("n"), place.cast("bigint").alias("row"), line.alias("line")
    )
    heads = numbered.select("n").distinct().select(
        "n", F.lit(-1).cast("bigint").alias("row"), F.lit(header).alias("line")
    )
    every = numbered.unionByName(heads)
    name = F.concat(F.lit("lines_"), F.col("n").cast("string"), F.lit(".csv"))
    return every.select(
        F.concat(F.lit("/"), name).alias("path"),
        name.alias("file_name"),
        F.lit(1 << 20).cast("bigint").alias("file_size"),
        F.lit(0).cast("bigint").alias("block"),
        "row",
        "line",
    )
