"""Workbooks written by Spark's tasks.

A workbook's sheets are one table of lines: sheet (a number), line and cells
(`CELLS`, each with its column and its value by kind).  ``df.write.format("sheets")``
turns lines into XML in the tasks, a file for each sheet and task beside the
workbook; the commit puts these files behind each other, in the order of their
lines, as the parts of the workbook, copying bytes.  The driver sees no line.

The workbook's folder must be reachable by driver and executors as a path.
"""

from __future__ import annotations

import json
import os
import re
import shutil
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import BooleanType, DecimalType, DoubleType, FloatType, IntegralType

from ..session import settled

CELL = "struct<col:int,whole:bigint,number:double,flag:boolean,text:string>"
LINES = f"sheet int, line bigint, cells array<{CELL}>"
#: Fixed: what a sheet of a workbook can hold, and its name.
MOST_ROWS = 1_048_576
MOST_COLUMNS = 16_384
MOST_NAME = 31
SPACE = "http://schemas.openxmlformats.org"


def cell(value: Column, kind, column: int | Column) -> Column:
    """A cell of a value of a Spark type; null values are empty cells."""
    place = {"whole": "bigint", "number": "double", "flag": "boolean", "text": "string"}
    own = "flag" if isinstance(kind, BooleanType) else "whole" if isinstance(kind, IntegralType) else "number" if isinstance(kind, (DoubleType, FloatType, DecimalType)) else "text"
    col = F.lit(column) if isinstance(column, int) else column
    return F.struct(col.cast("int").alias("col"), *((value if n == own else F.lit(None)).cast(t).alias(n) for n, t in place.items()))


def cells_of_row(df: DataFrame, columns: Sequence[str], start: int | Column = 0) -> Column:
    """The cells of a row's columns, beside each other from a place on."""
    return F.array(*(cell(F.col(f"`{c}`"), df.schema[c].dataType, (F.lit(start) if isinstance(start, int) else start) + i) for i, c in enumerate(columns)))


def column_letters(n: int) -> str:
    out = ""
    n += 1
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(65 + k) + out
    return out


def line_xml(line: int, cells: Sequence[tuple[int, object]]) -> str:
    """A line of (column, value) cells; None and numbers that are none leave a cell empty."""
    out = []
    for c, v in cells:
        ref = f"{column_letters(c)}{line + 1}"
        if v is None or v != v:
            continue
        if isinstance(v, bool):
            out.append(f'<c r="{ref}" t="b"><v>{int(v)}</v></c>')
        elif isinstance(v, (int, float)) and abs(v) != float("inf"):
            out.append(f'<c r="{ref}"><v>{v!r}</v></c>')
        else:
            out.append(f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{escape(str(v))}</t></is></c>')
    return f'<row r="{line + 1}">{"".join(out)}</row>'


def sheet_name(name: str) -> str:
    return re.sub(r"[\[\]:*?/\\]", "_", name)[:MOST_NAME]


def book_parts(names: Sequence[str]) -> Iterator[tuple[str, str]]:
    """(path, XML) of all parts of a workbook but its sheets."""
    numbers = range(1, len(names) + 1)
    head = '<?xml version="1.0" encoding="UTF-8"?>'
    own = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in numbers)
    yield "[Content_Types].xml", f'{head}<Types xmlns="{SPACE}/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>{own}</Types>'
    yield "_rels/.rels", f'{head}<Relationships xmlns="{SPACE}/package/2006/relationships"><Relationship Id="rId1" Type="{SPACE}/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>'
    own = "".join(f'<Relationship Id="rId{i}" Type="{SPACE}/officeDocument/2006/relationships/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in numbers)
    yield "xl/_rels/workbook.xml.rels", f'{head}<Relationships xmlns="{SPACE}/package/2006/relationships">{own}</Relationships>'
    own = "".join(f'<sheet name={quoteattr(sheet_name(n))} sheetId="{i}" r:id="rId{i}"/>' for i, n in zip(numbers, names, strict=True))
    yield "xl/workbook.xml", f'{head}<workbook xmlns="{SPACE}/spreadsheetml/2006/main" xmlns:r="{SPACE}/officeDocument/2006/relationships"><sheets>{own}</sheets></workbook>'


SHEET_HEAD = f'<?xml version="1.0" encoding="UTF-8"?><worksheet xmlns="{SPACE}/spreadsheetml/2006/main"><sheetData>'
SHEET_END = "</sheetData></worksheet>"


# ---------------------------------------------------------------- the writer


@dataclass
class Written(WriterCommitMessage):
    """(sheet, first line, last line, file) of what a task wrote."""

    files: list[tuple[int, int, int, str]]


class SheetsWriter(DataSourceWriter):
    def __init__(self, path: str, names: list[str], folder: str):
        self.path, self.names, self.folder = path, names, folder

    def write(self, iterator: Iterator[Row]) -> Written:
        files: list[tuple[int, int, int, str]] = []
        out = None
        for sheet, line, cells in iterator:
            if not files or files[-1][0] != sheet:
                if out:
                    out.close()
                os.makedirs(self.folder, exist_ok=True)
                files.append((sheet, line, line, os.path.join(self.folder, uuid.uuid4().hex)))
                out = open(files[-1][3], "w", encoding="utf-8")
            values = sorted((c[0], next((v for v in c[1:] if v is not None), None)) for c in cells)
            out.write(line_xml(line, values))
            files[-1] = (sheet, files[-1][1], line, files[-1][3])
        if out:
            out.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        files = sorted(f for m in messages if m for f in m.files)
        own = f"{self.path}.{uuid.uuid4().hex}"
        with zipfile.ZipFile(own, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in book_parts(self.names):
                z.writestr(name, text)
            for i in range(len(self.names)):
                with z.open(f"xl/worksheets/sheet{i + 1}.xml", "w", force_zip64=True) as sheet:
                    sheet.write(SHEET_HEAD.encode())
                    for _, _, _, part in (f for f in files if f[0] == i):
                        with open(part, "rb") as rows:
                            shutil.copyfileobj(rows, sheet, 1 << 20)
                    sheet.write(SHEET_END.encode())
        os.replace(own, self.path)
        shutil.rmtree(self.folder, ignore_errors=True)

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.folder, ignore_errors=True)


class SheetsSink(DataSource):
    """Options: path, and names (the sheets' names, as JSON)."""

    @classmethod
    def name(cls) -> str:
        return "sheets"

    def schema(self) -> str:
        return LINES

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        path = self.options["path"].removeprefix("file://")
        return SheetsWriter(path, json.loads(self.options["names"]), self.options["parts"])


def write_sheets(path: str, names: Sequence[str], lines: Sequence[DataFrame]) -> None:
    """Writes tables of lines(sheet, line, cells) as one workbook; more than a sheet can hold raises before anything is written."""
    rows = settled(reduce(lambda a, b: a.unionByName(b), (d.select("sheet", F.col("line").cast("long").alias("line"), "cells") for d in lines)))
    right = F.array_max(F.col("cells")["col"])
    # a row for each sheet
    for r in rows.groupBy("sheet").agg(F.max("line").alias("line"), F.max(right).alias("col")).filter((F.col("line") >= MOST_ROWS) | (F.col("col") >= MOST_COLUMNS)).collect():
        raise ValueError(f"sheet {names[r['sheet']]!r} can't hold {r['line'] + 1} rows and {r['col'] + 1} columns; write the table instead")
    spark = rows.sparkSession
    spark.dataSource.register(SheetsSink)
    # neighbouring lines go to one task, in order
    dealt = rows.repartitionByRange("sheet", "line").sortWithinPartitions("sheet", "line")
    dealt.write.format("sheets").mode("append").option("names", json.dumps(list(names))).option("parts", f"{path.removeprefix('file://')}.{uuid.uuid4().hex}.parts").save(path)
