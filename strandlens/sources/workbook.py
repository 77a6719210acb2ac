"""Spreadsheet workbooks without a spreadsheet library: cells in, cells out.

A workbook is a zip of XML sheets.  Reading gives cells (file, sheet, sheet_no,
row, col, value), 0-based, so that everything after that is relational; files
come through Spark's binary reader, so they can lie in any store.  Workbooks are
reports: each is read by one task, a row of a sheet at a time.
"""

from __future__ import annotations

import io
import itertools
import re
import zipfile
from collections.abc import Iterator
from typing import IO
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .sheets import SHEET_END, SHEET_HEAD, book_parts, line_xml

CELLS = "file string, modified timestamp, sheet_no int, sheet string, row int, col int, value string"
_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"


def column_number(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _elements(f: IO[bytes], name: str, within: str) -> Iterator[ElementTree.Element]:
    """The elements of a name as they end; what is read goes whenever an element called `within` ends."""
    opened: list[ElementTree.Element] = []
    for event, e in ElementTree.iterparse(f, ("start", "end")):
        if event == "start":
            opened.append(e)
            continue
        opened.pop()
        if e.tag == name:
            yield e
        if e.tag == within and opened:
            opened[-1].clear()


def cells_of(raw: bytes) -> Iterator[tuple[int, str, int, int, str]]:
    """(sheet number, sheet, row, column, text) of every filled cell; a row of a sheet is held at a time."""
    with zipfile.ZipFile(io.BytesIO(raw)) as z:
        strings: list[str] = []
        if "xl/sharedStrings.xml" in z.namelist():
            with z.open("xl/sharedStrings.xml") as f:
                strings += ("".join(t.text or "" for t in si.iter(f"{_NS}t")) for si in _elements(f, f"{_NS}si", f"{_NS}si"))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for number, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{_NS}sheet")):
            target = targets[sheet.get(_REL)].lstrip("/")
            with z.open(target if target.startswith("xl/") else f"xl/{target}") as f:
                for c in _elements(f, f"{_NS}c", f"{_NS}row"):
                    kind, v = c.get("t"), c.find(f"{_NS}v")
                    if kind == "inlineStr":
                        text = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
                    elif v is None or v.text is None:
                        continue
                    elif kind == "s":
                        text = strings[int(v.text)]
                    elif kind == "b":
                        text = "True" if v.text == "1" else "False"
                    else:
                        text = v.text
                    ref = c.get("r")
                    yield number, sheet.get("name"), int(re.search(r"\d+", ref)[0]) - 1, column_number(ref), text


def write_workbook(path: str, sheets: dict[str, list[list[object]]]) -> None:
    """Write rows of values that the caller holds as a workbook, sheet by sheet; None leaves a cell empty.  Tables go through `sheets`."""
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in book_parts(list(sheets)):
            z.writestr(name, text)
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/sheet{i + 1}.xml", SHEET_HEAD + "".join(line_xml(r, list(enumerate(row))) for r, row in enumerate(rows)) + SHEET_END)


#: Workbooks of former runs; lock files begin with ~$.
RESULT_BOOK = r"(?i:[^/]*)(Analysis|Discovery)\.xlsx$"


def find_workbooks(spark: SparkSession, folder: str, pattern: str = RESULT_BOOK) -> DataFrame:
    """path, filename, modified, content of the workbooks under a folder whose names fit; of equal names the newest stays.

    Raises where there are none.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(folder)
    named = files.withColumn("filename", F.element_at(F.split("path", "/"), -1)).filter(~F.col("filename").startswith("~$") & F.col("filename").rlike(pattern))
    found = newest_by_name(named.select("path", "filename", F.col("modificationTime").alias("modified")))
    if found.isEmpty():
        raise FileNotFoundError(f"no workbooks under {folder}")
    return named.drop("filename").withColumnRenamed("modificationTime", "modified").join(found.select("path", "filename"), "path").select("path", "filename", "modified", "content")


def listed_workbooks(spark: SparkSession, list_file: str) -> DataFrame:
    """The workbooks that a text file names, one path a line; a path that doesn't exist raises."""
    paths = [r[0] for r in spark.read.text(list_file).filter(F.trim("value") != "").select(F.trim("value")).collect()]
    if not paths:
        raise FileNotFoundError(f"{list_file} names no workbooks")
    files = spark.read.format("binaryFile").load(paths).withColumn("filename", F.element_at(F.split("path", "/"), -1)).withColumnRenamed("modificationTime", "modified")
    last = newest_by_name(files.select("path", "filename", "modified"))
    return files.join(last.select("path"), "path", "left_semi").select("path", "filename", "modified", "content")


def newest_by_name(files: DataFrame) -> DataFrame:
    """Of files(path, filename, modified) with one name, the newest; ties by path."""
    return files.groupBy("filename").agg(F.max(F.struct("modified", "path")).alias("last")).select("last.path", "filename", "last.modified")


#: The columns that every metadata sheet has.
NEEDED = ("Run Number", "Animal", "Sample", "Date", "Barcodes", "Input TOTAL PER BARCODE")


class WorkbookError(ValueError):
    """Workbooks that can't be used: `failures` has (file, reason) of each."""

    def __init__(self, failures: list[tuple[str, str]]):
        self.failures = failures
        super().__init__("; ".join(f"{file}: {reason}" for file, reason in failures))


#: The sheet number of the one cell that an unreadable workbook gives: the reason.
UNREADABLE = -1
#: Cells that a task holds at a time.
CELLS_AT_ONCE = 1 << 14


def read_cells(books: DataFrame) -> DataFrame:
    """Cells of books(filename, modified, content); of a file that is no workbook one cell with the reason, in sheet UNREADABLE."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, modified, raw in frame.itertuples(index=False):
                raw = bytes(raw)
                try:
                    for _ in cells_of(raw):  # none of its cells are given out before all can be read
                        pass
                    cells = cells_of(raw)
                except Exception as e:
                    cells = iter([(UNREADABLE, None, 0, 0, f"not a workbook ({type(e).__name__}: {e})")])
                while rows := [(name, modified, *cell) for cell in itertools.islice(cells, CELLS_AT_ONCE)]:
                    yield pd.DataFrame(rows, columns=["file", "modified", "sheet_no", "sheet", "row", "col", "value"])

    return books.select("filename", "modified", "content").mapInPandas(run, CELLS)


def header_table(cells: DataFrame, columns: list[str]) -> DataFrame:
    """file, row and the named columns of each file's first sheet, whose first row is the header; all texts trimmed, blanks null."""
    first = cells.filter("sheet_no = 0").withColumn("value", F.nullif(F.trim("value"), F.lit("")))
    heads = first.filter("row = 0").select("file", "col", F.col("value").alias("name"))
    body = first.filter("row > 0").join(heads, ["file", "col"])
    return body.groupBy("file", "row").pivot("name", columns).agg(F.first("value"))


def value_below(cells: DataFrame, label: str) -> DataFrame:
    """file, value: the cell below the first one in column 0 of the first sheet that equals the label."""
    first = cells.filter("sheet_no = 0 AND col = 0")
    marked = first.filter(F.trim("value") == label).groupBy("file").agg(F.min("row").alias("at"))
    return marked.join(first, "file").filter("row = at + 1").select("file", F.trim("value").alias("value"))


#: The accepted places of the blank row and widths of a block, and where each keeps group, name, date and input.
LAYOUTS = {(3, 6): ((0, 0), (0, 1), (0, 2), (2, 0)), (3, 7): ((0, 0), (0, 1), (0, 2), (2, 0)), (7, 7): ((3, 1), (4, 1), (5, 1), (6, 1)), (8, 7): ((4, 1), (5, 1), (6, 1), (7, 1))}
#: Headings of present and former workbooks, and what they are called here.
HEADINGS = {
    "Barcode": "bc_name",
    "Sequence": "bc_seq",
    "Counts": "bc_count",
    "Proportion": "proportion",
    "Hamming Dist to Another Sequence": "ldist_samp_lvl",
    "putative_parent": "ldist_samp_lvl",
    "Index hopping?": "x_idx",
    "Multi-group share": "x_idx",
    "Multi-group?": "x_idx",
    "x_group": "x_idx",
    "Short barcode?": "short_bc",
    "bc_name": "bc_name",
    "bc_seq": "bc_seq",
    "bc_count": "bc_count",
    "proportion": "proportion",
    "ldist_samp_lvl": "ldist_samp_lvl",
    "x_idx": "x_idx",
    "short_bc": "short_bc",
}
FIELDS = ("bc_name", "bc_seq", "bc_count", "proportion", "ldist_samp_lvl", "x_idx", "short_bc")


def block_numbers(cells: DataFrame) -> DataFrame:
    """(file, sheet, col, block, first) of each column of a header row(file, sheet, col): runs of neighbouring columns."""
    order = Window.partitionBy("file", "sheet").orderBy("col")
    gap = F.when(F.col("col") - F.lag("col").over(order) == 1, 0).otherwise(1)
    rows = cells.withColumn("gap", gap).withColumn("block", F.sum("gap").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.withColumn("first", F.min("col").over(Window.partitionBy("file", "sheet", "block"))).drop("gap")


def _block_heads(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cells of the 'samples' sheets, their block headings with the blank row, the width, and whether that layout is known)."""
    key = ["file", "sheet"]
    some = cells.filter((F.col("sheet_no") > 0) & F.lower("sheet").contains("samples") & (F.trim("value") != "")).select("file", "sheet", "row", "col", "value")
    used = some.groupBy(*key).agg(F.sort_array(F.collect_set("row")).alias("rows"))
    # the first row without any cell
    brk = used.select(*key, F.element_at(F.array_except(F.sequence(F.lit(0), F.array_max("rows") + 1), "rows"), 1).alias("brk"))
    rows = some.join(brk, key)
    heads = block_numbers(rows.filter("row = brk + 1").select(*key, "col", F.trim("value").alias("heading"), "brk"))
    width = heads.filter("block = 1").groupBy(*key).agg(F.count(F.lit(1)).cast("int").alias("width"))
    heads = heads.join(width, key)
    known = F.lit(False)
    for r, c in LAYOUTS:
        known = known | ((F.col("brk") == r) & (F.col("width") == c))
    return some, heads.withColumn("known", known)


def unusable(cells: DataFrame) -> DataFrame:
    """file, reason of workbooks that can't be read, lack a column of metadata, or have a samples sheet in no known layout: a
    few rows a workbook."""
    unread = cells.filter(F.col("sheet_no") == UNREADABLE).select("file", F.col("value").alias("reason"))
    _, heads = _block_heads(cells)
    strange = heads.filter(~F.col("known")).groupBy("file", "sheet").agg(F.first("width")).select("file", F.concat(F.lit("unknown layout in sheet "), "sheet").alias("reason"))
    heads = cells.filter("sheet_no = 0 AND row = 0").groupBy("file").agg(F.collect_set(F.trim("value")).alias("have"))
    lacking = F.array_except(F.array(*map(F.lit, NEEDED)), "have")
    short = heads.filter(F.size(lacking) > 0).select("file", F.concat(F.lit("no metadata column "), F.array_join(lacking, ", ")).alias("reason"))
    return unread.unionByName(strange).unionByName(short)


def sample_blocks(cells: DataFrame) -> DataFrame:
    """The side-by-side tables of all 'samples' sheets: file, sheet, block, row, group, name, date, input and FIELDS, with
    above_cutoff (rows before a block's first blank row).  A sheet in no known layout raises."""
    key = ["file", "sheet"]
    some, heads = _block_heads(cells)
    bad = F.raise_error(F.concat(F.lit("unknown layout in sheet "), "sheet", F.lit(" of "), "file"))
    heads = heads.withColumn("brk", F.when(F.col("known"), F.col("brk")).otherwise(bad.cast("int"))).drop("known")

    def meta(i: int) -> Column:
        out = F.lit(None)
        for (r, c), places in LAYOUTS.items():
            at = places[i]
            out = F.when((F.col("brk") == r) & (F.col("width") == c) & (F.col("row") == at[0]) & (F.col("col") == F.col("first") + at[1]), F.col("value")).otherwise(out)
        return F.max(out)

    block = heads.select(*key, "block", "first", "width", "brk").distinct()
    head_cells = some.join(heads.select(*key, "col", "block", "first", "width", "brk"), [*key, "col"])
    facts = head_cells.filter("row < brk").groupBy(*key, "block").agg(*(meta(i).alias(n) for i, n in enumerate(("samp_group", "samp_name", "samp_date", "input"))))
    names = F.create_map(*(F.lit(x) for kv in HEADINGS.items() for x in kv))
    body = some.join(heads.select(*key, "col", "block", "heading", "brk"), [*key, "col"]).filter("row > brk + 1").withColumn("field", names[F.col("heading")])
    wide = body.groupBy(*key, "block", "row").pivot("field", list(FIELDS)).agg(F.first("value"))
    starts = block.select(*key, "block", (F.col("brk") + 2).alias("start"))
    order = Window.partitionBy(*key, "block").orderBy("row")
    placed = wide.join(starts, [*key, "block"]).withColumn("above_cutoff", F.col("row") - F.col("start") + 1 == F.row_number().over(order))
    # once a row is missing, every later one is below
    placed = placed.withColumn("above_cutoff", F.min("above_cutoff").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return placed.join(facts, [*key, "block"]).withColumn("short_bc", F.coalesce("short_bc", F.lit("not checked!"))).drop("start")
