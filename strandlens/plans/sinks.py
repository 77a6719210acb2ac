"""Writing results: the long table by Spark, the reports as workbooks, whose lines Spark's tasks write.

A workbook is a report that people read, as large as a sheet may be: more raises.
"""

from __future__ import annotations

import datetime
import os
import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.labels import shown_flag, shown_number
from ..operators.collapse import collapse_to_parent
from ..operators.counting import distinct_groups, group_counts, repeated_keys
from ..operators.ranks import numbered
from ..session import settled
from ..sources import sheets
from ..sources.sheets import CELL, cell, cells_of_row, write_sheets
from .compile import PRIVATE, Compiled
from .parse import ParsedRun
from .screen import ScreenedRun
from .views import COMPILE_COLUMNS, PARSE_COLUMNS, contamination_wide, counted_rows, matrix_vectors, sidelong_headers, sidelong_rows

BODY = ("bc_name", "bc_seq", "bc_count", "proportion", "putative_parent", "x_idx", "short_bc")
HEADER = ("run_number", "run_name", "run_date", "samp_group", "samp_name", "samp_date", "input")
#: Headings of the older form, in the order of BODY, and of its totals.
OLD_BODY = ("Barcode", "Sequence", "Counts", "Proportion", "Hamming Dist to Another Sequence", "Multi-group share", "Short barcode?")
OLD_TOTALS = ("Sequencer Input", "Total # Sequences", "# of Barcodes (Excluding Uniques)", "Proportion Uniques")
#: Fixed value: what the older form has where a barcode has no parent.
OLD_NO_PARENT = "NA-NA"


def write_long(df: DataFrame, path: str, form: str = "csv", compression: str | None = None) -> None:
    """The long table without private columns, as CSV (plain, unless a compression is named) or Parquet."""
    out = df.drop(*PRIVATE).write.mode("overwrite")
    out = out.option("compression", compression) if compression else out
    (out.option("header", True).csv if form == "csv" else out.parquet)(path)


def fixed_lines(spark: SparkSession, rows: Sequence[Sequence[object]]) -> DataFrame:
    """line, cells of a few rows of texts that the caller holds."""
    made = [(n, [(c, None, None, None, None if v is None else str(v)) for c, v in enumerate(row)]) for n, row in enumerate(rows)]
    return spark.createDataFrame(made, f"line bigint, cells array<{CELL}>")


def table_lines(df: DataFrame, order: Sequence[Column | str], start: int = 0) -> DataFrame:
    """line, cells of a table: its columns' names in the line `start`, then its rows in an order."""
    by = [F.col(o) if isinstance(o, str) else o for o in order]
    names = fixed_lines(df.sparkSession, [df.columns]).withColumn("line", F.col("line") + start)
    rows = numbered(df, by, "line_").select((F.col("line_") + start).alias("line"), cells_of_row(df, df.columns).alias("cells"))
    return names.unionByName(rows)


def matrix_lines(df: DataFrame, columns: tuple[str, ...] = PARSE_COLUMNS, rows: tuple[str, ...] = ("bc_name", "bc_seq"), group: str = "samp_group") -> DataFrame:
    """group, line, cells of the matrix of each group."""
    found = matrix_vectors(df, columns, rows, group)
    heads = found.groupBy(group).agg(F.first("tops").alias("tops"))
    names = F.concat(F.array(*(F.lit(r) for r in rows)), F.col("tops"))
    top = heads.select(group, F.lit(0).cast("long").alias("line"), F.transform(names, lambda t, i: cell(t, StringType(), i)).alias("cells"))
    values = F.transform("vector", lambda v, i: cell(v, found.schema["vector"].dataType.elementType, i + len(rows)))
    return top.unionByName(found.select(group, F.col("place").alias("line"), F.concat(cells_of_row(found, rows), values).alias("cells")))


def sidelong_lines(df: DataFrame, legacy: bool = False) -> DataFrame:
    """samp_group, line, cells: the samples of each group side by side, header lines, a blank line, then the body with a blank line between row groups.

    legacy: the older headers, headings and texts.
    """
    order = Window.partitionBy("samp_group").orderBy("samp_name", "samp_date", "sample_id")  # over the samples of a group, which lie side by side in a sheet
    heads = sidelong_headers(df).withColumn("left_", (F.row_number().over(order) - 1) * (len(BODY) + 1))
    left = F.col("left_")

    def texts(values: Sequence[str]) -> Column:
        return F.array(*(cell(F.lit(v), StringType(), left + i) for i, v in enumerate(values)))

    if legacy:
        names = ("samp_group", "samp_name", "samp_date")
        above = [cells_of_row(heads, names + names, left), texts(OLD_TOTALS), cells_of_row(heads, ("input", "total_sequences", "named_barcodes", "proportion_unique"), left), texts(()).cast(f"array<{CELL}>"), texts(OLD_BODY)]
    else:
        above = [F.array(cell(F.lit(k), StringType(), left), cell(F.col(k), heads.schema[k].dataType, left + 1)) for k in HEADER]
        above += [texts(()).cast(f"array<{CELL}>"), texts(BODY)]
    top = heads.select("samp_group", F.posexplode(F.array(*above)).alias("line", "cells")).withColumn("line", F.col("line").cast("long"))
    rows = sidelong_rows(df)
    if legacy:
        rows = rows.withColumns({"x_idx": shown_number(F.col("x_idx")), "short_bc": shown_flag(F.col("short_bc")), "putative_parent": F.coalesce("putative_parent", F.lit(OLD_NO_PARENT))})
    placed = rows.join(heads.select("sample_id", "left_"), "sample_id")
    body = placed.select("samp_group", (F.col("line") + len(above)).alias("line"), cells_of_row(placed, BODY, left).alias("cells"))
    # a line has at most a sheet's columns
    return top.unionByName(body).groupBy("samp_group", "line").agg(F.flatten(F.collect_list("cells")).alias("cells"))


def sidelong_grids(df: DataFrame, legacy: bool = False) -> dict[str, list[list[object]]]:
    """By group, the lines of its samples, for reports so small that the caller can hold them."""
    lines = settled(sidelong_lines(df, legacy))
    longest = lines.agg(F.max("line")).first()[0]
    if longest is not None and longest >= sheets.MOST_ROWS:
        raise ValueError("a sheet can't hold that many rows; write the table instead")
    out: dict[str, list[list[object]]] = {}
    for r in lines.orderBy("samp_group", "line").collect():
        rows = out.setdefault(r["samp_group"], [])
        rows += [[] for _ in range(r["line"] + 1 - len(rows))]
        for c in r["cells"]:
            rows[-1] += [None] * (c["col"] + 1 - len(rows[-1]))
            rows[-1][c["col"]] = next((v for v in c[1:] if v is not None), None)
    return out


def sidelong_grid(df: DataFrame, legacy: bool = False) -> list[list[object]]:
    """The samples of a table of one group, as `sidelong_grids` has them."""
    return next(iter(sidelong_grids(df, legacy).values()), [])


class Book:
    """The sheets of a workbook in their order, and the lines of each."""

    def __init__(self) -> None:
        self.names: list[str] = []
        self.lines: list[DataFrame] = []

    def add(self, name: str, *lines: DataFrame) -> None:
        self.names.append(name)
        self.lines += [d.withColumn("sheet", F.lit(len(self.names) - 1)) for d in lines]

    def add_groups(self, groups: Sequence[str], kinds: dict[str, DataFrame]) -> None:
        """For each group a sheet of each kind, from tables of all groups' lines."""
        for i, lines in enumerate(kinds.values()):
            number = F.array_position(F.array(*(F.lit(g) for g in groups)).cast("array<string>"), F.col("samp_group"))
            self.lines.append(lines.filter("samp_group IS NOT NULL").withColumn("sheet", (len(self.names) + (number - 1) * len(kinds) + i).cast("int")))
        self.names += [f"{g} {kind}" for g in groups for kind in kinds]

    def write(self, path: str) -> None:
        write_sheets(path, self.names, self.lines)


def groups_of(df: DataFrame) -> list[str]:
    """The groups of a table, in order; a run has as many as it has animals."""
    return [r["samp_group"] for r in distinct_groups(df).orderBy("samp_group").collect()]


def parse_runinfo(run: ParsedRun, raw: DataFrame) -> tuple[DataFrame, list[str]]:
    """The metadata rows as they were, with what was found for each index and the notes; and the columns they are in the order of."""
    shown = raw.drop("file", "row").columns
    found = run.summary.select("idx_name", "n_reads", "n_bc", "n_bc_named", "n_reads_ac", F.col("count_to_input_ratio").alias("count-to-input_ratio"))
    rows = raw.join(found, "idx_name", "left").join(run.notes.withColumnRenamed("note", "notes"), "idx_name", "left")
    order = (["row"] if "row" in raw.columns else []) + ["idx_name"]
    return rows.select(*order, *(F.col(f"`{c}`") for c in [*shown, *found.columns[1:], "notes"] if c not in order)), order


def write_parse_workbook(run: ParsedRun, raw: DataFrame, folder: str, name: str, discover: bool = False, settings: dict[str, object] | None = None, collapse: bool = True, matrix_above_only: bool = False, legacy: bool = False, expected_groups: list[str] | None = None) -> str:
    """Run metadata with summary and notes, then samples and matrix of each group, then the settings.

    collapse: children are added to their parents, and the rows as they were come in a raw sheet of each group.
    matrix_above_only: matrices of the rows that count, else of all.  Expected groups without any row are warned of.
    """
    groups = groups_of(run.long)
    missing = sorted(set(expected_groups or []) - set(groups))
    if missing:
        warnings.warn(f"no barcodes found for {', '.join(missing)}", stacklevel=2)
    table = settled(collapse_to_parent(run.long)) if collapse else run.long
    if groups_of(table) != groups:
        raise ValueError(f"groups of the data ({groups}) and of its tables ({groups_of(table)}) differ")
    book = Book()
    info, order = parse_runinfo(run, raw)
    shown = [c for c in raw.drop("file", "row").columns] + [c for c in info.columns if c not in raw.columns]
    lines = numbered(info, order, "line")
    book.add("runinfo", fixed_lines(info.sparkSession, [shown]), lines.select("line", cells_of_row(lines, shown).alias("cells")))
    kinds = {"raw": sidelong_lines(run.long, legacy)} if collapse else {}
    book.add_groups(groups, kinds | {"samples": sidelong_lines(table, legacy), "matrix": matrix_lines(counted_rows(table) if matrix_above_only else table)})
    book.add("Analysis settings", fixed_lines(info.sparkSession, settings_rows(settings)))
    path = os.path.join(folder, f"{name}_{'Discovery' if discover else 'Analysis'}.xlsx")
    book.write(path)
    return path


def settings_rows(settings: dict[str, object] | None) -> list[list[object]]:
    """Key and value of each setting, then by which version and when."""
    from .. import __version__

    rows = [[k, "" if v is None else str(v)] for k, v in (settings or {}).items()]
    return [*rows, ["version", __version__], ["analysis date", datetime.datetime.now().strftime("%Y-%m-%d %H:%M:%S")]]


def write_screen_workbook(run: ScreenedRun, path: str, settings: dict[str, object] | None = None) -> None:
    """The summary tables below each other, then barcodes by profile, ambiguous barcodes and settings."""
    book, parts, start = Book(), [], 0
    spark = run.summary.sparkSession
    least = F.coalesce("ldist", F.lit(-1))
    for title, table, hidden, order in (
        ("Summary", run.summary, ["ord"], ["ord"]),
        ("Profiles", run.profiles, [], ["profile", "index_structure"]),
        ("Stocks", run.stocks, [], ["profile", "stock", "ldist"]),
        ("Ambiguous", run.ambiguous, [], ["ambiguity_type", "labels", least]),
    ):
        rows = settled(table)
        shown = [c for c in rows.columns if c not in hidden]
        lines = numbered(rows, [F.col(o) if isinstance(o, str) else o for o in order], "line_")
        parts.append(fixed_lines(spark, [[title], shown]).withColumn("line", F.col("line") + start))
        parts.append(lines.select((F.col("line_") + start + 1).alias("line"), cells_of_row(lines, shown).alias("cells")))
        start += rows.count() + 6  # four empty lines between tables
    book.add("Summary", *parts)
    barcodes = settled(run.barcodes)
    shown = [c for c in barcodes.columns if c != "profile"]
    lines = numbered(barcodes, [F.col("bc_count").desc(), F.col("bc_seq"), F.col("index_structure")], "line", ["profile"])
    for (profile,) in barcodes.select("profile").distinct().orderBy("profile").collect():
        mine = lines.filter(F.col("profile") == profile).select("line", cells_of_row(lines, shown).alias("cells"))
        book.add(f"{profile} barcodes", fixed_lines(spark, [shown]), mine)
    book.add("Ambiguous barcodes", table_lines(run.ambiguous_barcodes, ["ambiguity_type", F.col("bc_count").desc(), "bc_seq", "profiles", "profile", "index_structure"]))
    book.add("Screen settings", fixed_lines(spark, settings_rows(settings)))
    book.write(path)


def write_compiled(found: Compiled, folder: str, prefix: str, contamination: bool = False) -> tuple[str, str]:
    """{prefix}_all as CSV, and {prefix}_above_cutoff.xlsx: the runs' metadata, all rows of all samples, each group's samples and matrix,
    and if asked for the full matrix and the contamination report."""
    table = os.path.join(folder, f"{prefix}_all.csv")
    write_long(found.every, table)
    above = settled(found.above.drop(*PRIVATE))
    twice = repeated_keys(above, ["samp_group", "bc_name", "bc_seq", *COMPILE_COLUMNS]).limit(5).collect()
    if twice:
        raise ValueError(f"rows of one sample and barcode: {[(r['samp_name'], r['bc_name']) for r in twice]}")
    book = Book()
    if not found.runinfo.isEmpty():
        shown = found.runinfo.drop("file", "row").columns
        lines = numbered(found.runinfo, [F.col(c) for c in ("run_name", "file", "row", "sample_id")], "line")
        book.add("runinfo", fixed_lines(above.sparkSession, [shown]), lines.select("line", cells_of_row(lines, shown).alias("cells")))
    book.add("all_samples", table_lines(above, ["samp_group", "samp_name", "samp_date", "sample_id", F.col("bc_count").desc(), "bc_seq"]))
    if contamination:
        whole = group_counts(above).withColumn("matrix_", F.lit("all"))
        book.add("full_matrix", matrix_lines(whole, ("samp_group", *COMPILE_COLUMNS), ("bc_name", "bc_seq", "ldist_all", "n_groups", "n_samps"), "matrix_").select("line", "cells"))
        book.add("contam_report", table_lines(contamination_wide(above), [F.col("n_groups").desc(), "bc_name", "bc_seq"]))
    book.add_groups(groups_of(above), {"samples": sidelong_lines(above), "matrix": matrix_lines(above, COMPILE_COLUMNS)})
    path = os.path.join(folder, f"{prefix}_above_cutoff.xlsx")
    book.write(path)
    return table, path
