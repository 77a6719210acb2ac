"""Workbooks that tasks write, and the store of runs."""

import datetime
import os
import re
import tracemalloc
import zipfile

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandlens.plans import compile as compiled
from strandlens.plans import sinks
from strandlens.sources import runinfo, sheets, workbook


def cells(path):
    return {(s, r, c): v for _, s, r, c, v in workbook.cells_of(open(path, "rb").read())}


def test_lines_of_many_tasks(spark, tmp_path, monkeypatch):
    n = 3000
    df = spark.range(n).select(F.col("id").alias("whole"), (F.col("id") / 4).alias("number"), (F.col("id") % 2 == 0).alias("flag"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("<&\" é "), F.col("id").cast("string"))).alias("text"), F.when(F.col("id") % 5 == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan"))).alias("odd"))
    book = sinks.Book()
    book.add("one/two", sinks.table_lines(df, [F.col("whole").desc()]))
    book.add("x" * 40, sinks.fixed_lines(spark, [["a", None, "b"], [], ["c"]]))
    book.add("nothing")
    seen, collect = [], DataFrame.collect
    monkeypatch.setattr(DataFrame, "collect", lambda self: seen.append(collect(self)) or seen[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        book.write(str(tmp_path / "a.xlsx"))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(map(len, seen), default=0) <= 1  # no line comes to the driver
    assert os.listdir(tmp_path) == ["a.xlsx"]
    found = cells(tmp_path / "a.xlsx")
    wanted = {("one_two", 0, i): c for i, c in enumerate(df.columns)}
    for line, i in enumerate(reversed(range(n)), 1):
        wanted |= {("one_two", line, 0): str(i), ("one_two", line, 1): repr(i / 4), ("one_two", line, 2): "True" if i % 2 == 0 else "False"}
        wanted |= {("one_two", line, 3): f'<&" é {i}'} if i % 3 else {}
        wanted |= {("one_two", line, 4): "inf"} if i % 5 == 0 else {}
    wanted |= {("x" * 31, 0, 0): "a", ("x" * 31, 0, 2): "b", ("x" * 31, 2, 0): "c"}
    flags = {k: v for k, v in found.items() if k[0] == "one_two" and k[2] == 2 and k[1]}
    assert len(flags) == n and {k for k in found} == {k for k in wanted}
    assert {k: v for k, v in found.items() if k not in flags} == {k: v for k, v in wanted.items() if k not in flags}


@pytest.mark.parametrize("bound", ["MOST_ROWS", "MOST_COLUMNS"])
def test_more_than_a_sheet_holds(spark, tmp_path, monkeypatch, bound):
    book = sinks.Book()
    book.add("small", sinks.fixed_lines(spark, [["a"]]))
    book.add("large", sinks.fixed_lines(spark, [["a"] * 5] * 5))
    monkeypatch.setattr(sheets, bound, 5)
    book.write(str(tmp_path / "a.xlsx"))
    monkeypatch.setattr(sheets, bound, 4)
    with pytest.raises(ValueError, match="large"):
        book.write(str(tmp_path / "b.xlsx"))
    assert os.listdir(tmp_path) == ["a.xlsx"]


HEADS = ["Run Number", "Animal", "Sample", "Date", "Barcodes", "Input TOTAL PER BARCODE"]
BODY = [*sinks.BODY]


def book_of(folder, run, samples):
    """A result workbook: samples {name: count of its only barcode}."""
    info = [HEADS] + [[run if i == 0 else None, "A", s, "2020-01-02", f"P{i}", 100] for i, s in enumerate(samples)] + [["Run Name"], [f"name {run}"], ["Date"], ["2020-02-03"]]
    blocks = []
    for s, n in samples.items():
        head = [[k, v] for k, v in zip(sinks.HEADER, (run, f"name {run}", "2020-02-03", "A", s, "2020-01-02", 100.0), strict=True)]
        blocks.append([*head, [], BODY, [f"B.{s}", "ACGT", n, 1.0, None, None, False]])
    width = len(BODY) + 1
    lines = [[v for b in blocks for v in [*b[i], *[None] * (width - len(b[i]))]] for i in range(len(blocks[0]))]
    folder.mkdir(exist_ok=True)
    workbook.write_workbook(str(folder / f"run_{run}_Analysis.xlsx"), {"runinfo": info, "A samples": lines})
    return str(folder)


def files(store):
    return {r: sorted(os.listdir(f"{store}/rows/{r}")) for r in os.listdir(f"{store}/rows") if r.startswith("run_number=")}


def test_only_partitions_of_changed_runs_are_written(spark, tmp_path):
    store = str(tmp_path / "store")
    assert compiled.update_store(spark, store, book_of(tmp_path / "a", "7", {"s1": 5, "s2": 6})) == ["7"]
    assert compiled.update_store(spark, store, book_of(tmp_path / "b", "08", {"s1": 9})) == ["08"]
    before = files(store)
    assert set(before) == {"run_number=7", "run_number=08"}
    # a later workbook of run 7 has one of its samples, with another count
    assert compiled.update_store(spark, store, book_of(tmp_path / "c", "7", {"s2": 60})) == ["7"]
    after = files(store)
    assert after["run_number=08"] == before["run_number=08"] and after["run_number=7"] != before["run_number=7"]
    found = compiled.compile_runs(spark, settings=compiled.CompileSettings(collapse_to_parent=False), store=store)
    assert sorted((r["run_number"], r["samp_name"], r["bc_count"], r["multi_idx"]) for r in found.every.collect()) == [("08", "s1", 9, False), ("7", "s1", 5, False), ("7", "s2", 60, False)]
    assert found.runs == 2 and {r["run_name"] for r in found.runinfo.collect()} == {"name 7", "name 08"}
    read = compiled.stored_rows(spark, store, ["08"])
    assert re.search(r"PartitionFilters: \[[^\]]*run_number", read._jdf.queryExecution().executedPlan().toString())
    assert {r["sample_id"] for r in read.collect()} == {"A::s1::2020-01-02::08"}


def _sheet(path, rows):
    workbook.write_workbook(str(path), {"info": [["a", "b", "c"], *([f"x{i}", i, None if i % 2 else f"y{i}"] for i in range(rows))]})
    return path.read_bytes()


def test_sheets_are_read_row_by_row(tmp_path):
    def most(rows):
        raw = _sheet(tmp_path / f"{rows}.xlsx", rows)
        tracemalloc.start()
        n = sum(1 for _ in workbook.cells_of(raw))
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n == 3 + 2 * rows + (rows + 1) // 2
        return peak

    small, large = most(500), most(10_000)
    assert large < small + 1_000_000


def test_a_sheet_that_breaks_off_gives_its_reason_only(spark, tmp_path):
    whole = tmp_path / "whole.xlsx"
    _sheet(whole, 3000)
    with zipfile.ZipFile(whole) as z, zipfile.ZipFile(tmp_path / "cut.xlsx", "w") as out:
        for name in z.namelist():
            text = z.read(name)
            out.writestr(name, text[: len(text) // 2] if "worksheets" in name else text)
    books = [(n, datetime.datetime(2021, 1, 1), (tmp_path / n).read_bytes()) for n in ("whole.xlsx", "cut.xlsx")]
    found = workbook.read_cells(spark.createDataFrame(books, "filename string, modified timestamp, content binary")).collect()
    assert sum(r["file"] == "whole.xlsx" for r in found) == 3 + 6000 + 1500
    assert [(r["sheet_no"], r["value"].split(" (")[0]) for r in found if r["file"] == "cut.xlsx"] == [(workbook.UNREADABLE, "not a workbook")]


def test_a_metadata_sheet_is_parsed_once(spark, tmp_path):
    _sheet(tmp_path / "info.xlsx", 5)
    plan = runinfo.sheet_cells(spark, str(tmp_path / "info.xlsx"))._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" not in plan
