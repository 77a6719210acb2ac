"""Compile mode: many runs into one deduplicated table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import date_text, fixed_name, label_text, legacy_distance
from ..operators.collapse import collapse_to_parent
from ..operators.counting import latest_rows
from ..operators.flags import above_only, with_index_share, with_multi_index, with_short_flag
from ..operators.parents import flag_parents
from ..operators.ranks import rename_unique
from ..schema import REMADE, conform
from ..session import settled
from ..sources.runinfo import raw_metadata, runinfo_from_long, runs_from_sheet, samples_from_sheet
from ..sources.workbook import WorkbookError, find_workbooks, header_table, listed_workbooks, read_cells, sample_blocks, unusable
from .parse import union_runs

#: Where a row came from; later columns break ties.
RANK = ["source_rank_", "source_time_", "source_order_"]
PRIVATE = ["source_", "source_note_", *RANK]
METADATA = ["idx_name", "run_id", "run_number", "run_name", "run_date", "samp_group", "samp_name", "samp_date", "input", "filename"]


@dataclass(frozen=True)
class CompileSettings:
    collapse_to_parent: bool = True
    parent_distance: int = 1
    sample_level: bool = False
    group_level: bool = False
    contamination: bool = False

    def __post_init__(self) -> None:
        if self.parent_distance < 0:
            raise ValueError("distance can't be negative")


def base_rows(spark: SparkSession, path: str) -> DataFrame:
    """A former compilation as CSV: sample ids are made again, and it ranks below every workbook."""
    old = spark.read.csv(path, header=True).drop("sample_id", *REMADE)
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return conform(old).withColumns({"source_": F.lit("csv"), "source_note_": F.lit(f"base_csv: {name}"), "source_rank_": F.lit(0), "source_time_": F.lit(float("-inf")), "source_order_": F.lit(-1)})


def stored_rows(spark: SparkSession, path: str, runs: list[str] | None = None) -> DataFrame:
    """The rows of a store of runs, which rank below every workbook; of some runs only their partitions are read."""
    schema = spark.read.parquet(f"{path}/rows").drop("run_number").schema.add("run_number", "string")
    rows = spark.read.schema(schema).parquet(f"{path}/rows")
    rows = rows if runs is None else rows.filter(F.col("run_number").isin(runs))
    return rows.withColumns({"source_": F.lit("store"), "source_rank_": F.lit(0), "source_time_": F.lit(float("-inf")), "source_order_": F.lit(-1)})


def update_store(spark: SparkSession, path: str, workbooks: str) -> list[str]:
    """Adds the samples of workbooks to a store of runs, a partition for each run; the runs whose partitions were written anew.

    Of these runs the samples that no workbook holds stay as they are.  Other runs are neither read nor written, so adding a
    run costs as much as the run.  What depends on all runs (names of unique barcodes, shares, parents) isn't in the store:
    `compile_runs` makes it from the store's rows.  The first update makes the store.
    """
    new = settled(workbook_rows(workbook_cells(spark, workbooks)))
    runs = sorted(r["run_number"] for r in new.select("run_number").distinct().collect())  # at most one for each workbook
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/rows")
    known = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(at)
    rows = union_runs([stored_rows(spark, path, runs), new]) if known else new
    kept = settled(dedup_samples(rows).drop("source_rank_"))  # before the partitions it comes from are replaced
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_number").parquet(f"{path}/rows")
    return runs


def workbook_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The cells of all result workbooks under a folder (or named in a .txt file); those that can't be used raise together."""
    books = listed_workbooks(spark, folder) if folder.endswith(".txt") else find_workbooks(spark, folder)
    cells = settled(read_cells(books))
    # a row or two for each workbook that fails
    failures = [(r["file"], r["reason"]) for r in unusable(cells).collect()]
    usable = cells.filter(~F.col("file").isin([f for f, _ in failures])) if failures else cells
    if not usable.isEmpty():
        failures += [(r["file"], r["reason"]) for r in _unmatched(usable).collect()]
    if failures:
        raise WorkbookError(sorted(failures))
    return cells


def _sheet_samples(cells: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(metadata table, its samples, the sample blocks with clean keys) of workbooks."""
    heads = [r["value"] for r in cells.filter("sheet_no = 0 AND row = 0").select(F.trim("value").alias("value")).distinct().collect()]
    table = header_table(cells, sorted(heads))
    dual = "(F Barcode)" in heads
    blocks = sample_blocks(cells).drop("input")
    blocks = blocks.withColumn("samp_group", label_text(F.col("samp_group"))).withColumn("samp_date", date_text(F.col("samp_date"))).drop("sheet", "block", "row", "brk", "first", "width")
    return table, samples_from_sheet(table, dual), blocks


BLOCK_KEY = ["file", "samp_group", "samp_name", "samp_date"]


def _unmatched(cells: DataFrame) -> DataFrame:
    """file, reason of sample blocks that don't match exactly one row of metadata."""
    _, samples, blocks = _sheet_samples(cells)
    found = blocks.select(*BLOCK_KEY).distinct().join(samples.groupBy(*BLOCK_KEY).agg(F.count(F.lit(1)).alias("n")), BLOCK_KEY, "left")
    wrong = found.filter(F.coalesce("n", F.lit(0)) != 1)
    name = F.concat_ws(" ", "samp_group", "samp_name", "samp_date")
    return wrong.select("file", F.concat(F.lit("sample "), name, F.lit(" has "), F.coalesce("n", F.lit(0)).cast("string"), F.lit(" rows of metadata")).alias("reason"))


def workbook_rows(cells: DataFrame) -> DataFrame:
    """The samples of workbooks, each matched to exactly one row of its own metadata sheet."""
    table, samples, blocks = _sheet_samples(cells)
    runs = runs_from_sheet(table, cells).drop("run_number")
    key = BLOCK_KEY
    one = samples.groupBy(*key).agg(F.count(F.lit(1)).alias("n_"), F.first(F.struct(*(c for c in samples.columns if c not in key))).alias("s_"))
    joined = blocks.join(one, key, "left")
    bad = F.raise_error(F.concat(F.lit("a sample block doesn't match one row of metadata: "), "file")).cast("int")
    joined = joined.withColumn("n_", F.when(F.col("n_") == 1, F.col("n_")).otherwise(bad)).filter("n_ = 1").select(*blocks.columns, "s_.*")
    full = joined.join(runs, "file", "left").withColumn("filename", F.col("file"))
    times = cells.select("file", F.unix_timestamp("modified").cast("double").alias("source_time_")).distinct()
    order = times.select("file", F.row_number().over(_by("file")).alias("source_order_"))
    rows = conform(full.drop("file")).withColumn("file", F.col("filename"))
    rows = rows.join(times, "file").join(order, "file").drop("file")
    return rows.withColumns({"source_": F.lit("analysis"), "source_note_": F.concat(F.lit("analysis: "), "filename"), "source_rank_": F.lit(1)})


def _by(column: str):
    from pyspark.sql import Window

    return Window.orderBy(column)  # over one row for each workbook


def dedup_samples(rows: DataFrame) -> DataFrame:
    """Of each sample all rows of its best source: workbook over CSV, newer over older, later over earlier.

    A sample that still has two sets of metadata raises when read.
    """
    best = latest_rows(rows, "sample_id", RANK)
    sets = best.groupBy("sample_id").agg(F.count_distinct(F.struct(*(F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in METADATA))).alias("sets_"))
    checked = best.join(sets, "sample_id")
    bad = F.raise_error(F.concat(F.lit("a sample with several sets of metadata: "), "sample_id")).cast("string")
    return checked.withColumn("sample_id", F.when(F.col("sets_") == 1, F.col("sample_id")).otherwise(bad)).drop("sets_", "source_", *RANK[1:])


def core_quality(rows: DataFrame) -> DataFrame:
    """Numbers made whole again (a missing input is 0 here), unique names over all runs, repaired names, flags and shares."""
    df = rows.withColumns({"bc_count": F.coalesce("bc_count", F.lit(0)), "proportion": F.coalesce("proportion", F.lit(0.0)), "input": F.coalesce("input", F.lit(0.0))})
    df = rename_unique(df).withColumn("bc_name", fixed_name(F.col("bc_name")))
    df = with_short_flag(df).withColumn("ldist_samp_lvl", legacy_distance(F.col("ldist_samp_lvl")))
    return with_index_share(with_multi_index(df))


def distance_levels(df: DataFrame, settings: CompileSettings) -> DataFrame:
    """The parents within samples, groups, or everything, as the settings ask, each in its own column."""
    if settings.sample_level:
        df = settled(flag_parents(df.drop("ldist_samp_lvl"), ["samp_group", "samp_name", "samp_date"], settings.parent_distance, out="ldist_samp_lvl"))
    if settings.group_level:
        df = settled(flag_parents(df, ["samp_group"], settings.parent_distance, aggregated=True, out="ldist_group_lvl"))
    if settings.contamination:
        df = settled(flag_parents(df, [], settings.parent_distance, aggregated=True, out="ldist_all"))
    return df


def final_order(df: DataFrame) -> DataFrame:
    """Group, name and date first, and sorted by them."""
    first = ["samp_group", "samp_name", "samp_date"]
    return df.select(*first, *(c for c in df.columns if c not in first)).orderBy(*first, "sample_id", F.col("bc_count").desc(), "bc_seq")


@dataclass
class Compiled:
    """All rows, those above the cutoff, the metadata of every run with its samples and sources, and the number of runs."""

    every: DataFrame
    above: DataFrame
    runinfo: DataFrame
    runs: int


def series_metadata(cells: DataFrame | None, rows: DataFrame) -> DataFrame:
    """run_name, run_number, the columns of the runs' metadata sheets, sample_id and source; runs without a sheet get theirs from their rows."""
    parts = []
    if cells is not None:
        table, samples, _ = _sheet_samples(cells)
        heads = table.columns
        raw = raw_metadata(cells, "(F Barcode)" in heads)
        names = runs_from_sheet(table, cells).select("file", "run_name", "run_number")
        ids = samples.select("file", "idx_name", "sample_id").dropDuplicates(["file", "idx_name"])
        own = F.col("own_") if "sample_id" in raw.columns else F.lit(None).cast("string")
        raw = raw.withColumnRenamed("sample_id", "own_") if "sample_id" in raw.columns else raw
        full = raw.join(ids, ["file", "idx_name"], "left").join(names, "file", "left").withColumn("sample_id", F.coalesce(own, "sample_id"))
        sheet = [c for c in raw.columns if c not in ("file", "row", "idx_name", "Run Number", "own_")]
        full = full.filter(F.coalesce(*(F.col(f"`{c}`") for c in sheet)).isNotNull()) if sheet else full
        parts.append(full.select("run_name", "run_number", *(F.col(f"`{c}`") for c in sheet), "sample_id", "file", "row"))
    lone = rows.filter("source_rank_ = 0")
    runs, samples = runinfo_from_long(lone)
    made = samples.join(runs, "run_id").select(
        "run_name", "run_number", F.col("samp_group").alias("Animal"), F.col("samp_name").alias("Sample"), F.col("samp_date").alias("Date"), F.col("p5_name").alias("Barcodes"),
        F.col("p7_name").alias("(F Barcode)"), F.col("input").cast("string").alias("Input TOTAL PER BARCODE"), "sample_id", F.lit(None).cast("string").alias("file"), F.lit(None).cast("int").alias("row"))
    parts.append(made)
    sources = rows.groupBy("sample_id").agg(F.max("source_note_").alias("source"))
    return union_runs(parts).join(sources, "sample_id", "left")


def compile_runs(spark: SparkSession, workbooks: str | None = None, base_csv: str | None = None, settings: CompileSettings = CompileSettings(), store: str | None = None) -> Compiled:
    """Workbooks, a former compilation and a store of runs as one series of runs."""
    cells = workbook_cells(spark, workbooks) if workbooks else None
    parts = [workbook_rows(cells)] if cells is not None else []
    parts += [base_rows(spark, base_csv)] if base_csv else []
    parts += [stored_rows(spark, store)] if store else []
    if not parts:
        raise ValueError("nothing to compile: give a folder of workbooks, a CSV or a store")
    rows = settled(dedup_samples(union_runs(parts)))
    df = settled(core_quality(rows.drop("source_rank_")))
    if settings.collapse_to_parent:
        df = settled(collapse_to_parent(df))
    df = distance_levels(df, settings)
    runs = rows.agg(F.count_distinct("run_id")).first()[0]
    return Compiled(final_order(df), above_only(df), series_metadata(cells, rows), runs)
