"""Run metadata: one row for each run, one for each of its samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.labels import date_text, filled, index_key, input_amount, joined_id, label_text
from ..session import stored
from .workbook import CELLS, header_table, read_cells, value_below

#: The metadata sheet's own columns.
OWN_COLUMNS = ("Run Number", "Animal", "Sample", "Date", "Barcodes", "Input TOTAL PER BARCODE", "Input TOTAL PER WELL", "(F Barcode)", "(cDNA)")


def one_value(c: str) -> Column:
    """The only value a group has besides null; two different ones raise."""
    two = F.raise_error(F.concat(F.lit(f"{c} has several values: "), F.min(F.col(c).cast("string")), F.lit(", "), F.max(F.col(c).cast("string"))))
    return F.when(F.min(c) == F.max(c), F.min(c)).when(F.min(c).isNull(), F.min(c)).otherwise(two.cast("string"))


def samples_from_sheet(table: DataFrame, dual: bool = False, keys: tuple[str, ...] = ("file",)) -> DataFrame:
    """keys, idx_name, samp_group, samp_name, samp_date, input, p5_name, p7_name, sample_id and other columns, one row for each
    row with a barcode.  run_number comes from the sheet's first row."""
    keys = list(keys)
    first = Window.partitionBy(*keys).orderBy("row")
    rows = table.withColumn("run_number", F.first("Run Number").over(first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).filter(filled(F.col("Barcodes")))
    p7 = F.col("(F Barcode)") if "(F Barcode)" in table.columns else F.lit(None).cast("string")
    extra = [c for c in table.columns if c not in OWN_COLUMNS and c not in (*keys, "row", "run_number")]
    rows = rows.select(
        *keys,
        "run_number",
        index_key(F.col("Barcodes"), p7, dual).alias("idx_name"),
        label_text(F.col("Animal")).alias("samp_group"),
        F.col("Sample").cast("string").alias("samp_name"),
        date_text(F.col("Date")).alias("samp_date"),
        input_amount(F.col("Input TOTAL PER BARCODE")).alias("input"),
        F.col("Barcodes").alias("p5_name"),
        p7.alias("p7_name"),
        *extra,
    )
    return rows.withColumn("sample_id", joined_id(F.col("samp_group"), F.col("samp_name"), F.col("samp_date"), F.col("run_number")))


def raw_metadata(cells: DataFrame, dual: bool = False) -> DataFrame:
    """file, row, idx_name and the columns of each metadata sheet as they are, in the order of the first sheet that has them;
    dates are ISO text, rows without any value go."""
    top = cells.filter("sheet_no = 0 AND row = 0").select(F.trim("value").alias("name"), "col").groupBy("name").agg(F.min("col").alias("col"))
    heads = [r["name"] for r in top.orderBy("col", "name").collect() if r["name"]]  # headings of small sheets
    table = header_table(cells, sorted(heads))
    barcode = F.col("Barcodes") if "Barcodes" in heads else F.lit(None).cast("string")
    p7 = F.col("(F Barcode)") if "(F Barcode)" in heads else F.lit(None).cast("string")
    shown = [date_text(F.col("Date")).alias("Date") if h == "Date" else F.col(f"`{h}`") for h in heads]
    return table.select("file", "row", F.when(filled(barcode), index_key(barcode, p7, dual)).alias("idx_name"), *shown)


def sheet_cells(spark: SparkSession, path: str) -> DataFrame:
    """The cells of a run's metadata: a workbook's first sheet, or a CSV with the same columns."""
    if path.lower().endswith(".xlsx"):
        files = spark.read.format("binaryFile").load(path).select(F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("modificationTime").alias("modified"), "content")
        return stored(read_cells(files))  # read for the headings, the rows and what is below
    table = spark.read.csv(path, header=True)
    lines = [table.columns, *(list(r) for r in table.collect())]  # one run's sheet
    return spark.createDataFrame([("sheet", None, 0, "info", r, c, str(v)) for r, line in enumerate(lines) for c, v in enumerate(line) if v is not None], CELLS)


def read_samples(spark: SparkSession, path: str, dual: bool = False) -> tuple[DataFrame, DataFrame]:
    """(samples, runs) of a run's metadata, a workbook's first sheet or a CSV with the same columns."""
    cells = sheet_cells(spark, path)
    heads = sorted(r[0] for r in cells.filter("sheet_no = 0 AND row = 0").select(F.trim("value")).distinct().collect())
    table = header_table(cells, heads)
    return samples_from_sheet(table, dual), runs_from_sheet(table, cells)


def runs_from_sheet(table: DataFrame, cells: DataFrame) -> DataFrame:
    """file, run_number, run_name, run_date of each metadata sheet."""
    number = table.groupBy("file").agg(F.min_by("Run Number", "row").alias("run_number"))
    name = value_below(cells, "Run Name").withColumnRenamed("value", "run_name")
    date = value_below(cells, "Date").select("file", date_text(F.col("value")).alias("run_date"))
    return number.join(name, "file", "left").join(date, "file", "left")


def runinfo_from_long(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs, samples) rebuilt from the long table; a sample with two different values of a column raises when read."""

    def different(*names: str) -> DataFrame:
        # the least and the greatest text of a group are found in sorted rows: only rows that differ are sorted.  The count
        # is asked for, since the optimizer would take out a distinct
        return df.groupBy(*names).agg(F.count(F.lit(1)).alias("rows_")).filter("rows_ > 0")

    runs = different("run_id", "run_number", "run_name", "run_date").groupBy("run_id").agg(*(one_value(c).alias(c) for c in ("run_number", "run_name", "run_date")))
    columns = ("idx_name", "samp_group", "samp_name", "samp_date")
    samples = different("run_id", "sample_id", *columns, "input").groupBy("run_id", "sample_id").agg(*(one_value(c).alias(c) for c in columns), one_value("input").cast("double").alias("input"))
    p5 = F.substring_index("idx_name", "_", 1)
    p7 = F.when(F.contains("idx_name", F.lit("_")), F.regexp_replace("idx_name", "^[^_]*_", ""))
    return runs, samples.withColumn("p5_name", p5).withColumn("p7_name", p7)


def sample_collisions(samples: DataFrame) -> DataFrame:
    """sample_id, idx_names: samples that more than one index claims."""
    found = samples.groupBy("sample_id").agg(F.sort_array(F.collect_set("idx_name")).alias("idx_names"))
    return found.filter(F.size("idx_names") > 1)


def expected_indexes(samples: DataFrame, p5: DataFrame, p7: DataFrame | None = None) -> DataFrame:
    """idx_seq, idx_name that a run's samples should show; p5 and p7 are (idx, seq).

    With p7, P5 and P7 are joined, and rows without P7 expect nothing; a name without a sequence raises when read.
    """
    if p7 is None:
        asked = samples.select(F.col("p5_name").alias("idx")).distinct()
        return p5.join(asked, "idx", "left_semi").select(F.col("seq").alias("idx_seq"), F.col("idx").alias("idx_name"))
    asked = samples.filter(filled(F.col("p7_name"))).select("idx_name", "p5_name", "p7_name").distinct()
    both = asked.join(p5.select(F.col("idx").alias("p5_name"), F.col("seq").alias("s5")), "p5_name", "left").join(p7.select(F.col("idx").alias("p7_name"), F.col("seq").alias("s7")), "p7_name", "left")
    unknown = F.raise_error(F.concat(F.lit("unknown primer in index "), "idx_name")).cast("string")
    return both.select(F.coalesce(F.concat("s5", "s7"), unknown).alias("idx_seq"), "idx_name")
