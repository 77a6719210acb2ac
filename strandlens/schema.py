"""The long table: one row for each (sample, barcode), the fact table of every mode."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions.labels import date_text, filled, flag, joined_id, label_text, number

LONG_COLUMNS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("run_number", T.StringType()),
        T.StructField("run_name", T.StringType()),
        T.StructField("run_date", T.StringType()),
        T.StructField("filename", T.StringType()),
        T.StructField("sample_id", T.StringType()),
        T.StructField("idx_name", T.StringType()),
        T.StructField("samp_group", T.StringType()),
        T.StructField("samp_name", T.StringType()),
        T.StructField("samp_date", T.StringType()),
        T.StructField("input", T.DoubleType()),
        T.StructField("bc_name", T.StringType()),
        T.StructField("bc_seq", T.StringType()),
        T.StructField("bc_count", T.LongType()),
        T.StructField("proportion", T.DoubleType()),
        T.StructField("above_cutoff", T.BooleanType()),
        T.StructField("x_idx", T.DoubleType()),
        T.StructField("multi_idx", T.BooleanType()),
        T.StructField("short_bc", T.BooleanType()),
        T.StructField("putative_parent", T.StringType()),
        T.StructField("ldist_samp_lvl", T.StringType()),
    ]
)
#: Columns of the distance checks over groups and over everything; made again on every compilation.
REMADE = ("ldist_group_lvl", "ldist_all")


def conform(df: DataFrame, **given: str | None) -> DataFrame:
    """df with every column of the long table, of its type: missing ones get a default or what is given for a run.

    Texts that aren't numbers count as 0 (bc_count, proportion) or null (input, x_idx); flags that aren't true are false;
    dates in no known format stay as they are.  Missing run and sample ids are built from their parts, and a missing part
    raises.  The older name run_num is accepted.  Further columns pass through at the end.
    """
    for field in LONG_COLUMNS:
        if field.name not in df.columns:
            df = df.withColumn(field.name, F.lit(given.get(field.name)).cast("string"))
    if "run_num" in df.columns:
        df = df.withColumn("run_number", F.coalesce(F.col("run_number").cast("string"), F.col("run_num").cast("string"))).drop("run_num")
    df = df.withColumns(
        {
            "run_number": F.col("run_number").cast("string"),
            "samp_date": date_text(F.col("samp_date")),
            "run_date": date_text(F.col("run_date")),
            "samp_group": label_text(F.col("samp_group")),
            "bc_count": number(F.col("bc_count"), 0.0).cast("long"),
            "proportion": number(F.col("proportion"), 0.0),
            "input": number(F.col("input")),
            "x_idx": number(F.col("x_idx")),
            **{c: flag(F.col(c)) for c in ("above_cutoff", "multi_idx", "short_bc")},
        }
    )
    run_id = F.when(filled(F.col("run_id")), F.col("run_id").cast("string")).otherwise(joined_id(F.col("run_number"), F.col("filename")))
    sample = joined_id(F.col("samp_group"), F.col("samp_name"), F.col("samp_date"), F.col("run_number"))
    df = df.withColumn("run_id", run_id).withColumn("sample_id", F.when(filled(F.col("sample_id")), F.col("sample_id").cast("string")).otherwise(sample))
    extra = [c for c in df.columns if c not in LONG_COLUMNS.names]
    return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in LONG_COLUMNS), *extra)
