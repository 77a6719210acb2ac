"""Reference sequences: FASTA files and primer tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """name, seq: sequences over several lines are joined, blank lines passed over; of equal names the last one stays.

    Records are split by the reader, so a large file is read in parallel.
    """
    raw = spark.read.text(path, lineSep=">").select("value", F.monotonically_increasing_id().alias("ord"))
    lines = F.transform(F.split("value", r"\r?\n"), lambda x: F.trim(x))
    rows = raw.filter(F.trim("value") != "").select("ord", F.element_at(lines, 1).alias("name"), F.array_join(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(1))), "").alias("seq"))
    return rows.groupBy("name").agg(F.max_by("seq", "ord").alias("seq"))


def read_primers(spark: SparkSession, path: str) -> DataFrame:
    """idx, seq of a two-column table with a header; blanks around values are dropped, of equal names the last one stays."""
    table = spark.read.csv(path, header=True, encoding="UTF-8")
    if len(table.columns) != 2:
        raise ValueError(f"a primer table has two columns, not {len(table.columns)}: {path}")
    names = [c.lstrip("﻿") for c in table.columns]
    rows = table.toDF(*names).select(F.trim(F.col(names[0])).alias("idx"), F.trim(F.col(names[1])).alias("seq"), F.monotonically_increasing_id().alias("ord"))
    return rows.groupBy("idx").agg(F.max_by("seq", "ord").alias("seq"))


def merge_refs(primary: DataFrame, extra: DataFrame, label: str = "extra") -> DataFrame:
    """Both reference tables (name, seq) as one; a name in both raises when the result is read."""
    clash = primary.select("name").intersect(extra.select("name"))
    both = primary.select("name", "seq").unionByName(extra.select("name", "seq"))
    marked = both.join(F.broadcast(clash.limit(1).select(F.col("name").alias("clash_"))), F.lit(True), "left")  # at most one row
    return marked.select(F.when(F.col("clash_").isNotNull(), F.raise_error(F.concat(F.lit(f"{label} references repeat the name "), "clash_"))).otherwise(F.col("name")).alias("name"), "seq")


def name_of_sequence(refs: DataFrame) -> DataFrame:
    """bc_seq, ref_name: of several names of one sequence the last in order."""
    return refs.groupBy(F.col("seq").alias("bc_seq")).agg(F.max("name").alias("ref_name"))
