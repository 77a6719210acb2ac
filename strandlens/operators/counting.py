"""Counts of reads and barcodes, and per-index summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled
from .totals import with_totals


def count_barcodes(parsed: DataFrame) -> DataFrame:
    """idx_seq, bc_seq, bc_count; works the same on a stream."""
    return parsed.groupBy("idx_seq", "bc_seq").agg(F.count(F.lit(1)).alias("bc_count"))


def merge_indexes(counts: DataFrame, assigned: DataFrame) -> DataFrame:
    """idx_name, bc_seq, bc_count: counts of all observed texts of an index added up; unassigned ones are left out."""
    named = assigned.filter("idx_name IS NOT NULL").select("idx_seq", "idx_name")
    return counts.join(named, "idx_seq").groupBy("idx_name", "bc_seq").agg(F.sum("bc_count").alias("bc_count"))


def index_summary(expected: DataFrame, before: DataFrame, after: DataFrame, names: DataFrame) -> DataFrame:
    """idx_name, n_reads, n_bc (both before quality control), n_bc_named, n_reads_ac of every expected index.

    before: idx_name, bc_seq, bc_count.  after: the long table.  names: bc_name of the references.
    """
    a = before.groupBy("idx_name").agg(F.sum("bc_count").alias("n_reads"), F.count(F.lit(1)).alias("n_bc"))
    b = after.join(names.select("bc_name").distinct(), "bc_name", "left_semi").groupBy("idx_name").agg(F.count(F.lit(1)).alias("n_bc_named"))
    c = after.groupBy("idx_name").agg(F.sum(F.when(F.col("above_cutoff"), F.col("bc_count")).otherwise(0)).alias("n_reads_ac"))
    rows = expected.select("idx_name").distinct()
    for other in (a, b, c):
        rows = rows.join(other, "idx_name", "left")
    return rows.select("idx_name", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_reads", "n_bc", "n_bc_named", "n_reads_ac")))


def input_ratio(summary: DataFrame, samples: DataFrame) -> DataFrame:
    """The summary with each index's reads over its input."""
    given = samples.groupBy("idx_name").agg(F.max("input").alias("input"))
    return summary.join(given, "idx_name", "left").withColumn("count_to_input_ratio", F.try_divide(F.col("n_reads").cast("double"), F.col("input")))


def joined_notes(*notes: DataFrame, key: str = "idx_name") -> DataFrame:
    """key, note: notes of several steps in their order, joined by '; '."""
    every = None
    for i, n in enumerate(notes):
        part = n.select(key, F.lit(i).alias("step"), "note")
        every = part if every is None else every.unionByName(part)
    gathered = every.filter("note IS NOT NULL").groupBy(key).agg(F.sort_array(F.collect_list(F.struct("step", "note"))).alias("notes"))
    return gathered.select(key, F.array_join("notes.note", "; ").alias("note"))


def distinct_groups(df: DataFrame) -> DataFrame:
    return df.select("samp_group").filter("samp_group IS NOT NULL").distinct()


def first_filled(df: DataFrame, keys: list[str], columns: list[str], order: str) -> DataFrame:
    """Of each group the first non-null value of every column, in an order that is given."""
    return df.groupBy(*keys).agg(*(F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def group_counts(df: DataFrame) -> DataFrame:
    """Adds n_groups and n_samps: how many groups and samples have a barcode of this name.

    Every run numbers its discovered barcodes (BC.N) anew, so those are the same barcode only with the same sequence.
    """
    own = F.when(F.col("bc_name").startswith("BC."), F.col("bc_seq"))
    rows = df.withColumn("own_", F.coalesce(own, F.lit("")))
    per = rows.groupBy("bc_name", "own_").agg(F.count_distinct("samp_group").alias("n_groups"), F.count_distinct("samp_name").alias("n_samps"))
    return rows.join(per, ["bc_name", "own_"], "left").drop("own_")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n: keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def latest_rows(df: DataFrame, key: str, rank: list[str]) -> DataFrame:
    """All rows of each key's highest rank: later columns of the rank break ties of earlier ones, nulls are the lowest."""
    place = F.struct(*rank)
    return with_totals(settled(df), [key], best_=F.max(place)).filter(place.eqNullSafe(F.col("best_"))).drop("best_")
