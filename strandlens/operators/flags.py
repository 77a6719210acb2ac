"""Per-sample quality flags and shares over the long table, for all samples at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reads import has_short_motif
from ..session import stored
from .totals import with_totals

SAMPLE = ("sample_id",)
#: The cutoff of samples whose input is infinite or unknown.
OPEN_CUTOFF = 1 / 10
#: How many times the least named proportion a unique barcode must exceed.
UNIQUE_FACTOR = 100


def with_proportion(df: DataFrame, keys: Sequence[str] = SAMPLE, places: int | None = None) -> DataFrame:
    """bc_count over the sample's total."""
    rows = with_totals(stored(df), keys, total_=F.sum("bc_count"))
    share = F.try_divide(F.col("bc_count").cast("double"), F.col("total_").cast("double"))
    return rows.withColumn("proportion", share if places is None else F.round(share, places)).drop("total_")


def is_unique(name: Column) -> Column:
    return F.coalesce(name.startswith("Unique"), F.lit(False))


def _named_cutoff(input_: Column) -> Column:
    open_ = input_.isNull() | F.isnan(input_) | (F.abs(input_) == float("inf"))
    return F.when(open_, F.lit(OPEN_CUTOFF)).otherwise(F.coalesce(F.try_divide(F.lit(1.0), input_), F.lit(float("inf"))))


def with_above_cutoff(df: DataFrame, keys: Sequence[str] = SAMPLE) -> DataFrame:
    """Named barcodes above 1/input; unique ones above 100 times the least named proportion that is above, if there is one."""
    unique = F.coalesce(F.contains(F.col("bc_name"), F.lit("Unique.")), F.lit(False))
    cut = _named_cutoff(F.col("input").cast("double"))
    named = F.col("proportion") > cut
    rows = with_totals(df, keys, least_named_=F.min(F.when(~unique & named, F.col("proportion"))))
    unique_cut = F.coalesce(F.col("least_named_") * UNIQUE_FACTOR, cut)
    above = F.coalesce(F.when(unique, F.col("proportion") > unique_cut).otherwise(named), F.lit(False))
    return rows.withColumn("above_cutoff", above).drop("least_named_")


def cutoff_notes(df: DataFrame, keys: Sequence[str] = SAMPLE) -> DataFrame:
    """keys, note: which default cutoffs a sample fell back to, joined by '; '; samples without any are absent."""
    unique = F.coalesce(F.contains(F.col("bc_name"), F.lit("Unique.")), F.lit(False))
    facts = df.groupBy(*keys).agg(F.first("input").alias("input"), F.max((~unique & F.col("above_cutoff")).cast("int")).alias("named"))
    open_ = F.col("input").isNull() | F.isnan("input") | (F.abs("input") == float("inf"))
    notes = F.array_compact(F.array(F.when(open_, F.lit("default cutoff used for an open input")), F.when(F.col("named") == 0, F.lit("no named barcode above the cutoff"))))
    return facts.withColumn("note", F.array_join(notes, "; ")).filter("note <> ''").select(*keys, "note")


def with_short_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("short_bc", has_short_motif(F.col("bc_seq")))


def with_index_share(df: DataFrame) -> DataFrame:
    """x_idx: a shared barcode's part of its run total; null where it is in one index only or the total is 0."""
    run = Window.partitionBy("run_number", "bc_name")
    shared = F.min("idx_name").over(run) != F.max("idx_name").over(run)
    share = F.try_divide(F.col("bc_count").cast("double"), F.sum("bc_count").over(run).cast("double"))
    return df.withColumn("x_idx", F.when(shared, share))


def with_multi_index(df: DataFrame) -> DataFrame:
    """multi_idx: the barcode is in more than one sample of its run and group."""
    group = Window.partitionBy("run_number", "samp_group", "bc_name")
    return df.withColumn("multi_idx", F.coalesce(F.min("samp_name").over(group) != F.max("samp_name").over(group), F.lit(False)))


def above_only(df: DataFrame) -> DataFrame:
    """The rows above the cutoff, with proportions of what is left of each sample."""
    return with_proportion(df.filter("above_cutoff"))


def row_class(above: Column, parent: Column, name: Column) -> Column:
    """8 above, 4 has a parent, 2 unique, 1 spike, added up."""
    bits = [(above, 8), (parent.isNotNull(), 4), (is_unique(name), 2), (name.startswith("Spike"), 1)]
    total = F.lit(0)
    for test, weight in bits:
        total = total + F.when(F.coalesce(test, F.lit(False)), F.lit(weight)).otherwise(F.lit(0))
    return total


def row_group(cls: Column) -> Column:
    """0 for what counts, 1 for what is above the cutoff but set aside, 2 for the rest."""
    return F.when(cls.isin(8, 10), F.lit(0)).when(cls.isin(9, 12, 13, 14), F.lit(1)).otherwise(F.lit(2))
