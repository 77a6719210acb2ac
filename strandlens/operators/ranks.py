"""Names by rank over a whole run or series.

A rank over all rows needs one order of all rows.  `numbered` avoids the single
task a window without keys would use: rows are dealt to ranges of the order, as
many as their number asks for, and sorted inside them; a row's number is its
place in its range plus the rows of the ranges before.  The order may be as
uneven as it likes, since whatever makes rows different is part of it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored as settled  # rows and ranges are long tables: kept as Parquet
from .totals import join_groups

#: Rows of a range, on average; ranges are cut at sampled rows, so that one may have some times as many.
RANGE_ROWS = 1 << 18
#: Fewer rows than that aren't worth a range of their own.
LEAST_ROWS = 1 << 12


def numbered(df: DataFrame, order: Sequence[Column], number: str = "rank", keys: Sequence[str] = ()) -> DataFrame:
    """Numbers 1, 2, ... in an order that tells all rows apart (rows it doesn't are numbered as they come).

    With keys, each of their values has numbers of its own; a few values may share all rows.  Ranges are computed once and
    kept, so that a lost executor can't deal rows anew.
    """
    keys = list(keys)
    base = settled(df)
    rows = base.count()
    parts = max(-(-rows // RANGE_ROWS), min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // LEAST_ROWS)), 1)
    by = [*map(F.col, keys), *order]
    # the id of a sorted row: the number of its range, times 2^33, plus its place there
    ranges = settled(base.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("at_", F.monotonically_increasing_id()))
    ranges = ranges.withColumns({"range_": F.shiftright("at_", 33), "place_": F.col("at_").bitwiseAND(F.lit((1 << 33) - 1))}).drop("at_")
    sizes = ranges.groupBy(*keys, "range_").agg(F.min("place_").alias("first_"), F.count(F.lit(1)).alias("n_"))
    ahead = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("range_").rowsBetween(Window.unboundedPreceding, -1)  # over one row for each range
    sizes = sizes.withColumn("before_", F.coalesce(F.sum("n_").over(ahead), F.lit(0))).drop("n_")
    out = join_groups(ranges, sizes, [*keys, "range_"])
    return out.withColumn(number, (F.col("place_") - F.col("first_") + F.col("before_") + 1).cast("long")).drop("range_", "place_", "first_", "before_")


def global_rank(df: DataFrame, by: str, tie: str, rank: str = "rank", keys: Sequence[str] = ()) -> DataFrame:
    """Rank 1, 2, ... by `by` descending, then by `tie` ascending, which must differ between rows; of each value of the keys."""
    return numbered(df, [F.col(by).desc(), F.col(tie)], rank, keys)


def name_discovered(df: DataFrame, refs: DataFrame, prefix: str = "BC") -> DataFrame:
    """Names for all barcodes of a run: a reference's name where it has the sequence, else prefix.N by run total.

    refs: bc_seq, ref_name.  Ranks count unmatched sequences only, ties by sequence.
    """
    totals = df.groupBy("bc_seq").agg(F.sum("bc_count").alias("total"))
    known = refs.groupBy("bc_seq").agg(F.max("ref_name").alias("ref_name"))
    joined = totals.join(known, "bc_seq", "left")
    new = global_rank(joined.filter("ref_name IS NULL").select("bc_seq", "total"), "total", "bc_seq")
    names = joined.filter("ref_name IS NOT NULL").select("bc_seq", F.col("ref_name").alias("bc_name"))
    names = names.unionByName(new.select("bc_seq", F.concat(F.lit(f"{prefix}."), F.col("rank").cast("string")).alias("bc_name")))
    return df.drop("bc_name").join(names, "bc_seq", "left")


def rename_unique(df: DataFrame) -> DataFrame:
    """Barcodes called Unique are numbered again over all rows: Unique.1 has the largest total, ties by sequence."""
    unique = F.coalesce(F.contains(F.col("bc_name"), F.lit("Unique")), F.lit(False))
    totals = df.filter(unique).groupBy("bc_seq").agg(F.sum("bc_count").alias("total"))
    names = global_rank(totals, "total", "bc_seq").select("bc_seq", F.concat(F.lit("Unique."), F.col("rank").cast("string")).alias("new_name_"))
    return df.join(names, "bc_seq", "left").withColumn("bc_name", F.when(unique, F.col("new_name_")).otherwise(F.col("bc_name"))).drop("new_name_")


def change_flag(value: str, order: Column | str, keys: list[str]) -> Column:
    """1 where the value differs from the row before; 0 in a group's first row."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return F.when(before.isNull() | (F.col(value) == before), F.lit(0)).otherwise(F.lit(1))


def islands(flag: str, order: Column | str, keys: list[str]) -> Column:
    """Numbers runs: the running sum of a flag."""
    return F.sum(flag).over(Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
