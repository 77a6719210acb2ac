"""Training and held-out rows of the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id's text, modulo folds; null ids are in fold 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds, F.lit(0))


def sample_ids(labels: DataFrame, label_col: str, folds: int, held: int, per_class: int, id_col: str = "doc_id") -> DataFrame:
    """Up to per_class ids of either label outside the held-out fold, by the order of a hash of the id.

    At most 2 * per_class rows, whatever the size of labels.  A document labelled twice counts by its larger label; null
    labels and ids are left out.
    """
    rows = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & (fold("doc_id", folds) != held))
    rows = rows.groupBy("doc_id").agg(F.max("label").alias("label"))
    order = F.xxhash64("doc_id")
    parts = [rows.filter(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1])
