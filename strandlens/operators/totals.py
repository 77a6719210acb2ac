"""Totals of groups beside the rows they are of, without a window.

A window over a sample or a group sorts all its rows in one task.  Here totals
are combined before they are shuffled and then joined: the totals have one row
for each group, so Spark sends them to the rows where they are few, and where
they aren't, adaptive execution splits the rows of a group that has very many.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_groups(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """df with the columns of the row of groups that has its keys; null keys are equal to each other."""
    other = groups.withColumnsRenamed({k: f"{k}_of_" for k in keys})
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"{k}_of_")) for k in keys))
    return df.join(other, same, how).drop(*(f"{k}_of_" for k in keys))


def with_totals(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """df with aggregates of the rows that share the keys.  df is read twice: what is dear to compute should be settled before."""
    return join_groups(df, df.groupBy(*keys).agg(*(c.alias(n) for n, c in totals.items())), keys)
