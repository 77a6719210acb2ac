"""Adding children to their parents, sample by sample in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import base_name
from ..functions.reads import count_n
from ..session import keep_checkpoints, stored
from .flags import SAMPLE, with_above_cutoff, with_proportion
from .totals import with_totals


def collapse_to_parent(df: DataFrame, transitive: bool = False) -> DataFrame:
    """Each sample's children are added to their parents' rows and dropped; proportion and cutoff follow.

    A sample's parents are in putative_parent if any row there has one, else in ldist_samp_lvl; samples with neither stay as
    they are.  Only one level is added: what a child gained itself is not passed on, and goes with it if it is dropped
    (as do counts whose parent has no row).  With transitive, a child's parent is replaced by that parent's parent first.
    """
    own = [c for c in ("putative_parent", "ldist_samp_lvl") if c in df.columns]
    rows = with_totals(stored(df), SAMPLE, **{f"has_{c}_": F.max(F.col(c).isNotNull()) for c in own}) if own else df
    chosen, any_ = F.lit(None).cast("string"), F.lit(False)
    for c in reversed(own):
        chosen, any_ = F.when(F.col(f"has_{c}_"), F.col(c)).otherwise(chosen), any_ | F.col(f"has_{c}_")
    rows = rows.withColumns({"parent_": base_name(chosen), "any_": any_}).drop(*(f"has_{c}_" for c in own))
    if transitive:
        rows = rows.drop("parent_").join(root_parents(rows.filter("parent_ IS NOT NULL").select(*SAMPLE, "bc_name", "parent_")), [*SAMPLE, "bc_name"], "left")
    rows = stored(rows)
    gained = rows.filter("parent_ IS NOT NULL").groupBy(*SAMPLE, F.col("parent_").alias("bc_name")).agg(F.sum("bc_count").alias("gained_"))
    kept = rows.filter("parent_ IS NULL").join(gained, [*SAMPLE, "bc_name"], "left")
    kept = kept.withColumn("bc_count", F.col("bc_count") + F.coalesce("gained_", F.lit(0)))
    # samples without children keep what they had
    old = {c: F.col(c) for c in ("proportion", "above_cutoff") if c in df.columns}
    new = with_above_cutoff(with_proportion(kept.withColumns({f"old_{c}_": v for c, v in old.items()})))
    new = new.withColumns({c: F.when(F.col("any_"), F.col(c)).otherwise(F.col(f"old_{c}_")) for c in old})
    return new.select(*df.columns)


def root_parents(links: DataFrame) -> DataFrame:
    """sample, bc_name, parent_ with every parent replaced by the last of its line; each round doubles the length covered.

    A round's table is a checkpoint, so that plans don't grow with the rounds.  A line that comes back to itself has no
    last parent and raises.
    """
    keep_checkpoints(links.sparkSession)
    links = links.dropDuplicates([*SAMPLE, "bc_name"]).checkpoint()
    longest, reach = None, 1
    while True:
        up = links.select(*SAMPLE, F.col("bc_name").alias("parent_"), F.col("parent_").alias("up_"))
        joined = links.join(up, [*SAMPLE, "parent_"], "left").checkpoint()
        if joined.filter("up_ IS NOT NULL AND up_ <> parent_").isEmpty():
            if not links.filter("parent_ = bc_name").isEmpty():
                raise ValueError("parents that are each other's children")
            return links
        # a round covers lines twice as long, so it must end before more links than there are
        longest = links.count() if longest is None else longest
        if reach > longest:
            raise ValueError("parents that are each other's children")
        reach *= 2
        links = joined.select(*SAMPLE, "bc_name", F.coalesce("up_", "parent_").alias("parent_"))


def lost_reads(df: DataFrame) -> DataFrame:
    """sample_id, lost: reads of children whose parent has no row or is itself a child, which one level of adding loses."""
    parent = base_name(F.coalesce("putative_parent", "ldist_samp_lvl"))
    rows = df.withColumn("parent_", parent)
    roots = rows.filter("parent_ IS NULL").select(*SAMPLE, F.col("bc_name").alias("parent_")).distinct()
    return rows.filter("parent_ IS NOT NULL").join(roots, [*SAMPLE, "parent_"], "left_anti").groupBy(*SAMPLE).agg(F.sum("bc_count").alias("lost"))


def collapse_ambiguous(df: DataFrame) -> DataFrame:
    """Rows with one N, below the cutoff, whose parent is above it, are added to that parent; then all rows with N go.

    Rows with more than one N always go from a sample that has any N.  A sample in which nothing can be added keeps its
    rows with one N and its proportions.  above_cutoff is left as it was.
    """
    rows = df.withColumn("n_", F.coalesce(count_n(F.col("bc_seq")), F.lit(0))).filter("n_ <= 1")
    rows = rows.withColumn("parent_", base_name(F.col("putative_parent")))
    able = rows.filter("above_cutoff").select(*SAMPLE, F.col("bc_name").alias("parent_"), F.lit(True).alias("able_")).distinct()
    rows = rows.join(able, [*SAMPLE, "parent_"], "left")
    child = (F.col("n_") == 1) & ~F.col("above_cutoff") & F.coalesce("able_", F.lit(False))
    rows = with_totals(stored(rows.withColumn("child_", child)), SAMPLE, any_=F.max("child_"))
    gained = rows.filter("child_").groupBy(*SAMPLE, F.col("parent_").alias("bc_name")).agg(F.sum("bc_count").alias("gained_"))
    kept = rows.filter("NOT any_ OR n_ = 0").join(gained, [*SAMPLE, "bc_name"], "left")
    kept = kept.withColumn("bc_count", F.col("bc_count") + F.coalesce("gained_", F.lit(0))).withColumn("old_", F.col("proportion"))
    return with_proportion(kept).withColumn("proportion", F.when(F.col("any_"), F.col("proportion")).otherwise(F.col("old_"))).select(*df.columns)
