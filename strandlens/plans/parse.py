"""Parse mode: reads and run metadata in, the long table and its reports out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.collapse import collapse_ambiguous
from ..operators.counting import count_barcodes, index_summary, input_ratio, joined_notes, merge_indexes
from ..operators.distance import assign_unique_best
from ..operators.flags import cutoff_notes, with_above_cutoff, with_index_share, with_proportion, with_short_flag
from ..operators.parents import flag_parents
from ..operators.ranks import name_discovered, rename_unique
from ..operators.screening import parse_reads, passing
from ..profiles import ReadProfile
from ..schema import conform
from ..session import settled
from ..sources.runinfo import expected_indexes, sample_collisions


@dataclass(frozen=True)
class ParseSettings:
    profile: ReadProfile
    discover: bool = False
    mean_quality: float = 0.0
    mask_below: int | None = None
    anchor_mismatches: int = 1
    index_distance: int = 1
    parent_distance: int = 1
    collapse_ambiguous: bool = False

    def __post_init__(self) -> None:
        if min(self.anchor_mismatches, self.index_distance, self.parent_distance) < 0:
            raise ValueError("distances can't be negative")
        if self.collapse_ambiguous and self.mask_below is None:
            raise ValueError("collapsing ambiguous barcodes needs masking")


@dataclass
class ParsedRun:
    """The results of a run, as plans that have not been executed."""

    long: DataFrame
    counts: DataFrame
    summary: DataFrame
    notes: DataFrame


def name_barcodes(counts: DataFrame, refs: DataFrame, discover: bool) -> DataFrame:
    """bc_name by reference (refs: name, seq); what no reference has becomes BC.N in discovery, else Unique.N, by run total."""
    known = refs.groupBy(F.col("seq").alias("bc_seq")).agg(F.max("name").alias("ref_name"))
    if discover:
        return name_discovered(counts.withColumn("bc_name", F.lit(None).cast("string")), known)
    named = counts.join(known, "bc_seq", "left").withColumn("bc_name", F.coalesce("ref_name", F.lit("Unique"))).drop("ref_name")
    return rename_unique(named)


def with_samples(named: DataFrame, samples: DataFrame) -> DataFrame:
    """Sample metadata by index; an index without a sample raises when read."""
    joined = named.join(samples, "idx_name", "left")
    missing = F.raise_error(F.concat(F.lit("no sample for index "), "idx_name")).cast("string")
    return joined.withColumn("samp_group", F.coalesce("samp_group", missing))


def quality_control(rows: DataFrame, settings: ParseSettings) -> DataFrame:
    """Proportion, cutoff, parents, ambiguous children, short motif and index share of all samples in one plan."""
    flagged = settled(with_above_cutoff(with_proportion(rows, ["idx_name"]), ["idx_name"]))
    found = settled(flag_parents(flagged, ["idx_name"], settings.parent_distance, settings.profile.core))
    if settings.collapse_ambiguous:
        found = collapse_ambiguous(found)
    return with_index_share(with_short_flag(found))


def parse_run(reads: DataFrame, samples: DataFrame, p5: DataFrame, refs: DataFrame, settings: ParseSettings, p7: DataFrame | None = None, filename: str = "run", run_name: str | None = None, run_date: str | None = None) -> ParsedRun:
    """reads(seq, qual); samples as `samples_from_sheet` gives them; p5, p7 (idx, seq); refs (name, seq)."""
    clashes = sample_collisions(samples).limit(5).collect()
    if clashes:
        raise ValueError(f"samples with several indexes: {[tuple(r) for r in clashes]}")
    twice = samples.groupBy("idx_name").count().filter("count > 1").limit(5).collect()
    if twice:
        raise ValueError(f"indexes of several samples: {[r['idx_name'] for r in twice]}")
    dual = settings.profile.dual
    good = passing(parse_reads(reads, settings.profile, settings.anchor_mismatches, settings.mask_below), settings.mean_quality, dual.len_p7 if dual else None)
    seen = count_barcodes(good)
    expected = expected_indexes(samples, p5, p7 if dual else None)
    shared = expected.groupBy("idx_seq").agg(F.count_distinct("idx_name").alias("n")).filter("n > 1").limit(5).collect()
    if shared:
        raise ValueError(f"expected indexes that share a sequence: {[r['idx_seq'] for r in shared]}")
    seen = settled(seen)
    counts = settled(merge_indexes(seen, assign_unique_best(seen, expected, settings.index_distance)))
    if counts.isEmpty():
        raise ValueError("no read has an expected index: check the primer tables and the names of indexes in the metadata")
    named = name_barcodes(counts, refs, settings.discover)
    rows = with_samples(named, samples).withColumn("filename", F.lit(filename))
    long = settled(conform(quality_control(rows, settings), run_name=run_name, run_date=run_date))
    summary = input_ratio(index_summary(expected, counts, long, refs.select(F.col("name").alias("bc_name"))), samples)
    return ParsedRun(long, counts, summary, joined_notes(cutoff_notes(long, ["idx_name"])))


def sorted_long(long: DataFrame) -> DataFrame:
    return long.orderBy("idx_name", F.col("bc_count").desc(), "bc_seq")


def union_runs(runs: list[DataFrame]) -> DataFrame:
    """Runs with different columns as one table; what a run lacks is null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)
