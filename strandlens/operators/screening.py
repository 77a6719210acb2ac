"""Which read structure and which stock each read of a run belongs to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import share
from ..functions.reads import segments, substitution_suffix
from ..profiles import ReadProfile
from ..session import settled
from .distance import distance_join
from .ranks import global_rank

#: Bases of the pieces by which barcodes are looked for.
PIECE = 4
OUTCOMES = ("total_reads", "profile_not_found", "quality_filtered", "profile_ambiguous", "stock_unknown", "stock_ambiguous", "stock_assigned")


def parse_reads(reads: DataFrame, profile: ReadProfile, mismatches: int = 1, mask_below: int | None = None) -> DataFrame:
    """Adds p5_seq, p5_q, p7_seq, p7_q, bc_seq and bc_q to reads(seq, qual), as `segments` cuts them out."""
    found = segments(F.col("seq"), F.col("qual"), {"one": profile}, mismatches, mask_below)
    return reads.withColumn("cut_", found).select(*reads.columns, "cut_.one.*")


def passing(parsed: DataFrame, least: float, len_p7: int | None = None) -> DataFrame:
    """Reads whose barcode and P5 are there and good enough, with idx_seq; a P7 of low quality becomes N's."""
    good = parsed.filter(F.col("bc_seq").isNotNull() & (F.col("bc_q") >= least) & F.col("p5_seq").isNotNull() & (F.col("p5_q") >= least))
    if len_p7 is None:
        return good.withColumn("idx_seq", F.col("p5_seq"))
    p7 = F.when(F.col("p7_q") >= least, F.col("p7_seq")).otherwise(F.lit("N" * len_p7))
    return good.withColumn("idx_seq", F.concat("p5_seq", p7))


def classify(reads: DataFrame, profiles: Sequence[ReadProfile], least: float = 0, mismatches: int = 1) -> DataFrame:
    """One row for each read: hits (the profiles that fit, with structure and barcode) and profile_outcome.

    A profile with a second index is read that way wherever P7 is seen, even if its barcode then fails; else singly.  All
    profiles are cut out in one pass over the reads.
    """
    forms = {f"s{i}": replace(p, dual=None) for i, p in enumerate(profiles)} | {f"d{i}": p for i, p in enumerate(profiles) if p.dual}
    rows = reads.withColumn("cut_", segments(F.col("seq"), F.col("qual"), forms, mismatches))
    hits, founds = [], []
    for i, p in enumerate(profiles):

        def judged(k: str, structure: str) -> tuple[Column, Column]:
            s = F.col("cut_")[k]
            found = s["p5_seq"].isNotNull() & s["bc_seq"].isNotNull()
            good = found & (s["p5_q"] >= least) & (s["bc_q"] >= least)
            return found, F.when(good, F.struct(F.lit(p.name).alias("profile"), F.lit(structure).alias("structure"), s["bc_seq"].alias("bc_seq")))

        found, hit = judged(f"s{i}", "single")
        if p.dual is not None:
            seen, (found_2, hit_2) = F.col("cut_")[f"d{i}"]["p7_seq"].isNotNull(), judged(f"d{i}", "dual")
            found, hit = F.when(seen, found_2).otherwise(found), F.when(seen, hit_2).otherwise(hit)
        hits.append(hit)
        founds.append(found)
    good = F.array_compact(F.array(*hits))
    outcome = F.when(F.size("hits") > 1, "profile_ambiguous").when(F.size("hits") == 1, "profile_classified").when(F.col("any_"), "quality_filtered").otherwise("profile_not_found")
    return rows.select(*reads.columns, good.alias("hits"), reduce(or_, founds).alias("any_")).withColumn("profile_outcome", outcome).drop("any_")


def match_stocks(barcodes: DataFrame, refs: DataFrame, most: int = 0) -> DataFrame:
    """(profile, bc_seq, ref_match, stock, ldist) of distinct barcodes(profile, bc_seq) against refs(profile, stock, ref_name, ref_seq).

    An exact match wins; else all nearest within `most` edits.  Barcodes without any match are absent.  A reference found by
    edits carries them in its name.  ref_match and stock are sorted, distinct arrays.
    """
    asked = barcodes.select("profile", "bc_seq").dropna().distinct()
    named = refs.select("profile", "ref_seq", F.struct("ref_name", "stock").alias("ref"))
    exact = distance_join(asked, named, 0, keys=["profile"], query=("bc_seq", "bc_seq"), ref=("ref", "ref_seq"))
    if most > 0:
        rest = asked.join(exact.select("profile", F.col("query_seq").alias("bc_seq")).distinct(), ["profile", "bc_seq"], "left_anti")
        exact = exact.unionByName(distance_join(rest, named, most, keys=["profile"], scope="min", piece=PIECE, query=("bc_seq", "bc_seq"), ref=("ref", "ref_seq")))
    name = F.when(F.col("dist") == 0, F.col("ref_id.ref_name")).otherwise(F.concat_ws("_", F.col("ref_id.ref_name"), substitution_suffix(F.col("ref_seq"), F.col("query_seq"))))
    return exact.groupBy("profile", F.col("query_seq").alias("bc_seq")).agg(
        F.array_sort(F.collect_set(name)).alias("ref_match"), F.array_sort(F.collect_set("ref_id.stock")).alias("stock"), F.min("dist").alias("ldist")
    )


def resolve(classified: DataFrame, refs: DataFrame, most: int = 0) -> DataFrame:
    """Counts by read kind: profile_outcome, profiles, profile, structure, bc_seq, ref_match, stock, ldist, bc_count, outcome.

    Reads are counted first, so each distinct (profile, barcode) is matched once, however many reads have it.
    """
    # settled, since several reports read it, and so that a report's filter isn't moved below the count, where it would
    # evaluate all anchors of every read once more
    counted = settled(classified.groupBy("profile_outcome", "hits").agg(F.count(F.lit(1)).alias("bc_count")))
    names = F.array_sort(F.col("hits")["profile"])
    rows = counted.select("profile_outcome", names.alias("profiles"), "bc_count", F.explode_outer("hits").alias("hit"))
    rows = rows.select("profile_outcome", "profiles", "bc_count", "hit.profile", F.col("hit.structure").alias("structure"), "hit.bc_seq")
    # settled, since reports read the matches of a total and once more of their rows
    matched = settled(match_stocks(rows, refs, most))
    rows = rows.join(matched, ["profile", "bc_seq"], "left")
    n = F.coalesce(F.size("stock"), F.lit(0))
    one = F.col("profile_outcome") == "profile_classified"
    outcome = F.when(~one, F.col("profile_outcome")).when(F.col("stock").isNull(), "stock_unknown").when(n > 1, "stock_ambiguous").otherwise("stock_assigned")
    return rows.withColumn("outcome", outcome)


def summary(resolved: DataFrame) -> DataFrame:
    """outcome, read_count, proportion_all_reads: every outcome, those without reads as 0, and their total."""
    spark = resolved.sparkSession
    # an ambiguous read has a row for each of its profiles: the first stands for it
    once = resolved.filter(F.coalesce(F.col("profile") == F.col("profiles")[0], F.lit(True)))
    found = once.groupBy("outcome").agg(F.sum("bc_count").alias("n"))
    total = found.agg(F.sum("n").alias("n")).select(F.lit(OUTCOMES[0]).alias("outcome"), "n")
    fixed = spark.createDataFrame([(i, o) for i, o in enumerate(OUTCOMES)], "ord int, outcome string")
    rows = fixed.join(F.broadcast(found.unionByName(total)), "outcome", "left")  # at most seven rows
    rows = rows.withColumn("read_count", F.coalesce("n", F.lit(0)).cast("long"))
    whole = F.max(F.when(F.col("outcome") == OUTCOMES[0], F.col("read_count"))).over(Window.partitionBy(F.lit(1)))
    return rows.select("ord", "outcome", "read_count", share(F.col("read_count"), whole).alias("proportion_all_reads"))


def _shares(rows: DataFrame, total: int) -> DataFrame:
    return rows.withColumn("proportion_all_reads", share(F.col("read_count"), F.lit(total)))


def _total(resolved: DataFrame) -> int:
    return summary(resolved).filter(F.col("outcome") == OUTCOMES[0]).first()["read_count"]


def profile_counts(resolved: DataFrame, total: int | None = None) -> DataFrame:
    """profile, index_structure, read_count and shares, of reads with one profile."""
    total = _total(resolved) if total is None else total
    rows = resolved.filter("profile_outcome = 'profile_classified'").groupBy("profile", F.col("structure").alias("index_structure")).agg(F.sum("bc_count").alias("read_count"))
    whole = F.sum("read_count").over(Window.partitionBy(F.lit(1)))
    return _shares(rows, total).withColumn("proportion_profile_classified", share(F.col("read_count"), whole))


def stock_counts(resolved: DataFrame, total: int | None = None) -> DataFrame:
    """profile, stock, ldist, read_count and shares, of reads with one stock."""
    total = _total(resolved) if total is None else total
    rows = resolved.filter("outcome = 'stock_assigned'").groupBy("profile", F.col("stock")[0].alias("stock"), "ldist").agg(F.sum("bc_count").alias("read_count"))
    whole = F.sum("read_count").over(Window.partitionBy(F.lit(1)))
    return _shares(rows, total).withColumn("proportion_stock_assigned", share(F.col("read_count"), whole))


def ambiguous_counts(resolved: DataFrame, total: int | None = None) -> DataFrame:
    """ambiguity_type (profile or stock), labels joined by '/', ldist, read_count, proportion_all_reads."""
    total = _total(resolved) if total is None else total
    by_profile = resolved.filter("outcome = 'profile_ambiguous' AND profile = profiles[0]").select(F.lit("profile").alias("ambiguity_type"), F.array_join("profiles", "/").alias("labels"), F.lit(None).cast("int").alias("ldist"), "bc_count")
    by_stock = resolved.filter("outcome = 'stock_ambiguous'").select(F.lit("stock").alias("ambiguity_type"), F.array_join("stock", "/").alias("labels"), "ldist", "bc_count")
    rows = by_profile.unionByName(by_stock).groupBy("ambiguity_type", "labels", "ldist").agg(F.sum("bc_count").alias("read_count"))
    return _shares(rows, total)


def named_barcodes(resolved: DataFrame, total: int | None = None, ambiguous: bool = False) -> DataFrame:
    """Barcodes of every profile with names, by structure and match.

    A single exact match keeps its reference's name and leaves ref_match empty; sequences with several matches are Multi.N,
    the rest Unique.N.  N is the place of the sequence by its reads in the whole profile, whatever their structures (ties by
    sequence).  The ambiguous table holds the candidates of reads with several profiles and, once more, the barcodes of
    several stocks: its N counts both kinds of a profile together, its proportion is of all its rows, and stocks that are
    missing stay empty, where the other table has 'Unknown' and proportions of the profile.
    """
    total = _total(resolved) if total is None else total
    if ambiguous:
        stock = resolved.filter("outcome = 'stock_ambiguous'").withColumns({"ambiguity_type": F.lit("stock"), "profiles": F.array("profile")})
        part = resolved.filter("outcome = 'profile_ambiguous'").withColumn("ambiguity_type", F.lit("profile")).unionByName(stock)
        labels, whole = ["ambiguity_type", "profiles"], []
    else:
        part = resolved.filter("profile_outcome = 'profile_classified'")
        labels, whole = [], ["profile"]
    rows = part.groupBy(*labels, "profile", F.col("structure").alias("index_structure"), "bc_seq", "ref_match", "stock", "ldist").agg(F.sum("bc_count").alias("bc_count"))
    n = F.coalesce(F.size("ref_match"), F.lit(0))
    kind = F.when((n == 1) & (F.col("ldist") == 0), "exact").when(n > 1, "Multi").otherwise("Unique")
    rows = settled(rows.withColumn("kind_", kind))
    # names at the grain of sequences, rows at that of structures and labels: a profile's sequences are ranked, then joined
    sequences = rows.filter("kind_ <> 'exact'").groupBy("profile", "kind_", "bc_seq").agg(F.sum("bc_count").alias("reads_"))
    ranked = global_rank(sequences, "reads_", "bc_seq", "rank_", ["profile", "kind_"]).select("profile", "kind_", "bc_seq", "rank_")
    rows = rows.join(ranked, ["profile", "kind_", "bc_seq"], "left")
    if whole:
        rows = rows.join(rows.groupBy(*whole).agg(F.sum("bc_count").alias("whole_")), whole)
    else:
        rows = rows.withColumn("whole_", F.lit(rows.agg(F.sum("bc_count")).first()[0]))
    exact = F.col("kind_") == "exact"
    name = F.when(exact, F.col("ref_match")[0]).otherwise(F.concat_ws(".", "kind_", F.col("rank_").cast("string")))
    stocks = F.array_join("stock", "/")
    out = ["ambiguity_type", F.array_join("profiles", "/").alias("profiles")] if ambiguous else []
    return rows.select(
        *out,
        "profile",
        "index_structure",
        name.alias("bc_name"),
        "bc_count",
        share(F.col("bc_count"), F.col("whole_")).alias("proportion"),
        "bc_seq",
        F.when(exact, F.lit("")).otherwise(F.coalesce(F.array_join("ref_match", "/"), F.lit(""))).alias("ref_match"),
        F.coalesce(stocks, F.lit("")).alias("stocks") if ambiguous else F.coalesce(stocks, F.lit("Unknown")).alias("stock"),
        "ldist",
        share(F.col("bc_count"), F.lit(total)).alias("proportion_all_reads"),
    )
