"""Totals without windows, and numbers over ranges."""

import random

import pytest
from pyspark.sql import functions as F

from strandlens.operators import collapse, counting, flags, ranks, totals
from strandlens.plans import views

LONG = "samp_group string, sample_id string, idx_name string, bc_name string, bc_seq string, bc_count long, input double"


def hot(spark, n=4000):
    """One sample with nearly all rows."""
    rng = random.Random(1)
    rows = [("g", "hot" if i % 50 else f"s{i % 7}", "hot" if i % 50 else f"s{i % 7}", rng.choice(["Unique.", "BC.", "Spike."]) + str(i), f"{i:06d}", rng.randint(1, 40), 50.0) for i in range(n)]
    return rows, spark.createDataFrame(rows, LONG).repartition(4)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_of_a_hot_sample(spark):
    rows, df = hot(spark)
    whole = {}
    for r in rows:
        whole[r[1]] = whole.get(r[1], 0) + r[5]
    shares = flags.with_proportion(df)
    assert {r["bc_seq"]: r["proportion"] for r in shares.collect()} == {r[4]: r[5] / whole[r[1]] for r in rows}
    flagged = flags.with_above_cutoff(shares)
    least = {}
    for r in rows:
        p = r[5] / whole[r[1]]
        if not r[3].startswith("Unique.") and p > 1 / 50:
            least[r[1]] = min(least.get(r[1], 9), p)
    wanted = {r[4]: r[5] / whole[r[1]] > (least[r[1]] * 100 if r[1] in least and r[3].startswith("Unique.") else 1 / 50) for r in rows}
    assert {r["bc_seq"]: r["above_cutoff"] for r in flagged.collect()} == wanted


def test_nulls_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 3), ("a", 4)], "k string, bc_count long")
    assert sorted(r["proportion"] for r in flags.with_proportion(df, ["k"]).collect()) == [0.25, 0.75, 1.0]
    assert totals.with_totals(df, ["k"], n=F.count(F.lit(1))).columns == ["k", "bc_count", "n"]


def test_no_window_over_a_sample_or_group(spark):
    _, df = hot(spark, 200)
    rows = df.withColumns({"putative_parent": F.lit(None).cast("string"), "ldist_samp_lvl": F.lit(None).cast("string"), "x_idx": F.lit(None).cast("double"), "short_bc": F.lit(False), "ldist_all": F.lit(None).cast("string"), "samp_name": F.col("sample_id")})
    flagged = flags.with_above_cutoff(flags.with_proportion(rows))
    for found in (flagged, views.counted_rows(flagged), views.contamination(flagged), collapse.collapse_to_parent(flagged), collapse.collapse_ambiguous(flagged), counting.latest_rows(flagged, "sample_id", ["bc_count"])):
        assert "Window" not in plan(found)
    # the only window is over one row for each range of a sample
    assert plan(views.sidelong_rows(flagged)).count("Window [sum(n_") == 1 and plan(views.sidelong_rows(flagged)).count("Window [") == 1


def test_side_by_side_rows_of_a_hot_sample(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LEAST_ROWS", 100)
    rows, df = hot(spark)
    extra = df.withColumns({"putative_parent": F.when(F.col("bc_count") == 7, "P_1A"), "ldist_samp_lvl": F.lit(None).cast("string"), "x_idx": F.lit(0.5), "short_bc": F.lit(False)})
    flagged = flags.with_above_cutoff(flags.with_proportion(extra)).withColumn("above_cutoff", F.col("bc_count") > 20)
    found = views.sidelong_rows(flagged).collect()
    by_sample = {}
    for r in found:
        by_sample.setdefault(r["sample_id"], []).append(r)
    before = {r["bc_seq"]: r["proportion"] for r in flagged.collect()}
    for mine in by_sample.values():
        mine.sort(key=lambda r: r["ord"])
        assert [r["ord"] for r in mine] == list(range(1, len(mine) + 1))
        keys = [(r["rowgroup"], -before[r["bc_seq"]], r["bc_seq"]) for r in mine]
        assert keys == sorted(keys)
        assert [r["spacer_before"] for r in mine] == [i > 0 and mine[i]["rowgroup"] != mine[i - 1]["rowgroup"] for i in range(len(mine))]
        assert sum(r["proportion"] for r in mine if r["rowgroup"] == 0) == pytest.approx(1.0)


def test_a_million_distinct_totals(spark, monkeypatch):
    """No range has more than three times RANGE_ROWS rows, wherever the totals lie."""
    monkeypatch.setattr(ranks, "RANGE_ROWS", 50_000)
    kept, settled = [], ranks.settled
    monkeypatch.setattr(ranks, "settled", lambda df: kept.append(settled(df)) or kept[-1])
    n = 1_000_000
    # totals of very different sizes, a third of the rows with the same one
    total = F.when(F.col("id") % 3 == 0, 5).otherwise((F.col("id") * 48271 % n) * (F.col("id") % 7 + 1))
    df = spark.range(n).select(F.lpad(F.col("id").cast("string"), 7, "0").alias("t"), total.cast("long").alias("n"))
    found = ranks.global_rank(df, "n", "t")
    sizes = [r["count"] for r in kept[-1].groupBy(F.shiftright("at_", 33)).count().collect()]
    assert sum(sizes) == n and len(sizes) >= 20 and max(sizes) <= 3 * ranks.RANGE_ROWS
    # the rank is the row's place in the order
    row = found.agg(F.min("rank"), F.max("rank"), F.count_distinct("rank")).first()
    assert tuple(row) == (1, n, n)
    pairs = found.join(found.select((F.col("rank") - 1).alias("rank"), F.col("n").alias("n2"), F.col("t").alias("t2")), "rank")
    assert pairs.filter("n < n2 OR n = n2 AND t >= t2").isEmpty()


def test_numbers_by_key_and_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(ranks, "LEAST_ROWS", 10)
    rng = random.Random(6)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.randint(1, 4), f"t{i % 150:03}") for i in range(300)]
    found = ranks.numbered(spark.createDataFrame(rows, "k string, n int, t string"), [F.col("n").desc(), F.col("t")], "number", ["k"]).collect()
    assert len(found) == 300
    for k in ("a", "b", None):
        mine = sorted((r for r in found if r["k"] == k), key=lambda r: r["number"])
        assert [r["number"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(r["n"], r["t"]) for r in mine] == sorted(((r["n"], r["t"]) for r in mine), key=lambda x: (-x[0], x[1]))
    assert ranks.numbered(spark.createDataFrame([], "n int"), [F.col("n")]).collect() == []


def test_latest_rows_of_a_hot_key(spark):
    rows = [("hot", i % 5, None if i % 3 == 0 else i, i) for i in range(500)] + [("x", None, None, 0), ("x", None, None, 1), (None, 1, 1, 2), (None, 0, 9, 3)]
    found = counting.latest_rows(spark.createDataFrame(rows, "k string, a int, b int, i int"), "k", ["a", "b"])
    assert sorted((str(r["k"]), r["i"]) for r in found.collect()) == [("None", 2), ("hot", 499), ("x", 0), ("x", 1)]


def test_samples_are_told_apart_before_their_texts_are_sorted(spark):
    from strandlens.sources.runinfo import runinfo_from_long

    columns = ("run_id", "run_number", "run_name", "run_date", "sample_id", "idx_name", "samp_group", "samp_name", "samp_date")
    rows = [(*(f"{c}{i % 3}" if c == "sample_id" else c for c in columns), 20.0) for i in range(30)]
    long = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns) + ", input double")
    for found, n in zip(runinfo_from_long(long), (1, 3), strict=True):
        assert found.count() == n
        assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 2  # different rows first
