"""Worked cases of the operators."""

import random

import pytest
from pyspark.sql import functions as F

from strandlens.operators import counting, distance, flags, parents, ranks
from strandlens.operators.collapse import collapse_ambiguous, collapse_to_parent, lost_reads

LONG = "sample_id string, bc_name string, bc_seq string, bc_count long, input double"


def long(spark, rows, schema=LONG):
    return spark.createDataFrame(rows, schema)


def by_name(df, *columns):
    return {r["bc_name"]: tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in df.collect()}


@pytest.mark.parametrize("d", [0, 1, 2])
def test_distance_join_equals_all_pairs(spark, d):
    rng = random.Random(d)
    seqs = ["".join(rng.choice("AC") for _ in range(rng.randint(0, 6))) for _ in range(60)]
    q = spark.createDataFrame(list(enumerate(seqs[:30])), "query_id int, query_seq string")
    r = spark.createDataFrame(list(enumerate(seqs[30:])), "ref_id int, ref_seq string")
    found = {(x["query_id"], x["ref_id"], x["dist"]) for x in distance.distance_join(q, r, d).collect()}
    every = q.crossJoin(r).withColumn("dist", F.levenshtein("query_seq", "ref_seq")).filter(F.col("dist") <= d)
    assert found == {(x["query_id"], x["ref_id"], x["dist"]) for x in every.collect()}


@pytest.mark.parametrize(("metric", "radius"), [("levenshtein", 3), ("levenshtein", 5), ("hamming", 4), ("indel", 3), ("LCSseq", 2), ("osa", 2)])
def test_longer_distances_equal_all_pairs(spark, metric, radius):
    rng = random.Random(radius)
    base = ["".join(rng.choice("ACG") for _ in range(rng.randint(0, 14))) for _ in range(20)]
    seqs = base + ["".join(c for c in s if rng.random() > 0.15) + rng.choice(["", "A", "CG"]) for s in base] + ["".join(rng.choice("ACG") if rng.random() < 0.2 else c for c in s) for s in base]
    q = spark.createDataFrame([(i % 2, i, s) for i, s in enumerate(seqs)], "k int, query_id int, query_seq string").coalesce(1)
    r = q.toDF("k", "ref_id", "ref_seq")
    found = {(x["query_id"], x["ref_id"], x["dist"]) for x in distance.distance_join(q, r, radius, keys=["k"], metric=metric).collect()}
    every = q.join(r, "k").filter(F.length("query_seq") == F.length("ref_seq") if metric == "hamming" else F.lit(True))
    every = every.withColumn("dist", distance.distance(metric, F.col("query_seq"), F.col("ref_seq"))).filter(F.col("dist") <= radius)
    assert found == {(x["query_id"], x["ref_id"], x["dist"]) for x in every.collect()} and len(found) > 80


@pytest.mark.parametrize("tie", ["all", "min_id"])
def test_nearest_by_rounds_equals_nearest_at_once(spark, tie):
    rng = random.Random(9)
    q = spark.createDataFrame([(i, "".join(rng.choice("AC") for _ in range(rng.randint(3, 7)))) for i in range(40)], "query_id int, query_seq string").coalesce(1)
    r = q.toDF("ref_id", "ref_seq")
    found = {(x["query_id"], x["ref_id"], x["dist"]) for x in distance.distance_join(q, r, 3, scope="min", tie=tie, exclude_same_id=True).collect()}
    near = {}
    for x in q.crossJoin(r).filter("query_id <> ref_id").withColumn("dist", F.levenshtein("query_seq", "ref_seq")).filter("dist <= 3").collect():
        near.setdefault(x["query_id"], []).append((x["dist"], x["ref_id"]))
    wanted = {(k, i, d) for k, v in near.items() for d, i in (sorted(v)[:1] if tie == "min_id" else v) if d == min(v)[0]}
    assert found == wanted


def test_nearest_and_shapes(spark):
    refs = spark.createDataFrame([("r1", "apple"), ("r2", "apply"), ("r3", "maple"), ("r4", "snapple")], "ref_id string, ref_seq string")
    q = spark.createDataFrame([("q", "appl")], "query_id string, query_seq string")
    one = distance.distance_join(q, refs, 3, scope="min", tie="min_id").collect()
    assert [(r["ref_id"], r["dist"]) for r in one] == [("r1", 1)]
    both = distance.distance_join(q, refs, 2, scope="min")
    assert distance.as_map(both).first()["neighbours"] == {"r1": 1, "r2": 1}
    assert distance.as_parallel(both).first()["ref_ids"] == ["r1", "r2"]
    index = distance.RefIndex(refs, "ref_id", "ref_seq", "indel")
    assert {r["ref_id"] for r in index.query(q, "query_id", "query_seq", 1).collect()} == {"r1", "r2"}
    own = distance.distance_join(refs.toDF("query_id", "query_seq"), refs, 1, exclude_same_id=True).collect()
    assert {(r["query_id"], r["ref_id"]) for r in own} == {("r1", "r2"), ("r2", "r1")}
    with pytest.raises(ValueError):
        distance.distance_join(q, refs, -1)


def test_metrics(spark):
    df = spark.createDataFrame([("ab", "ba"), ("abc", "abc")], "a string, b string")
    for metric, wanted in (("OSA", [1, 0]), ("Indel", [2, 0]), ("LCSseq", [1, 0]), ("hamming", [2, 0]), (lambda x, y: abs(len(x) - len(y)), [0, 0])):
        assert [r[0] for r in df.select(distance.distance(metric, F.col("a"), F.col("b"))).collect()] == wanted
    with pytest.raises(Exception, match="different lengths"):
        df.select(distance.distance("hamming", F.col("a"), F.lit("x"))).collect()
    assert distance.probe_metric(df, "a", "levenshtein") == {"identity": 0, "symmetry": 0, "triangle": 0}


def test_unique_best(spark):
    expected = spark.createDataFrame([("e1", "AAAA"), ("e2", "AAAT")], "idx_name string, idx_seq string")
    seen = spark.createDataFrame([("AAAA",), ("AAAC",), ("CCCC",)], "idx_seq string")
    found = {r["idx_seq"]: r["idx_name"] for r in distance.assign_unique_best(seen, expected, 1).collect()}
    assert found == {"AAAA": "e1", "AAAC": None, "CCCC": None}


def test_cutoffs(spark):
    def run(input_, shares):
        rows = [("s", n, n, int(p * 1000), input_) for n, p in shares]
        return by_name(flags.with_above_cutoff(flags.with_proportion(long(spark, rows))), "above_cutoff")

    assert run(100.0, [("A", 0.50), ("B", 0.02), ("Unique.1", 0.48)]) == {"A": True, "B": True, "Unique.1": False}
    assert run(100.0, [("A", 0.005), ("Unique.1", 0.995)]) == {"A": False, "Unique.1": True}
    assert run(float("inf"), [("A", 0.2), ("B", 0.05), ("C", 0.75)]) == {"A": True, "B": False, "C": True}
    assert run(0.0, [("A", 1.0)]) == {"A": False}


def test_index_share(spark):
    df = spark.createDataFrame([("R", "i1", "A", 30), ("R", "i2", "A", 10), ("R", "i1", "B", 5)], "run_number string, idx_name string, bc_name string, bc_count long")
    found = {(r["idx_name"], r["bc_name"]): r["x_idx"] for r in flags.with_index_share(df).collect()}
    assert found == {("i1", "A"): 0.75, ("i2", "A"): 0.25, ("i1", "B"): None}


def test_discovery_ranks(spark):
    df = long(spark, [("s", None, s, n, 1.0) for s, n in (("CC", 5), ("AA", 5), ("GG", 9), ("RF", 7))])
    refs = spark.createDataFrame([("RF", "RF.1")], "bc_seq string, ref_name string")
    found = {r["bc_seq"]: r["bc_name"] for r in ranks.name_discovered(df, refs).collect()}
    assert found == {"GG": "BC.1", "AA": "BC.2", "CC": "BC.3", "RF": "RF.1"}


def test_global_rank_is_gap_free(spark):
    rng = random.Random(4)
    rows = [(f"{i:05d}", rng.choice([1, 1, 1, 2, 50, i])) for i in range(3000)]
    found = ranks.global_rank(spark.createDataFrame(rows, "t string, n long"), "n", "t").collect()
    wanted = {t: k for k, (t, _) in enumerate(sorted(rows, key=lambda r: (-r[1], r[0])), 1)}
    assert {r["t"]: r["rank"] for r in found} == wanted


def test_parents_and_collapse(spark):
    df = long(spark, [("s", "P", "ACGT", 100, 100.0), ("s", "Q", "ACGA", 10, 100.0), ("s", "Unique.1", "ACGG", 500, 100.0)])
    flagged = parents.flag_parents(flags.with_above_cutoff(flags.with_proportion(df)))
    assert by_name(flagged, "putative_parent") == {"P": None, "Q": "P_4A", "Unique.1": "P_4G"}
    assert by_name(collapse_to_parent(flagged), "bc_count", "proportion") == {"P": (610, 1.0)}


def test_chained_children(spark):
    rows = [("s", "A", "AAAA", 100, 10.0), ("s", "B", "AAAT", 50, 10.0), ("s", "C", "AATT", 10, 10.0)]
    flagged = parents.flag_parents(flags.with_above_cutoff(flags.with_proportion(long(spark, rows))))
    assert by_name(flagged, "putative_parent") == {"A": None, "B": "A_4T", "C": "B_3T"}
    assert by_name(collapse_to_parent(flagged), "bc_count") == {"A": 150}
    assert by_name(collapse_to_parent(flagged, transitive=True), "bc_count") == {"A": 160}
    assert lost_reads(flagged.withColumn("ldist_samp_lvl", F.lit(None).cast("string"))).first()["lost"] == 10


def test_a_long_line_of_children(spark):
    names = [f"N{i}" for i in range(100)]
    rows = [("s", n, "A" * (i + 1), 1, 10.0, names[i - 1] + "_1A" if i else None) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, LONG + ", putative_parent string").coalesce(1)
    assert by_name(collapse_to_parent(df, transitive=True), "bc_count") == {"N0": 100}
    ring = df.withColumn("putative_parent", F.coalesce("putative_parent", F.lit("N99_1A")))
    with pytest.raises(ValueError, match="each other"):
        collapse_to_parent(ring, transitive=True).collect()


def test_ranks_by_key(spark):
    rng = random.Random(3)
    rows = [(rng.choice("ab"), rng.randint(1, 5), f"t{i:03}") for i in range(200)]
    found = ranks.global_rank(spark.createDataFrame(rows, "k string, n int, tie string").coalesce(2), "n", "tie", keys=["k"]).collect()
    for k in "ab":
        order = sorted((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2]))
        assert [r["tie"] for r in sorted((r for r in found if r["k"] == k), key=lambda r: r["rank"])] == [r[2] for r in order]
        assert sorted(r["rank"] for r in found if r["k"] == k) == list(range(1, len(order) + 1))


def test_discovered_names_count_by_sequence(spark):
    rows = [("BC.1", "AAA", "g1", "s1"), ("BC.1", "CCC", "g2", "s2"), ("M.1", "GGG", "g1", "s1"), ("M.1", "GGT", "g2", "s2")]
    found = counting.group_counts(spark.createDataFrame(rows, "bc_name string, bc_seq string, samp_group string, samp_name string"))
    assert {(r["bc_name"], r["n_groups"], r["n_samps"]) for r in found.collect()} == {("BC.1", 1, 1), ("M.1", 2, 2)}


def test_core_parents(spark):
    rows = [("s", "P", "TTACGTACTT", 50, 10.0), ("s", "Unique.1", "GGGGACGTACGGGG", 5, 10.0)]
    df = flags.with_above_cutoff(flags.with_proportion(long(spark, rows)))
    assert by_name(parents.flag_parents(df, core=(2, 6)), "putative_parent") == {"P": None, "Unique.1": "P_core"}


def test_ambiguous_children(spark):
    schema = LONG + ", proportion double, above_cutoff boolean, putative_parent string"
    rows = [("s", "P", "ACGT", 100, 10.0, 0.8, True, None), ("s", "Q", "ACGN", 10, 10.0, 0.1, False, "P_4N"), ("s", "R", "ANNT", 5, 10.0, 0.1, False, "P_2N"), ("t", "Z", "ACNN", 5, 10.0, 0.5, True, None), ("t", "Y", "ACGN", 5, 10.0, 0.5, True, None)]
    found = {(r["sample_id"], r["bc_name"]): (r["bc_count"], r["proportion"]) for r in collapse_ambiguous(long(spark, rows, schema)).collect()}
    assert found == {("s", "P"): (110, 1.0), ("t", "Y"): (5, 0.5)}


def test_adjusted_counts(spark):
    df = long(spark, [("a", "B", "AC", 1, 100.0), ("b", "B", "AC", 1, float("inf"))]).withColumn("proportion", F.when(F.col("sample_id") == "a", 0.015).otherwise(0.5))
    assert parents.adjusted_counts(df, []).first()["bc_count"] == 7


def test_latest_source_wins(spark):
    rows = [("S", "csv", 0, float("-inf"), -1), ("S", "wb1", 1, 10.0, 0), ("S", "wb2", 1, 20.0, 1), ("S", "wb2", 1, 20.0, 1)]
    df = spark.createDataFrame(rows, "sample_id string, src string, r int, t double, o int")
    once = counting.latest_rows(df, "sample_id", ["r", "t", "o"])
    assert [r["src"] for r in once.collect()] == ["wb2", "wb2"]
    assert counting.latest_rows(once, "sample_id", ["r", "t", "o"]).count() == 2


def test_empty_table(spark):
    empty = long(spark, [])
    df = flags.with_above_cutoff(flags.with_proportion(empty))
    assert collapse_to_parent(parents.flag_parents(df)).count() == 0
    assert ranks.rename_unique(empty).count() == 0
