"""Parents within groups: each barcode's best reference by cells of half texts, against all pairs."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from strandlens.operators import parents
from strandlens.session import stored

ROWS = "g string, bc_name string, bc_seq string, bc_count long"


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) <= 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


@pytest.mark.parametrize("keys", [["g"], []])
def test_best_by_cells_is_the_best_of_all_pairs(spark, monkeypatch, keys):
    monkeypatch.setattr(parents, "CELL_ROWS", 64)
    rng = random.Random(3)
    rows = sorted({(rng.choice("gh") if keys else "g", f"{rng.choice(['Unique', 'B'])}.{rng.randint(0, 60)}", "".join(rng.choice("ACGT") for _ in range(rng.choice([0, 1, 3, 4, 5, 6, 7]))), rng.randint(1, 5)) for _ in range(900)})
    found = parents.best_references(spark.createDataFrame(rows, ROWS).repartition(3), keys).toPandas()
    best = {}
    for r in found.itertuples(index=False):
        k = ((r.g if keys else "g"), r.name, r.seq, r.count)
        best[k] = min(best.get(k, (0, "~", "~")), (-r.ref_count, r.ref_seq, r.ref_name))
    wanted = {}
    for q in rows:
        fit = [(-r[3], r[2], r[1]) for r in rows if r[0] == q[0] and r[1][0] == "B" and r[1] != q[1] and near(q[2], r[2]) and (q[1][0] == "U" or r[3] > q[3])]
        if fit:
            wanted[q] = min(fit)
    assert best == wanted and len(wanted) > 300


def test_neighbours_of_a_dense_group_are_not_shuffled(spark):
    """All 1,024 texts of five bases have 15 neighbours of their length each: three rows at most come out for each."""
    texts = ["".join(t) for t in itertools.product("ACGT", repeat=5)]
    rows = spark.createDataFrame([("g", f"B.{t}", t, i + 1) for i, t in enumerate(texts)], ROWS)
    assert parents.best_references(rows, ["g"]).count() <= 3 * len(texts)
    long = rows.withColumns({"proportion": F.col("bc_count") / 1000, "input": F.lit(1000.0)})
    found = parents.flag_parents(long, ["g"], aggregated=True, out="parent")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Join ") == 1  # the parents' names to the rows, and no join of barcodes
    got = {r["bc_seq"]: r["parent"] for r in found.collect()}
    for i, t in enumerate(texts):
        larger = [j for j in range(i + 1, len(texts)) if near(t, texts[j])]
        assert (got[t] or "").startswith(f"B.{texts[max(larger)]}_") if larger else got[t] is None


def test_stored_rows_keep_types_and_nulls(spark):
    df = spark.sql("SELECT 1L AS a, cast(null AS double) AS b, 'x' AS c UNION ALL SELECT null, 2.0D, null")
    kept = stored(df)
    assert kept.dtypes == df.dtypes and sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert stored(df.withColumn("v", F.lit(None))).columns == ["a", "b", "c", "v"]


@pytest.mark.parametrize("largest", [1 << 16, 8])
def test_a_sample_meets_in_one_place_unless_it_is_large(spark, monkeypatch, largest):
    """Parents and cores of samples with repeated barcodes, held against all pairs, by whole samples and by halves."""
    monkeypatch.setattr(parents, "CELL_ROWS", largest)
    rng = random.Random(5)
    rows = [(rng.choice("ghi"), f"{rng.choice(['Unique', 'B'])}.{rng.randint(0, 200)}", "".join(rng.choice("ACGT") for _ in range(rng.choice([2, 3, 5, 6, 7]))), rng.randint(1, 9)) for _ in range(400)]
    rows += [(g, name, seq, n + 1) for g, name, seq, n in rows[:20]]
    df = spark.createDataFrame(rows, ROWS.replace("g string", "sample_id string"))
    kept = {}
    for g, name, seq, n in rows:
        kept[g, name, seq] = max(n, kept.get((g, name, seq), 0))
    wanted = {}
    for core in (False, True):
        hits = {}
        for (g, name, seq), n in kept.items():
            refs = [(-m, s, r) for (h, r, s), m in kept.items() if h == g and r[0] == "B" and r != name]
            fit = [r for r in refs if near(seq, r[1]) and (name[0] == "U" or -r[0] > n)]
            if core and name[0] == "U" and not fit:
                parts = {seq[i : i + 3] for i in range(len(seq) - 2)}
                fit = [r for r in refs if r[1][1:4] and any(near(p, r[1][1:4]) for p in parts)]
                mark = "core"
            else:
                mark = "x"
            if fit:
                hits.setdefault((mark, g, name), []).append((-n, seq, min(fit)[2]))
        wanted[core] = {(g, name, f"{min(found)[2]}_{mark}") for (mark, g, name), found in hits.items()}
    for core in (False, True):
        found = parents.flag_parents(df, core=(1, 3) if core else None, suffix=lambda parent, child: F.lit("x"))
        assert {tuple(r) for r in found.filter("putative_parent IS NOT NULL").select("sample_id", "bc_name", "putative_parent").distinct().collect()} == wanted[core]
    assert len(wanted[True]) > len(wanted[False]) > 50
    # before, every barcode was joined by forms of its pieces
    plan = parents.flag_parents(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and plan.count("Join ") == 2
