"""Distances of whole batches against loops over one pair, and the joins that know nothing of a metric, or keep an index."""

import itertools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strandlens import catalog
from strandlens.functions import metrics
from strandlens.operators import distance


def edits(a, b, swaps=False):
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            best = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if swaps and i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[-2][j - 2] + 1)
            row.append(best)
        rows.append(row)
    return rows


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


LOOPS = {
    "levenshtein": lambda a, b: edits(a, b)[-1][-1],
    "osa": lambda a, b: edits(a, b, True)[-1][-1],
    "indel": lambda a, b: len(a) + len(b) - 2 * common(a, b),
    "lcsseq": lambda a, b: max(len(a), len(b)) - common(a, b),
    "hamming": lambda a, b: sum(x != y for x, y in zip(a, b, strict=False)),
}


def script(a, b):
    """The shortest script by walking back from the end: replacing before losing before adding."""
    table = edits(a, b)
    steps, i, j = [], len(a), len(b)
    while i or j:
        if i and j and table[i][j] == table[i - 1][j - 1] + (a[i - 1] != b[j - 1]):
            steps.append("=" if a[i - 1] == b[j - 1] else "X")
            i, j = i - 1, j - 1
        elif i and table[i][j] == table[i - 1][j] + 1:
            steps.append("D")
            i -= 1
        else:
            steps.append("I")
            j -= 1
    out = []
    for s in reversed(steps):
        if out and out[-1][1] == s:
            out[-1][0] += 1
        else:
            out.append([1, s])
    return "".join(f"{n}{s}" for n, s in out)


def pairs(seed, n=150):
    rng = random.Random(seed)
    out = [("", ""), ("", "a"), ("a", ""), (None, "a"), ("a", None), ("a\0", "a"), ("é😀", "😀é")]
    for _ in range(n):
        letters = rng.choice(["AC", "ACGT", "abcdefghé😀\0"])
        a = "".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 34, 63, 64, 65, 128, 200])))
        worn = "".join(c if rng.random() > 0.2 else rng.choice(letters) for c in a if rng.random() > 0.1)
        b = rng.choice([a, worn, "".join(rng.choice(letters) for _ in range(rng.choice([0, 3, 64, 150])))])
        if len(b) > 3 and rng.random() < 0.5:
            k = rng.randrange(len(b) - 1)
            b = b[:k] + b[k + 1] + b[k] + b[k + 2 :]
        out.append((a, b))
    return out


@pytest.mark.parametrize("name", sorted(LOOPS))
def test_metrics_of_batches_equal_loops(name, monkeypatch):
    rows = pairs(name)
    wanted = [None if a is None or b is None else LOOPS[name](a, b) for a, b in rows]
    a, b = pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])
    assert metrics.metric(a, b, name).to_pylist() == wanted
    monkeypatch.setattr(metrics, "CELLS", 500)  # lots of a few pairs
    assert metrics.metric(a, b, name).to_pylist() == wanted
    assert metrics.metric(a[:0], b[:0], name).to_pylist() == []


def test_edit_scripts_equal_walks(monkeypatch):
    rows = pairs("walk", 80)
    a, b = pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])
    wanted = [None if x is None or y is None else script(x, y) for x, y in rows]
    assert metrics.edit_scripts(a, b).to_pylist() == wanted
    monkeypatch.setattr(metrics, "CELLS", 9000)
    assert metrics.edit_scripts(a, b).to_pylist() == wanted
    # two and more edits, read off by hand
    few = [("ACGT", "ACGA", "3=1X"), ("ACGT", "AGT", "1=1D2="), ("ACGTACGT", "AGTACGTT", "1=1D5=1I1="), ("AAAA", "TTTT", "4X"), ("ACGTAC", "TACGTA", "1I5=1D")]
    assert metrics.edit_scripts(pa.array([f[0] for f in few]), pa.array([f[1] for f in few])).to_pylist() == [f[2] for f in few]


# ---------------------------------------------------------------- a caller's own metric


def tables(spark, seed, n=120, key=True):
    rng = random.Random(seed)
    seqs = ["".join(rng.choice("ACGT") for _ in range(rng.choice([0, 6, 6, 6, 7]))) for _ in range(n)]
    q = spark.createDataFrame([(None if i == 5 else "hot" if i % 4 else "x", i, s) for i, s in enumerate(seqs)], "k string, query_id int, query_seq string").coalesce(2)
    return q, q.toDF("k", "ref_id", "ref_seq")


def all_pairs(q, r, keys, measure, radius):
    left, right = q.collect(), r.collect()
    return {(x["query_id"], y["ref_id"], measure(x["query_seq"], y["ref_seq"])) for x in left for y in right if all(x[k] == y[k] and x[k] is not None for k in keys) and measure(x["query_seq"], y["ref_seq"]) <= radius}


def edges(df):
    return {(x["query_id"], x["ref_id"], x["dist"]) for x in df.collect()}


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("radius", [0, 2, 5])
def test_landmarks_equal_all_pairs(spark, keys, radius):
    q, r = tables(spark, radius)
    found = distance.distance_join(q, r, radius, keys=keys, metric=catalog.weighted_changes)
    assert edges(found) == all_pairs(q, r, keys, catalog.weighted_changes, radius)
    text = found._jdf.queryExecution().optimizedPlan().toString()
    assert "band_0" in text and "Cross" not in text


def test_a_function_that_is_no_metric(spark):
    """No triangle inequality: it is probed, and all references of a key are asked, in blocks."""

    def odd(a, b):
        return (len(a) - len(b)) ** 2 + 3 * sum(x != y for x, y in zip(a, b, strict=False)) ** 2

    q, r = tables(spark, 7, 60)
    assert distance.probe_metric(q, "query_seq", odd)["triangle"] > 0
    found = distance.distance_join(q, r, 4, keys=["k"], metric=odd)
    assert edges(found) == all_pairs(q, r, ["k"], odd, 4)
    assert "block_" in found._jdf.queryExecution().optimizedPlan().toString()
    assert edges(distance.distance_join(q, r, 4, metric=odd, is_metric=False)) == all_pairs(q, r, [], odd, 4)


def test_own_metrics_without_rows(spark):
    q, r = tables(spark, 1, 20)
    for keys in ([], ["k"]):
        assert distance.distance_join(q, r.limit(0), 2, keys=keys, metric=catalog.weighted_changes).collect() == []
        assert distance.distance_join(q.limit(0), r, 2, keys=keys, metric=catalog.weighted_changes).collect() == []


# ---------------------------------------------------------------- short texts, stored indexes


@pytest.mark.parametrize(("metric", "radius"), [("levenshtein", 3), ("indel", 2), ("lcsseq", 2), ("osa", 2), ("hamming", 3)])
def test_very_short_texts_by_segments(spark, metric, radius):
    rng = random.Random(radius)
    seqs = ["".join(rng.choice("AC") for _ in range(rng.randint(0, 6))) for _ in range(50)]
    q = spark.createDataFrame([(i % 2, i, s) for i, s in enumerate(seqs)], "k int, query_id int, query_seq string").coalesce(1)
    r = q.toDF("k", "ref_id", "ref_seq")

    def measure(a, b):
        return 99 if metric == "hamming" and len(a) != len(b) else LOOPS[metric](a, b)

    assert edges(distance.distance_join(q, r, radius, keys=["k"], metric=metric)) == all_pairs(q, r, ["k"], measure, radius)


@pytest.mark.parametrize(("metric", "radius"), [("levenshtein", 2), ("levenshtein", 3), ("osa", 2), ("hamming", 1)])
def test_a_stored_index(spark, tmp_path, metric, radius):
    rng = random.Random(radius)
    seqs = ["".join(rng.choice("ACG") for _ in range(rng.choice([1, 8, 9]))) for _ in range(80)]
    q = spark.createDataFrame(list(enumerate(seqs)), "id int, seq string").coalesce(1)
    every = q.toDF("ref_id", "ref_seq")
    built = distance.RefIndex.build(every.filter("ref_id < 40"), "ref_id", "ref_seq", str(tmp_path / "index"), radius, metric, buckets=4)
    built.add(every.filter("ref_id >= 30"), "ref_id", "ref_seq")  # some of them again
    again = distance.RefIndex.open(spark, str(tmp_path / "index"))
    for index, radii in ((built, [radius]), (again, range(radius + 1))):
        for asked in radii:
            wanted = distance.distance_join(q.toDF("query_id", "query_seq"), every, asked, metric=metric, exclude_same_id=True)
            found = index.query(q, "id", "seq", asked, exclude_same_id=True)
            assert edges(found) == edges(wanted)
            # both sides of every query: forms are made of the queries only, references are read
            plan = found._jdf.queryExecution().optimizedPlan().toString()
            assert plan.count("Generate explode") <= (1 if radius <= 2 and metric in ("levenshtein", "hamming") else 2)
            assert f"{index.table}" in plan
    nearest = again.query(q, "id", "seq", radius, scope="min", tie="min_id").collect()
    assert all(x["dist"] == 0 for x in nearest) and len(nearest) == 80
    with pytest.raises(ValueError, match="radius"):
        again.query(q, "id", "seq", radius + 1)
    with pytest.raises(ValueError, match="known metric"):
        distance.RefIndex.build(every, "ref_id", "ref_seq", str(tmp_path / "other"), 1, LOOPS["indel"])


def test_a_stored_index_is_not_shuffled(spark, tmp_path):
    every = spark.range(2000).select(F.col("id").alias("ref_id"), F.lpad(F.conv(F.col("id").cast("string"), 10, 4), 8, "0").alias("ref_seq"))
    index = distance.RefIndex.build(every, "ref_id", "ref_seq", str(tmp_path / "index"), 1, buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.query(every, "ref_id", "ref_seq", 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "Bucketed: true" in scan and plan.count("hashpartitioning(form") == 1


def test_pairs_within_one_edit_are_found_once(spark):
    texts = ["", "A", "AA", "AAA", "AB", "BA", "ABA", "BAB", "ABAB", "BABA", "AABB", "ABB", "é", "éA", "AAB", "BAA", "ABC", "ACB", "A"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, seq string")
    for metric in ("levenshtein", "hamming"):
        near = distance.distance_join(rows, rows, 1, metric=metric, query=("id", "seq"), ref=("id", "seq"))
        found = sorted((r["query_id"], r["ref_id"], r["dist"]) for r in near.collect())
        allowed = [(i, j) for i, s in enumerate(texts) for j, t in enumerate(texts) if metric == "levenshtein" or len(s) == len(t)]
        far = {(i, j): slow_levenshtein(texts[i], texts[j]) for i, j in allowed}
        assert found == sorted((i, j, d) for (i, j), d in far.items() if d <= 1)
    # no pair is shuffled to be told from itself, and the forms of a small table aren't broadcast
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortMergeJoin") < plan.index("HashAggregate") and "BroadcastHashJoin" not in plan


def slow_levenshtein(s, t):
    line = list(range(len(t) + 1))
    for i, x in enumerate(s, 1):
        last, line[0] = line[0], i
        for j, y in enumerate(t, 1):
            last, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, last + (x != y))
    return line[-1]


def test_equal_texts_are_compared_once(spark):
    rows = spark.range(400).selectExpr("id", "array('ACGTAC', 'ACGTA', 'GGTTAA', 'ACGTTC')[int(id % 4)] AS seq")
    seen = spark.sparkContext.accumulator(0)
    whole = distance.distance

    def counted(metric, left, right, limit=None):
        @F.pandas_udf("string")
        def tap(s):
            seen.add(len(s))
            return s

        return whole(metric, tap(left), right, limit)

    distance.distance = counted
    try:
        near = distance.distance_join(rows, rows, 2, metric="indel", query=("id", "seq"), ref=("id", "seq"))
        assert near.count() == 100 * 100 * (4 + 2 + 2)  # ACGTAC is within two of ACGTA and of ACGTTC
    finally:
        distance.distance = whole
    assert seen.value <= 4 * 4 * 4


def test_pairs_within_two_edits_are_found_once(spark):
    """All short texts of two letters and random ones of three: every pair once, with its distance, and none is compared afterwards."""
    rng = random.Random(5)
    texts = sorted({"".join(t) for n in range(6) for t in itertools.product("AB", repeat=n)} | {"".join(rng.choices("ABC", k=rng.randint(3, 8))) for _ in range(120)})
    q = spark.createDataFrame(list(enumerate(texts)), "query_id long, query_seq string")
    r = q.toDF("ref_id", "ref_seq").filter("ref_id % 7 <> 3")
    found = distance.distance_join(q, r, 2)
    assert "levenshtein" not in found._jdf.queryExecution().optimizedPlan().toString()
    pairs = ((i, j, edits(a, b)[-1][-1]) for i, a in enumerate(texts) for j, b in enumerate(texts) if j % 7 != 3 and abs(len(a) - len(b)) <= 2)
    assert sorted(map(tuple, found.select("query_id", "ref_id", "dist").collect())) == sorted(p for p in pairs if p[2] <= 2)


@pytest.mark.parametrize("metric", ["levenshtein", "hamming"])
@pytest.mark.parametrize("piece", [2, 3, 4])
def test_pairs_within_one_edit_by_pieces(spark, metric, piece):
    dice = random.Random(piece)
    # runs and short texts, so that an edit may be at several places and in several pieces
    texts = ["".join(dice.choice("AAC") for _ in range(dice.randrange(13))) for _ in range(150)]
    rows = [(i % 2, i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "sample int, id int, seq string")
    limits = dict(keys=["sample"], metric=metric, piece=piece, query=("id", "seq"), ref=("id", "seq"))
    found = [(r["query_id"], r["ref_id"], r["dist"]) for r in distance.distance_join(df, df, 1, **limits).collect()]
    near = LOOPS["levenshtein"] if metric == "levenshtein" else lambda a, b: sum(x != y for x, y in zip(a, b, strict=True)) if len(a) == len(b) else 9
    wanted = [(i, j, near(a, b)) for (k, i, a), (m, j, b) in itertools.product(rows, rows) if k == m and near(a, b) <= 1]
    assert sorted(found) == sorted(wanted)
    texts_as_ids = distance.distance_join(df, df, 1, **(limits | dict(query=("seq", "seq"), ref=("id", "seq")))).collect()
    assert sorted((r["query_id"], r["ref_id"], r["dist"]) for r in texts_as_ids) == sorted({(texts[i], j, d) for i, j, d in wanted})


def test_two_texts_are_given_to_an_own_metric_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def metric(a, b):
        calls.add(1)
        return catalog.weighted_changes(a, b)

    texts = ["".join(t) for t in itertools.product("AG", repeat=4)]
    df = spark.createDataFrame([(i, t) for t in texts for i in range(texts.index(t) * 3, texts.index(t) * 3 + 3)], "id int, seq string")
    found = distance.distance_join(df, df, 4, metric=metric, query=("id", "seq"), ref=("id", "seq"), is_metric=True)
    assert found.count() == (3 * 16) ** 2
    assert calls.value <= 16 * 17 // 2 + 16 * 16  # each pair, and the texts against landmarks
