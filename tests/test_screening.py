"""Read segments against plain Python, and the screen tables against tables written out by hand."""

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strandlens.functions import reads
from strandlens.operators import counting, screening
from strandlens.profiles import PROFILES

NAMES = ["p5_seq", "p5_q", "p7_seq", "p7_q", "bc_seq", "bc_q"]


# ---------------------------------------------------------------- segments


def place(text, anchor, most=1):
    return next((i for i in range(len(text) - len(anchor) + 1) if sum(a != b for a, b in zip(text[i:], anchor, strict=False)) <= most), None)


def near(text, at, anchor, direction, length):
    """(start, end) beside an anchor, or None."""
    if at is None:
        return None
    if direction == "upstream":
        return (at - length, at) if at >= length else None
    return at + len(anchor), min(at + len(anchor) + length, len(text))


def cut_by_hand(seq, qual, p, mask=None):
    """One read and one structure, base by base."""
    if seq is None:
        return [None] * 6
    if mask:
        seq = "".join("N" if i < len(qual) and ord(qual[i]) - 33 < mask else c for i, c in enumerate(seq))

    def mean(q, extra=0):
        scores = [ord(c) - 33 for c in q] + [30] * extra
        return sum(scores) / len(scores) if scores else 0.0

    turned, turned_qual = (reads.revcomp_text(seq), qual[::-1]) if p.strand == "rev" else (seq, qual)
    p5 = near(seq, place(seq, p.ref_p5), p.ref_p5, p.dir_p5, p.len_p5)
    out = [seq[slice(*p5)], mean(qual[slice(*p5)])] if p5 else [None, None]
    bc_at, extra, fill = place(turned, p.ref_bc), 0, ""
    bc = near(turned, bc_at, p.ref_bc, p.dir_bc, p.len_bc)
    if p.dual is None:
        out += [None, None]
    else:
        d = p.dual
        p7_at = place(turned, d.ref_p7)
        p7 = near(turned, p7_at, d.ref_p7, d.dir_p7, d.len_p7)
        if p7 is None:
            return [*out, None, None, None, None]
        text = turned[slice(*p7)]
        out += [reads.revcomp_text(text) if d.beside_bc else text, mean(turned_qual[slice(*p7)])]
        if not d.beside_bc:
            start = p7_at + len(d.ref_p7)
            bc = (start, bc_at) if bc_at is not None and start <= bc_at else None
            if bc and d.fill:
                short = max(p.len_bc - (bc[1] - bc[0]), 0)
                fill = d.fill[max(len(d.fill) - short, 0) :] if short else ""
                extra = min(max(p.len_bc - len(turned_qual[slice(*bc)]), 0), len(d.fill))
    return [*out, *((fill + turned[slice(*bc)], mean(turned_qual[slice(*bc)], extra)) if bc else (None, None))]


def some_reads(rng, n):
    def bases(k):
        return "".join(rng.choice("ACGT") for _ in range(k))

    def worn(anchor):
        changed = list(anchor)
        for _ in range(rng.choice([0, 0, 1, 2])):
            changed[rng.randrange(len(anchor))] = rng.choice("ACGT")
        return "".join(changed)

    out = []
    for _ in range(n):
        p = rng.choice(list(PROFILES.values()))
        turn = reads.revcomp_text if p.strand == "rev" else str
        body = bases(rng.choice([3, 12])) + worn(p.ref_p5)
        middle = [worn(p.ref_bc), bases(rng.choice([0, 20, 34, 45]))]
        if p.dual:
            middle += [worn(p.dual.ref_p7), bases(rng.choice([3, 8]))]
        rng.shuffle(middle)
        seq = body + bases(2) + turn("".join(middle)) + bases(rng.choice([0, 4]))
        qual = "".join(chr(33 + rng.randrange(40)) for _ in range(len(seq) - rng.choice([0, 0, 0, 5])))
        out.append((seq, qual))
    return out


@pytest.mark.parametrize("mask", [None, 2])
def test_segments_equal_those_cut_by_hand(spark, mask):
    rng = random.Random(mask or 1)
    rows = [*some_reads(rng, 150), (None, "II"), ("", ""), ("A", "I")]
    forms = {f"s{i}": replace(p, dual=None) for i, p in enumerate(PROFILES.values())} | {f"d{i}": p for i, p in enumerate(PROFILES.values()) if p.dual}
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, seq string, qual string").coalesce(2)
    found = df.select("i", reads.segments(F.col("seq"), F.col("qual"), forms, 1, mask).alias("cut")).collect()
    seen = 0
    for r in found:
        seq, qual = rows[r["i"]]
        for name, p in forms.items():
            wanted = cut_by_hand(seq, qual, p, mask)
            got = [r["cut"][name][n] for n in NAMES]
            seen += wanted[4] is not None
            assert got == [pytest.approx(w) if isinstance(w, float) else w for w in wanted], (seq, qual, name)
    assert seen > 20


def test_reads_without_qualities(spark):
    p = PROFILES["X"]
    seq = "ACGTACGT" + p.ref_p5 + "C" * 45
    df = spark.createDataFrame([(seq, None), (seq, ""), ("é" + seq, "I" * 200)], "seq string, qual string")
    found = [(r["p5_seq"], r["p5_q"], r["bc_q"]) for r in screening.parse_reads(df, replace(p, dual=None)).collect()]
    assert found == [("ACGTACGT", None, None), ("ACGTACGT", 0.0, 0.0), ("ACGTACGT", 40.0, 40.0)]


def test_masks_and_means_of_odd_reads(spark):
    df = spark.createDataFrame([("ACGT", "I5I5"), ("ACGT", "5"), ("AC", "5555"), ("", ""), (None, "I"), ("A", None)], "s string, q string")
    assert [r[0] for r in df.select(reads.masked(F.col("s"), F.col("q"), 30)).collect()] == ["ANGN", "NCGT", "NN", "", None, None]
    assert [r[0] for r in df.select(reads.mean_quality(F.col("q"))).collect()] == [30.0, 20.0, 20.0, 0.0, 40.0, None]


def test_no_interpreted_lambdas_over_reads(spark):
    """Qualities are summed in the kernel, and a filter on them isn't evaluated by another pass over the bases."""
    df = spark.createDataFrame([("ACGT", "IIII")], "seq string, qual string")
    m = PROFILES["M"]
    for plan in (
        counting.count_barcodes(screening.passing(screening.parse_reads(df, m), 15, m.dual.len_p7)),
        screening.parse_reads(df, m),
        screening.classify(df, list(PROFILES.values()), 15),
    ):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("ArrowEvalPython") == 1 and not any(f in text for f in ("transform(", "aggregate(", "zip_with(", "split("))


# ---------------------------------------------------------------- tables

RESOLVED = "profile_outcome string, profiles array<string>, bc_count long, profile string, structure string, bc_seq string, ref_match array<string>, stock array<string>, ldist int, outcome string"


def classified(profile, structure, seq, n, match=None, stock=None, ldist=None):
    outcome = "stock_unknown" if stock is None else "stock_ambiguous" if len(stock) > 1 else "stock_assigned"
    return ("profile_classified", [profile], n, profile, structure, seq, match, stock, ldist, outcome)


def candidate(profiles, profile, structure, seq, n, match=None, stock=None, ldist=None):
    return ("profile_ambiguous", profiles, n, profile, structure, seq, match, stock, ldist, "profile_ambiguous")


def table(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


BY_PROFILE = ("profile", "index_structure", "bc_seq", "bc_name", "bc_count", "proportion", "ref_match", "stock", "ldist", "proportion_all_reads")
AMBIGUOUS = ("ambiguity_type", "profiles", "profile", "index_structure", "bc_seq", "bc_name", "bc_count", "proportion", "ref_match", "stocks", "ldist", "proportion_all_reads")


def test_a_sequence_has_one_number_in_its_profile(spark):
    """AAAA is seen singly and dually: its 9 reads come before the 6 of CCCC, and both of its rows have its number."""
    rows = [
        classified("M", "single", "AAAA", 5),
        classified("M", "dual", "AAAA", 4),
        classified("M", "single", "CCCC", 6),
        classified("M", "single", "GGGG", 3, ["R.1", "R.2"], ["s1"], 0),
        classified("M", "dual", "TTTT", 2, ["R.3"], ["s1"], 0),
        classified("X", "single", "CCCC", 10, ["R.4_1A"], ["s2"], 1),
    ]
    found = screening.named_barcodes(spark.createDataFrame(rows, RESOLVED), 40)
    assert set(found.columns) == set(BY_PROFILE)
    assert table(found, *BY_PROFILE[:9]) == [
        ("M", "dual", "AAAA", "Unique.1", 4, 4 / 20, "", "Unknown", None),
        ("M", "dual", "TTTT", "R.3", 2, 2 / 20, "", "s1", 0),
        ("M", "single", "AAAA", "Unique.1", 5, 5 / 20, "", "Unknown", None),
        ("M", "single", "CCCC", "Unique.2", 6, 6 / 20, "", "Unknown", None),
        ("M", "single", "GGGG", "Multi.1", 3, 3 / 20, "R.1/R.2", "s1", 0),
        ("X", "single", "CCCC", "Unique.1", 10, 1.0, "R.4_1A", "s2", 1),
    ]
    assert {r["bc_seq"] + r["index_structure"]: r["proportion_all_reads"] for r in found.collect()}["AAAAdual"] == 0.1


def test_ambiguous_barcodes_of_both_kinds(spark):
    """A stock-ambiguous barcode is in both tables; proportions are of all ambiguous rows, numbers of each profile."""
    rows = [
        classified("M", "single", "AAAA", 7, ["R.1", "R.2"], ["s1", "s2"], 0),
        classified("M", "single", "CCCC", 9),
        candidate(["M", "X"], "M", "single", "GGGG", 3),
        candidate(["M", "X"], "X", "single", "TTTT", 3),
        candidate(["M", "SL8_bc"], "M", "dual", "CCCC", 2),
        candidate(["M", "SL8_bc"], "M", "dual", "GGGG", 1),
        candidate(["M", "SL8_bc"], "SL8_bc", "single", "ACGT", 3, ["R.9"], ["s3"], 0),
    ]
    df = spark.createDataFrame(rows, RESOLVED)
    found = screening.named_barcodes(df, 100, ambiguous=True)
    assert set(found.columns) == set(AMBIGUOUS)
    assert table(found, *AMBIGUOUS[:11]) == [
        ("profile", "M/SL8_bc", "M", "dual", "CCCC", "Unique.2", 2, 2 / 19, "", "", None),
        ("profile", "M/SL8_bc", "M", "dual", "GGGG", "Unique.1", 1, 1 / 19, "", "", None),
        ("profile", "M/SL8_bc", "SL8_bc", "single", "ACGT", "R.9", 3, 3 / 19, "", "s3", 0),
        ("profile", "M/X", "M", "single", "GGGG", "Unique.1", 3, 3 / 19, "", "", None),
        ("profile", "M/X", "X", "single", "TTTT", "Unique.1", 3, 3 / 19, "", "", None),
        ("stock", "M", "M", "single", "AAAA", "Multi.1", 7, 7 / 19, "R.1/R.2", "s1/s2", 0),
    ]
    assert {r["proportion_all_reads"] for r in found.filter("ambiguity_type = 'stock'").collect()} == {0.07}
    assert table(screening.named_barcodes(df, 100), "bc_seq", "bc_name", "stock") == [("AAAA", "Multi.1", "s1/s2"), ("CCCC", "Unique.1", "Unknown")]


def test_two_rows_of_three_beside_seven(spark):
    rows = [classified("M", "single", "AAAA", 7, ["R.1", "R.2"], ["s1", "s2"], 0), candidate(["M", "X"], "M", "single", "CCCC", 3), candidate(["M", "X"], "X", "single", "CCCC", 3)]
    found = screening.named_barcodes(spark.createDataFrame(rows, RESOLVED), 10, ambiguous=True)
    assert table(found, "profile", "bc_count", "proportion") == [("M", 3, 3 / 13), ("M", 7, 7 / 13), ("X", 3, 3 / 13)]


def test_screen_tables_without_rows(spark):
    empty = spark.createDataFrame([], RESOLVED)
    for ambiguous in (False, True):
        assert screening.named_barcodes(empty, 0, ambiguous).collect() == []
