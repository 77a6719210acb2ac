"""Worked cases of the column expressions."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandlens.functions import labels, reads
from strandlens.operators.flags import row_class, row_group


def one(spark, *columns, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    row = df.select(*columns).first()
    return row[0] if len(columns) == 1 else tuple(row)


def test_quality_and_strand(spark):
    assert one(spark, reads.mean_quality(F.col("q")), q="II5?") == 32.5
    assert one(spark, reads.mean_quality(F.col("q")), q="") == 0.0
    assert one(spark, reads.reverse_complement(F.col("s")), s="ACGTNX") == "XNACGT"
    assert one(spark, reads.masked(F.col("s"), F.col("q"), 30), s="ACGT", q="I5I5") == "ANGN"


def test_anchor_and_neighbours(spark):
    assert one(spark, reads.find_anchor(F.col("s"), "AGGT", 1), s="xxACGTxx") == 3
    assert one(spark, reads.find_anchor(F.col("s"), "AGGT", 0), s="xxACGTxx") == 0
    assert one(spark, reads.beside(F.col("s"), F.lit(6), 3, "upstream", 8), s="ACGTACGTAC") is None
    assert one(spark, reads.beside(F.col("s"), F.lit(6), 3, "downstream", 8), s="ACGTACGTACG") == "ACG"
    assert one(spark, reads.between(F.col("s"), F.lit(1), 3, F.lit(4)), s="ACGTTT") == ""
    assert one(spark, reads.between(F.col("s"), F.lit(3), 3, F.lit(4)), s="ACGTTT") is None
    assert one(spark, reads.padded(F.col("s"), 5, "GGGTT"), s="AC") == "GTTAC"
    assert one(spark, reads.padded_quality(F.col("q"), 5, "GGGTT"), q="II") == pytest.approx((3 * 30 + 80) / 5)
    with pytest.raises(ValueError):
        reads.beside(F.lit("A"), F.lit(1), 1, "sideways", 1)


@settings(max_examples=60, deadline=None)
@given(st.text("ACGT", max_size=30), st.text("ACGT", min_size=3, max_size=6) | st.text("ACGT", min_size=16, max_size=40), st.integers(0, 3), st.booleans(), st.lists(st.integers(0, 39), max_size=4), st.text("ACGT", max_size=9))
def test_anchor_search_is_the_leftmost_window(seq, anchor, mismatches, back, changes, tail):
    import numpy as np

    near = "".join("ACGT"["ACGT".index(c) - 1] if i in changes else c for i, c in enumerate(anchor))
    seq += (reads.revcomp_text(near) if back else near) + tail
    text = reads.revcomp_text(seq) if back else seq
    hits = [i for i in range(len(text) - len(anchor) + 1) if sum(a != b for a, b in zip(text[i:], anchor, strict=False)) <= mismatches]
    data = np.frombuffer(f"GGGG{seq}TTT".encode(), dtype=np.uint8)
    offsets = np.array([0, 4, 4 + len(seq), len(data)])
    side = (reads._COMPLEMENT[data[::-1]], len(data) - offsets[::-1]) if back else (data, offsets)
    found = reads._first_places(*side, reads._eights(side[0]), np.frombuffer(anchor.encode(), dtype=np.uint8), mismatches)
    assert found[1] == (hits[0] + 1 if hits else 0)


def test_null_and_wide_texts_in_anchor_search(spark):
    df = spark.createDataFrame([(None,), ("",), ("éACGT",), ("ACGT",)], "s string")
    assert [r[0] for r in df.select(reads.find_anchor(F.col("s"), "ACGA", 1)).collect()] == [None, 0, 2, 1]


def test_suffixes(spark):
    for child, wanted in (("ACGA", "4A"), ("ACG", "indel"), ("ACGT", "other"), ("TCGA", "1T-4A"), ("CGTA", "indel")):
        assert one(spark, reads.substitution_suffix(F.lit("ACGT"), F.col("c")), c=child) == wanted
    for child, wanted in (("ACGA", "3=1X"), ("ACGT", "4="), ("AGT", "1=1D2=")):
        assert one(spark, reads.edit_path_suffix(F.lit("ACGT"), F.col("c")), c=child) == wanted


def test_labels(spark):
    flags = spark.createDataFrame([("Yes",), ("1",), ("not checked!",), (None,), ("0",), ("2",)], "x string")
    assert [r[0] for r in flags.select(labels.flag(F.col("x"))).collect()] == [True, True, False, False, False, True]
    dates = {"2020-01-02": "2020-01-02", "1/2/2020": "2020-01-02", "1/2/20": "2020-01-02", "2020/01/02": "2020-01-02", "soon": "soon", "45000": "45000"}
    for given_, wanted in dates.items():
        assert one(spark, labels.date_text(F.col("d")), d=given_) == wanted
    assert one(spark, labels.input_amount(F.col("x")), x="20,000") == 20000.0
    assert one(spark, labels.input_amount(F.col("x")), x=" INF") == float("inf")
    with pytest.raises(Exception, match="not an input amount"):
        one(spark, labels.input_amount(F.col("x")), x="abc")
    assert one(spark, labels.label_text(F.col("x")), x="12.0") == "12"
    assert one(spark, labels.base_name(F.col("x")), x="SIVmac239M.1_5C-12A") == "SIVmac239M.1"
    assert one(spark, labels.output_stem(F.col("x")), x="a.b.FQ.gz") == "a.b"
    assert one(spark, labels.legacy_distance(F.col("x")), x="NA-NA") is None
    for value, shown in ((0.25, "0.25"), (0.012345, "0.0123"), (1.0, "1"), (0.0, "0")):
        assert spark.range(1).select(labels.shown_number(F.lit(value))).first()[0] == shown
    with pytest.raises(Exception, match="missing part"):
        one(spark, labels.joined_id(F.col("x"), F.lit(None)), x="a")


def test_row_groups(spark):
    cases = [(True, None, "BC.1", 8, 0), (True, None, "Spike.1", 9, 1), (True, "p", "Unique.1", 14, 1), (False, None, "BC.1", 0, 2), (True, "p", "Spike", 13, 1)]
    df = spark.createDataFrame([c[:3] for c in cases], "a boolean, p string, n string")
    cls = row_class(F.col("a"), F.col("p"), F.col("n"))
    assert [tuple(r) for r in df.select(cls, row_group(cls)).collect()] == [c[3:] for c in cases]
