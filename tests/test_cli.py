"""The command line, from files to files."""

from strandlens.__main__ import main
from strandlens.sources import workbook

from .test_modes import BARCODES, fastq_text, read_m


def sheets(path):
    return {c[1] for c in workbook.cells_of(path.read_bytes())}


def test_three_modes(spark, tmp_path):
    (tmp_path / "refs").mkdir()
    (tmp_path / "refs/P5_primers.csv").write_text("idx,seq\nP5.1,AAAACCCC\nP5.2,GGGGTTTT\n")
    (tmp_path / "refs/OptM_reference.fasta").write_text("".join(f">{k}\n{v}\n" for k, v in BARCODES.items()))
    (tmp_path / "run.fastq").write_text(fastq_text([read_m("AAAACCCC", BARCODES["M.1"])] * 9 + [read_m("GGGGTTTT", BARCODES["M.2"])] * 4))
    (tmp_path / "info.csv").write_text("Run Number,Animal,Sample,Date,Barcodes,Input TOTAL PER BARCODE\n7,A1,s1,2020-01-02,P5.1,100\n,A2,s2,2020-01-03,P5.2,inf\nRun Name,,,,,\nR,,,,,\n")
    main(["parse", str(tmp_path / "run.fastq"), "--refs", str(tmp_path / "refs"), "--runinfo", str(tmp_path / "info.csv"), "--stock", "OptM", "--out", str(tmp_path / "o"), "--name", "R"])
    assert sheets(tmp_path / "o/R_Analysis.xlsx") == {"runinfo", "A1 raw", "A1 samples", "A1 matrix", "A2 raw", "A2 samples", "A2 matrix", "Analysis settings"}
    main(["screen", str(tmp_path / "run.fastq"), "--refs", str(tmp_path / "refs"), "--out", str(tmp_path / "o"), "--name", "R"])
    assert {"Summary", "M barcodes"} <= sheets(tmp_path / "o/R_screen.xlsx")
    main(["compile", "--base-csv", str(tmp_path / "o/R_concat.csv"), "--contamination", "--out", str(tmp_path / "o"), "--name", "C"])
    assert {"runinfo", "all_samples", "full_matrix", "A1 samples", "A2 matrix"} <= sheets(tmp_path / "o/C_above_cutoff.xlsx")
    rows = spark.read.csv(str(tmp_path / "o/C_all.csv"), header=True).collect()
    assert {(r["bc_name"], r["bc_count"]) for r in rows} == {("M.1", "9"), ("M.2", "4")}
    spark.catalog.clearCache()
