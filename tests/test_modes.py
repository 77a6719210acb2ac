"""Files in, files out: sources, the three modes, streaming."""

import gzip

import pytest
from pyspark.sql import functions as F

from strandlens.functions.reads import revcomp_text
from strandlens.operators import screening
from strandlens.plans import compile as compiled
from strandlens.plans import sinks, views
from strandlens.plans.parse import ParseSettings, parse_run, sorted_long
from strandlens.plans.screen import ScreenSettings, screen_run
from strandlens.profiles import PROFILES, screen_stocks, stock_profile
from strandlens.schema import conform
from strandlens.sources import fastq, refs, runinfo, sheets, workbook

M = PROFILES["M"]
BARCODES = {"M.1": "ACGTACGTACGTACGTACGTACGTACGTACGTAC", "M.2": "TTTTACGTACGTAAAAACGTACGTACGTACGTAC"}


def read_m(idx, barcode, p5=M.ref_p5):
    return f"ACGT{idx}{p5}TTGACA{revcomp_text(M.ref_bc)}{revcomp_text(barcode)}GGCC"


def fastq_text(seqs, ending="\n"):
    return "".join(f"@r{i}{ending}{s}{ending}+{ending}{'@' + 'I' * (len(s) - 1)}{ending}" for i, s in enumerate(seqs))


@pytest.fixture
def samples(spark):
    table = spark.createDataFrame([(1, "7", "A1", "s1", "1/2/2020", "P5.1", "100"), (2, None, "A1", "s2", "2020-01-03", "P5.2", "inf")], 'row int, "Run Number" string, Animal string, Sample string, Date string, Barcodes string, "Input TOTAL PER BARCODE" string'.replace('"', "`"))
    return runinfo.samples_from_sheet(table.withColumn("file", F.lit("f")))


def test_fastq_ranges_and_endings(spark, tmp_path):
    seqs = [f"ACGT{'ACGT'[i % 4] * (i % 7)}" for i in range(500)]
    plain, crlf, packed, cut = (tmp_path / n for n in ("a.fastq", "b.fq", "c.fastq.gz", "d.fastq"))
    plain.write_text(fastq_text(seqs))
    crlf.write_bytes(fastq_text(seqs, "\r\n").encode())
    packed.write_bytes(gzip.compress(fastq_text(seqs).encode()))
    for path in (plain, crlf, packed):
        for size in (97, 1000, 1 << 20):
            found = fastq.read_fastq(spark, str(path), rangebytes=str(size))
            assert sorted(r["seq"] for r in found.collect()) == sorted(seqs)
        assert sorted(r["seq"] for r in fastq.read_fastq_text(spark, str(path)).collect()) == sorted(seqs)
    cut.write_text(fastq_text(seqs)[:-20].rsplit("\n", 2)[0] + "\n")
    with pytest.raises(Exception, match="inside a record"):
        fastq.read_fastq(spark, str(cut)).collect()


def test_references(spark, tmp_path):
    (tmp_path / "r.fasta").write_bytes(b">a\r\nAC\r\nGT\r\n\r\n>b\nTT\n>a\nGG\n")
    found = {r["name"]: r["seq"] for r in refs.read_fasta(spark, str(tmp_path / "r.fasta")).collect()}
    assert found == {"a": "GG", "b": "TT"}
    (tmp_path / "p.csv").write_bytes("﻿idx,seq\r\nP5.1, ACGT\r\nP5.2,TT\r\n".encode())
    assert {r["idx"]: r["seq"] for r in refs.read_primers(spark, str(tmp_path / "p.csv")).collect()} == {"P5.1": "ACGT", "P5.2": "TT"}
    one = refs.read_fasta(spark, str(tmp_path / "r.fasta"))
    with pytest.raises(Exception, match="repeat the name"):
        refs.merge_refs(one, one.limit(1)).collect()


def test_workbook_round_trip(spark, tmp_path):
    path = tmp_path / "x_Analysis.xlsx"
    rows = [["Run Number", "B"], [7, None], ["Run Name", True], ["my <run>", 0.5]]
    workbook.write_workbook(str(path), {"info": rows})
    cells = {(r, c): v for _, _, r, c, v in workbook.cells_of(path.read_bytes())}
    assert cells == {(0, 0): "Run Number", (0, 1): "B", (1, 0): "7", (2, 0): "Run Name", (2, 1): "True", (3, 0): "my <run>", (3, 1): "0.5"}
    (tmp_path / "~$y_Analysis.xlsx").write_bytes(b"")
    found = workbook.read_cells(workbook.find_workbooks(spark, str(tmp_path)))
    assert workbook.value_below(found, "Run Name").first()["value"] == "my <run>"
    with pytest.raises(FileNotFoundError):
        workbook.find_workbooks(spark, str(tmp_path), r"nothing\.xlsx$")


def test_parse_then_compile(spark, tmp_path, samples):
    spare = M.ref_p5[:4] + "A" + M.ref_p5[5:]
    seqs = [read_m("AAAACCCC", BARCODES["M.1"])] * 60 + [read_m("AAAACCCG", BARCODES["M.1"], spare)] * 5
    seqs += [read_m("GGGGTTTT", BARCODES["M.2"])] * 30 + [read_m("GGGGTTTT", BARCODES["M.2"][:-1] + "A")] * 3 + ["ACGT" * 20] * 4
    (tmp_path / "run.fastq").write_text(fastq_text(seqs))
    reads_ = fastq.read_fastq(spark, str(tmp_path / "run.fastq"))
    p5 = spark.createDataFrame([("P5.1", "AAAACCCC"), ("P5.2", "GGGGTTTT"), ("P5.3", "CCCCCCCC")], "idx string, seq string")
    known = spark.createDataFrame(list(BARCODES.items()), "name string, seq string")
    _, profile = stock_profile("239M")
    run = parse_run(reads_, samples, p5, known, ParseSettings(profile), filename="run.fastq", run_name="R", run_date="2020-02-02")
    rows = {(r["idx_name"], r["bc_name"]): r for r in sorted_long(run.long).collect()}
    assert {k: r["bc_count"] for k, r in rows.items()} == {("P5.1", "M.1"): 65, ("P5.2", "M.2"): 30, ("P5.2", "Unique.1"): 3}
    assert rows["P5.2", "Unique.1"]["putative_parent"] == "M.2_34A"
    assert rows["P5.1", "M.1"]["run_id"] == "7::run.fastq" and rows["P5.1", "M.1"]["samp_date"] == "2020-01-02"
    assert {r["idx_name"]: (r["n_reads"], r["n_bc"], r["n_bc_named"]) for r in run.summary.collect()} == {"P5.1": (65, 1, 1), "P5.2": (33, 2, 1)}
    found = parse_run(reads_, samples, p5, known.limit(0), ParseSettings(profile, discover=True))
    assert {r["bc_name"] for r in found.long.collect()} == {"BC.1", "BC.2", "BC.3"}

    raw = spark.createDataFrame([("7", "A1", "s1", "2020-01-02", "P5.1", "100"), (None, "A1", "s2", "2020-01-03", "P5.2", "inf"), ("Run Name", None, None, None, None, None), ("R", None, None, None, None, None)], "`Run Number` string, Animal string, Sample string, Date string, Barcodes string, `Input TOTAL PER BARCODE` string")
    heads = raw.columns
    books = tmp_path / "books"
    books.mkdir()
    workbook.write_workbook(str(books / "R_Analysis.xlsx"), {"runinfo": [heads, *(list(r) for r in raw.collect())], "A1 samples": sinks.sidelong_grid(run.long)})
    series = compiled.compile_runs(spark, workbooks=str(books), settings=compiled.CompileSettings(group_level=True, contamination=True))
    every, above = series.every, series.above
    kept = {(r["idx_name"], r["bc_name"]): r["bc_count"] for r in every.collect()}
    assert kept == {("P5.1", "M.1"): 65, ("P5.2", "M.2"): 33}
    assert all(abs(r["proportion"] - 1) < 1e-9 for r in above.collect())
    sinks.write_long(every, str(tmp_path / "base"))
    info = {r["sample_id"]: r for r in series.runinfo.collect() if r["sample_id"]}
    assert series.runs == 1 and {(r["run_name"], r["run_number"], r["Sample"], r["source"]) for r in info.values()} == {("R", "7", "s1", "analysis: R_Analysis.xlsx"), ("R", "7", "s2", "analysis: R_Analysis.xlsx")}
    again = compiled.compile_runs(spark, workbooks=str(books), base_csv=str(tmp_path / "base")).every
    assert again.count() == 2 and {r["source_note_"] for r in again.collect()} == {"analysis: R_Analysis.xlsx"}
    only = compiled.compile_runs(spark, base_csv=str(tmp_path / "base"))
    assert only.every.count() == 2 and {(r["Animal"], r["Sample"], r["Barcodes"], r["source"]) for r in only.runinfo.collect()} == {("A1", "s1", "P5.1", "base_csv: base"), ("A1", "s2", "P5.2", "base_csv: base")}
    check_parse_workbooks(run, raw.withColumn("idx_name", F.when(F.col("Barcodes") != "Barcodes", F.col("Barcodes"))), tmp_path)
    (books / "broken_Analysis.xlsx").write_bytes(b"no zip")
    workbook.write_workbook(str(books / "odd_Analysis.xlsx"), {"runinfo": [heads[:4]], "A1 samples": sinks.sidelong_grid(run.long)})
    others = [["Run Number", "Animal", "Sample", "Date", "Barcodes", "Input TOTAL PER BARCODE"], ["7", "A9", "s1", "2020-01-02", "P5.1", "100"]]
    workbook.write_workbook(str(books / "other_Analysis.xlsx"), {"runinfo": others, "A1 samples": sinks.sidelong_grid(run.long)})
    with pytest.raises(workbook.WorkbookError) as failed:
        compiled.compile_runs(spark, workbooks=str(books))
    assert {f for f, _ in failed.value.failures} == {"broken_Analysis.xlsx", "odd_Analysis.xlsx", "other_Analysis.xlsx"}
    with pytest.raises(ValueError, match="expected index"):
        parse_run(reads_, samples, p5.withColumn("seq", F.lit("TATATATA")).filter("idx = 'P5.1'"), known, ParseSettings(profile))
    vectors = views.matrix_vectors(views.counted_rows(run.long)).collect()
    assert len(vectors) == 2 and {len(r["tops"]) for r in vectors} == {2} and [r["vector"] for r in sorted(vectors, key=lambda r: r["place"])] == sorted((r["vector"] for r in vectors), reverse=True)


def sheet_rows(path, sheet):
    """The rows of a sheet, as lists with the empty text where a cell is."""
    rows = {}
    for _, name, r, c, v in workbook.cells_of(open(path, "rb").read()):
        if name == sheet:
            rows.setdefault(r, {})[c] = v
    width = 1 + max(c for row in rows.values() for c in row)
    return [[rows.get(r, {}).get(c, "") for c in range(width)] for r in range(1 + max(rows))]


def check_parse_workbooks(run, raw, folder):
    path = sinks.write_parse_workbook(run, raw, str(folder), "R", settings={"stock": "239M"})
    assert {c[1] for c in workbook.cells_of(open(path, "rb").read())} == {"runinfo", "A1 raw", "A1 samples", "A1 matrix", "Analysis settings"}
    samples, whole = sheet_rows(path, "A1 samples"), sheet_rows(path, "A1 raw")
    assert samples[6][:2] == ["input", "100.0"] and [r[1] for r in samples if r[0] == "samp_name"] == ["s1"]
    assert sum("Unique.1" in r for r in whole) == 1 and sum("Unique.1" in r for r in samples) == 0
    assert any("33" in r for r in samples) and not any("33" in r for r in whole)
    info = sheet_rows(path, "runinfo")
    assert info[0][:6] == raw.columns[:6] and {"n_reads", "n_bc", "n_bc_named", "n_reads_ac", "count-to-input_ratio", "notes"} <= set(info[0])
    reads_at, barcode = info[0].index("n_reads"), info[0].index("Barcodes")
    assert {(r[barcode], r[reads_at]) for r in info[1:] if r[barcode]} == {("P5.1", "65"), ("P5.2", "33")}
    assert ["stock", "239M"] in sheet_rows(path, "Analysis settings") and len(sheet_rows(path, "A1 matrix")) == 3
    with pytest.warns(UserWarning, match="no barcodes found for A7"):
        path = sinks.write_parse_workbook(run, raw, str(folder), "S", collapse=False, legacy=True, expected_groups=["A1", "A7"])
    old = sheet_rows(path, "A1 samples")
    assert old[0][:6] == ["A1", "s1", "2020-01-02"] * 2 and old[1][0] == "Sequencer Input" and old[2][:4] == ["100.0", "65", "1", "0.0"] and old[4][0] == "Barcode"
    assert any("NA-NA" in r for r in old) and len(sheet_rows(path, "A1 matrix")) == 4
    book = [{"filename": "S", "modified": None, "content": bytearray(open(path, "rb").read())}]
    spark = run.long.sparkSession
    back = workbook.sample_blocks(workbook.read_cells(spark.createDataFrame(book, "filename string, modified timestamp, content binary")))
    assert {(r["samp_name"], r["bc_name"], r["bc_count"]) for r in back.collect()} == {("s1", "M.1", "65"), ("s2", "M.2", "30"), ("s2", "Unique.1", "3")}
    path = sinks.write_parse_workbook(run, raw, str(folder), "T", collapse=False, matrix_above_only=True)
    assert len(sheet_rows(path, "A1 matrix")) == 3


def test_sidelong_grid_keeps_every_sample(spark, monkeypatch):
    rows = [("A", f"s{i}", "2020-01-02", f"B.{k}", "ACGT"[k % 4] * (k + 1), 10 - k, 0.1, True) for i in range(4) for k in range(5)]
    df = conform(spark.createDataFrame(rows, "samp_group string, samp_name string, samp_date string, bc_name string, bc_seq string, bc_count long, proportion double, above_cutoff boolean"))
    df = df.withColumn("sample_id", F.col("samp_name"))
    whole = sinks.sidelong_grid(df)
    monkeypatch.setattr(sheets, "MOST_ROWS", len(whole))  # fewer than the rows of all samples, which lie side by side
    assert len(whole) < len(rows) and sinks.sidelong_grid(df) == whole
    assert sum(str(v).startswith("B.") for line in whole for v in line) == len(rows)
    monkeypatch.setattr(sheets, "MOST_ROWS", len(whole) - 1)
    with pytest.raises(ValueError):
        sinks.sidelong_grid(df)


def test_compiled_workbook_has_every_row(spark, tmp_path):
    rows = [("7", "f", f"P5.{i}", "A", f"s{i}", "2020-01-02", f"B.{k}", "ACGT"[k] * 5, 10 - k, 0.25, True) for i in range(2) for k in range(4)]
    df = conform(spark.createDataFrame(rows, "run_number string, filename string, idx_name string, samp_group string, samp_name string, samp_date string, bc_name string, bc_seq string, bc_count long, proportion double, above_cutoff boolean"))
    df = df.withColumn("ldist_all", F.lit(None).cast("string"))
    info = spark.createDataFrame([("R", "7", "A", "f", 1, "s")], "run_name string, run_number string, Animal string, file string, row int, sample_id string")
    _, path = sinks.write_compiled(compiled.Compiled(df, df, info, 1), str(tmp_path), "C", contamination=True)
    assert sheet_rows(path, "runinfo") == [["run_name", "run_number", "Animal", "sample_id"], ["R", "7", "A", "s"]]
    full = sheet_rows(path, "full_matrix")
    assert full[0][:5] == ["bc_name", "bc_seq", "ldist_all", "n_groups", "n_samps"] and len(full) == 5 and full[1][3:5] == ["1", "2"]
    with pytest.raises(ValueError, match="one sample and barcode"):
        sinks.write_compiled(compiled.Compiled(df, df.union(df), info, 1), str(tmp_path), "C")
    lines = {}
    for _, sheet, r, _, v in workbook.cells_of(open(path, "rb").read()):
        if sheet == "all_samples":
            lines.setdefault(r, []).append(v)
    assert len(lines) == 1 + len(rows) and sum("B.2" in v for v in lines.values()) == 2


def test_screen(spark, tmp_path):
    x = PROFILES["X"]
    bc45 = "ACGTT" * 9
    seqs = [read_m("AAAACCCC", BARCODES["M.1"])] * 5 + [f"ACGTAAAACCCC{x.ref_p5}{bc45}TT"] * 3 + ["GATTACA" * 10] * 2
    rows = spark.createDataFrame([(s, "I" * len(s)) for s in seqs] + [(read_m("AAAACCCC", BARCODES["M.2"]), "#" * len(read_m("AAAACCCC", BARCODES["M.2"])))], "seq string, qual string")
    known = spark.createDataFrame([("M", "S1", "M.1", BARCODES["M.1"]), ("M", "S2", "M.1b", BARCODES["M.1"][:-1] + "A"), ("X", "S3", "X.1", bc45[:-1] + "A")], "profile string, stock string, ref_name string, ref_seq string")
    run = screen_run(rows, known, ScreenSettings(mean_quality=20, stock_distance=1))
    assert {r["outcome"]: r["read_count"] for r in run.summary.collect()} == {"total_reads": 11, "profile_not_found": 2, "quality_filtered": 1, "profile_ambiguous": 0, "stock_unknown": 0, "stock_ambiguous": 0, "stock_assigned": 8}
    assert {(r["profile"], r["stock"], r["ldist"]): r["read_count"] for r in run.stocks.collect()} == {("M", "S1", 0): 5, ("X", "S3", 1): 3}
    assert {r["bc_name"] for r in run.barcodes.collect()} == {"M.1", "Unique.1"}
    sinks.write_screen_workbook(run, str(tmp_path / "s.xlsx"))
    assert {c[1] for c in workbook.cells_of((tmp_path / "s.xlsx").read_bytes())} == {"Summary", "M barcodes", "X barcodes", "Ambiguous barcodes", "Screen settings"}
    assert len(screen_stocks()) == 13
    spark.catalog.clearCache()
    with pytest.raises(ValueError):
        ScreenSettings(stock_distance=-1)
    with pytest.raises(ValueError):
        stock_profile("SL8_239M", dual=True)


def test_conform_and_metadata(spark, samples):
    raw = spark.createDataFrame([("1", "f", "g.0", "s", "2020-01-01", "x", "yes", "extra")], "run_num string, filename string, samp_group string, samp_name string, samp_date string, bc_count string, above_cutoff string, note string")
    row = conform(raw, run_name="R").first()
    assert (row["run_id"], row["sample_id"], row["bc_count"], row["above_cutoff"], row["note"], row["run_name"]) == ("1::f", "g.0::s::2020-01-01::1", 0, True, "extra", "R")
    with pytest.raises(Exception, match="missing part"):
        conform(raw.drop("run_num")).collect()
    p5 = spark.createDataFrame([("P5.1", "AA"), ("P5.9", "CC")], "idx string, seq string")
    assert [tuple(r) for r in runinfo.expected_indexes(samples, p5).collect()] == [("AA", "P5.1")]
    two = samples.withColumn("sample_id", F.lit("same"))
    assert runinfo.sample_collisions(two).first()["idx_names"] == ["P5.1", "P5.2"]


def test_streaming_counts(spark, tmp_path):
    from strandlens.streaming.counts import start_counts, streaming_counts

    (tmp_path / "in").mkdir()
    rows = [(read_m("AAAACCCC", BARCODES["M.1"]), "I" * len(read_m("AAAACCCC", BARCODES["M.1"])))] * 3
    df = spark.createDataFrame(rows, "seq string, qual string")
    df.write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    _, profile = stock_profile("239M")
    running = start_counts(streaming_counts(stream, profile), str(tmp_path / "check"), "barcode_counts")
    running.processAllAvailable()
    df.write.mode("append").parquet(str(tmp_path / "in"))
    running.processAllAvailable()
    running.stop()
    assert spark.table("barcode_counts").agg(F.max("bc_count")).first()[0] == 6
    assert isinstance(screening.OUTCOMES, tuple)
