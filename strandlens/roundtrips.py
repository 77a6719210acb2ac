"""Queries through files and whole modes: what is written is read back, and held against SQL over the driver's tables.

`brands` is a long table as small as a report: regions are groups, nations samples, years runs, brands barcodes.
"""

from __future__ import annotations

import os
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import _SEQS, _SINGLE, LEAST, OBS, PLACES, READS, SHOWN, M, _near, _parents_sql, dna, dna_sql, obs, query, read_rows, rounded, table
from .functions import labels, reads
from .operators import flags
from .plans import compile as compiled
from .plans import sinks
from .plans.parse import ParsedRun, ParseSettings, parse_run
from .schema import conform
from .session import scratch, settled
from .sources import fastq, refs, runinfo, workbook
from .streaming.counts import streaming_counts


def work_folder(spark: SparkSession) -> str:
    """A new folder in the shared one, for files that driver and executors both open."""
    path = scratch(spark).removeprefix("file://").removeprefix("file:")
    os.makedirs(path)
    return path


# ---------------------------------------------------------------- sequencing files and references


def _fastq_lines(spark: SparkSession, sf_dir: str) -> str:
    name = F.concat_ws(".", F.lit("@r"), F.col("rid").cast("string"), F.col("line").cast("string"))
    path = f"{work_folder(spark)}/reads"
    read_rows(spark, sf_dir).select(F.concat_ws("\n", name, "seq", F.lit("+"), "qual")).write.text(path)
    for part in os.listdir(path):
        if part.endswith(".txt"):
            os.rename(f"{path}/{part}", f"{path}/{part[:-4]}.fastq")
    return path


_FASTQ = f"WITH {READS} SELECT '@r.' || rid || '.' || line AS header, seq, qual FROM reads"


@query(_FASTQ)
def fastq_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fastq.read_fastq(spark, _fastq_lines(spark, sf_dir), rangebytes=str(1 << 18)).select("header", "seq", "qual")


@query(_FASTQ)
def fastq_text_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fastq.read_fastq_text(spark, _fastq_lines(spark, sf_dir) + "/*.fastq").select("header", "seq", "qual")


@query(_FASTQ)
def fastq_blocks_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gzipped files of blocks, each read in several ranges."""
    name = F.concat_ws(".", F.lit("@r"), F.col("rid").cast("string"), F.col("line").cast("string"))
    folder = f"{work_folder(spark)}/reads"
    fastq.write_fastq(read_rows(spark, sf_dir).select(name.alias("header"), "seq", "qual"), folder)
    return fastq.read_fastq(spark, folder, rangebytes=str(1 << 18)).select("header", "seq", "qual")


@query(f"SELECT 'P.' || p_partkey AS name, {dna_sql('p_partkey', 8)} AS seq FROM part")
def fasta_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    seq, path = dna(F.col("p_partkey"), 8), f"{work_folder(spark)}/parts"
    text = F.concat(F.lit(">P."), F.col("p_partkey").cast("string"), F.lit("\n"), F.substring(seq, 1, 3), F.lit("\r\n\n"), F.substring(seq, F.lit(4), F.length(seq)))
    table(spark, sf_dir, "part").select(text).write.text(path)
    return refs.read_fasta(spark, path)


@query(f"SELECT s_name AS idx, {dna_sql('s_suppkey * 97 % 65536', 8)} AS seq FROM supplier")
def primer_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_folder(spark)}/primers"
    rows = table(spark, sf_dir, "supplier").select(F.concat(F.col("s_name"), F.lit(" ")).alias("idx"), F.concat(F.lit(" "), dna(F.col("s_suppkey") * 97 % 65536, 8)).alias("seq"))
    rows.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    return refs.read_primers(spark, path)


# ---------------------------------------------------------------- run metadata


METADATA = ("Run Number", "Animal", "Sample", "Date", "Barcodes", "Input TOTAL PER BARCODE", "(F Barcode)", "Note")


def _supplier_sheet(spark: SparkSession, sf_dir: str) -> list[list[object]]:
    """A metadata sheet: a row for each supplier, the run's name and date below."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).orderBy("s_suppkey")
    rows = [list(METADATA)]
    for i, r in enumerate(s.select("n_name", "s_name", "s_suppkey").collect()):
        k = r["s_suppkey"]
        date = f"{1 + k % 12}/{1 + k % 28}/2021" if k % 2 else f"2021-{1 + k % 12:02}-{1 + k % 28:02}"
        rows.append([7 if not i else None, r["n_name"], f" {r['s_name']}", date, r["s_name"], "INF" if k % 5 == 0 else f"{k},000", f"F{k % 3}" if k % 3 else None, f"note {k}"])
    return [*rows, [None] * 8, ["Run Name"], ["the run"], ["Date"], ["2/3/2021"]]


_SAMPLES = f"""s AS (SELECT n_name AS samp_group, s_name AS samp_name, s_name || CASE WHEN s_suppkey % 3 <> 0 THEN '_F' || s_suppkey % 3 ELSE '' END AS idx_name,
  strftime(make_date(2021, (1 + s_suppkey % 12)::INT, (1 + s_suppkey % 28)::INT), '%Y-%m-%d') AS samp_date, CASE WHEN s_suppkey % 5 = 0 THEN 'inf'::DOUBLE ELSE s_suppkey * 1000.0 END AS input,
  s_suppkey, s_name AS p5_name, CASE WHEN s_suppkey % 3 <> 0 THEN 'F' || s_suppkey % 3 END AS p7_name FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""


def _metadata(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame, DataFrame]:
    path = f"{work_folder(spark)}/info.xlsx"
    workbook.write_workbook(path, {"info": _supplier_sheet(spark, sf_dir)})
    return path, *runinfo.read_samples(spark, path, dual=True)


@query(f"WITH {_SAMPLES} SELECT idx_name, samp_group, samp_name, samp_date, CAST(input AS VARCHAR) = 'inf' AS open_input, CASE WHEN CAST(input AS VARCHAR) <> 'inf' THEN input END AS input, p5_name, p7_name, 'note ' || s_suppkey AS Note, concat_ws('::', samp_group, samp_name, samp_date, '7') AS sample_id, 'the run' AS run_name, '2021-02-03' AS run_date FROM s")
def metadata_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample of a metadata sheet, with the name and date of its run."""
    open_ = F.col("input") == float("inf")
    _, samples, runs = _metadata(spark, sf_dir)
    return samples.join(runs.select("run_number", "run_name", "run_date"), "run_number").select("idx_name", "samp_group", "samp_name", "samp_date", open_.alias("open_input"), F.when(~open_, F.col("input")).alias("input"), "p5_name", "p7_name", "Note", "sample_id", "run_name", "run_date")


@query(f"WITH {_SAMPLES} SELECT idx_name, samp_group AS Animal, samp_date AS Date, 'note ' || s_suppkey AS Note FROM s")
def metadata_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _metadata(spark, sf_dir)[0]
    return runinfo.raw_metadata(runinfo.sheet_cells(spark, path), dual=True).filter("idx_name IS NOT NULL").select("idx_name", "Animal", "Date", "Note")


@query(f"WITH {_SAMPLES} SELECT DISTINCT idx_name, {dna_sql('s_suppkey', 8)} || {dna_sql('s_suppkey % 3', 4)} AS idx_seq FROM s WHERE p7_name IS NOT NULL")
def expected_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    p5 = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("idx"), dna(F.col("s_suppkey"), 8).alias("seq"))
    p7 = spark.range(3).select(F.concat(F.lit("F"), F.col("id").cast("string")).alias("idx"), dna(F.col("id"), 4).alias("seq"))
    return runinfo.expected_indexes(_metadata(spark, sf_dir)[1], p5, p7).select("idx_name", "idx_seq")


# ---------------------------------------------------------------- older texts


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'REF.' || o_orderkey WHEN 2 THEN '.' || o_orderkey ELSE 'B.' || o_orderkey || '-2' END AS old_distance,
  'SIVmac239M2.' || o_orderkey AS fixed, CASE WHEN o_orderstatus = 'F' THEN 'Yes' ELSE '' END AS shown, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '0.' || lpad(CAST(o_orderkey % 9 + 1 AS VARCHAR), 2, '0') END AS share FROM orders""")
def older_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, key = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    n = key.cast("string")
    old = F.when(key % 4 == 0, F.lit("1-NA-NA")).when(key % 4 == 1, F.concat(F.lit("1-REF."), n)).when(key % 4 == 2, F.concat(F.lit("Unique."), n, F.lit("-1"))).otherwise(F.concat(F.lit("B."), n, F.lit("-2")))
    share = F.when(key % 5 != 0, (key % 9 + 1) / 100)
    return o.select("o_orderkey", labels.legacy_distance(old).alias("old_distance"), labels.fixed_name(F.concat(F.lit("SIVmac293M2."), n)).alias("fixed"), labels.shown_flag(F.col("o_orderstatus") == "F").alias("shown"), labels.shown_number(share).alias("share"))


@query(f"WITH {_SEQS.format(d=1)}, p AS (SELECT *, list_filter(range(1, 9), lambda i: substr(query_seq, i, 1) <> substr(ref_seq, i, 1))[1] AS i FROM near WHERE length(query_seq) = length(ref_seq)) SELECT query_id, ref_id, CASE WHEN i > 1 THEN (i - 1) || '=' ELSE '' END || '1X' || CASE WHEN i < 8 THEN (8 - i) || '=' ELSE '' END AS path FROM p")
def edit_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = _near(spark, sf_dir, 1).filter(F.length("query_seq") == F.length("ref_seq"))
    query, ref = (F.substring(c, 1, SHOWN) for c in ("query_seq", "ref_seq"))  # a change further back shows as 1X
    return near.select("query_id", "ref_id", F.when(query == ref, F.lit("1X")).otherwise(reads.edit_path_suffix(ref, query)).alias("path"))


# ---------------------------------------------------------------- whole parse


_PARSED = f"""{READS}, {_SINGLE},
samples AS (SELECT n_name AS samp_group, s_name AS idx_name, {dna_sql('s_suppkey * 97 % 65536', 8)} AS idx_seq, CASE WHEN s_suppkey % 5 = 0 THEN 0.1 ELSE 1 / (20.0 * (1 + s_suppkey % 7)) END AS cut, s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
counts AS (SELECT idx_name, bc_seq, count(*) AS bc_count FROM parsed JOIN samples ON p5_seq = idx_seq WHERE p5_q >= {LEAST} AND bc_q >= {LEAST} GROUP BY 1, 2),
known AS (SELECT {dna_sql('p_partkey * 1048583', 34)} AS bc_seq, 'R.' || p_partkey AS ref_name FROM part WHERE p_partkey % 3 = 0),
totals AS (SELECT bc_seq, row_number() OVER (ORDER BY sum(bc_count) DESC, bc_seq) AS n FROM counts ANTI JOIN known USING (bc_seq) GROUP BY 1),
named AS (SELECT c.*, coalesce(ref_name, 'Unique.' || n) AS bc_name FROM counts c LEFT JOIN known USING (bc_seq) LEFT JOIN totals USING (bc_seq)),
shared AS (SELECT n.*, cut, bc_count / sum(bc_count) OVER (PARTITION BY idx_name) AS proportion, bc_name LIKE 'Unique%' AS uniq FROM named n JOIN samples USING (idx_name)),
least AS (SELECT *, min(CASE WHEN NOT uniq AND proportion > cut THEN proportion END) OVER (PARTITION BY idx_name) AS low FROM shared),
flagged AS (SELECT *, CASE WHEN uniq THEN proportion > coalesce(100 * low, cut) ELSE proportion > cut END AS above_cutoff FROM least)"""


def parsed_run(spark: SparkSession, sf_dir: str) -> ParsedRun:
    """The reads as a run whose samples are the suppliers; every third part is a reference."""
    key = F.col("s_suppkey")
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    amount = F.when(key % 5 == 0, F.lit(float("inf"))).otherwise(20.0 * (1 + key % 7))
    samples = s.select(F.lit("7").alias("run_number"), F.col("s_name").alias("idx_name"), F.col("n_name").alias("samp_group"), F.col("s_name").alias("samp_name"), F.lit("2021-01-01").alias("samp_date"), amount.alias("input"), F.col("s_name").alias("p5_name"), F.lit(None).cast("string").alias("p7_name"), F.concat_ws("::", "n_name", "s_name", F.lit("2021-01-01"), F.lit("7")).alias("sample_id"))
    p5 = s.select(F.col("s_name").alias("idx"), dna(key * 97 % 65536, 8).alias("seq"))
    part = F.col("p_partkey")
    known = table(spark, sf_dir, "part").filter(part % 3 == 0).select(F.concat(F.lit("R."), part.cast("string")).alias("name"), dna(part * 1048583, 34).alias("seq"))
    # no core: every barcode of a part is near others in the middle
    return parse_run(read_rows(spark, sf_dir).select("seq", "qual"), samples, p5, known, ParseSettings(replace(M, dual=None, core=None), mean_quality=LEAST), filename="run.fastq.gz", run_name="R", run_date="2021-02-03")


@query(f"""WITH {_PARSED}, {_parents_sql('idx_name', 'flagged', 34)}
SELECT f.idx_name, f.bc_name, f.bc_seq, f.bc_count, round(proportion, {PLACES}) AS proportion, above_cutoff, p.putative_parent, f.bc_seq LIKE '%{reads.SHORT_MOTIF}%' AS short_bc,
  round(CASE WHEN min(f.idx_name) OVER w <> max(f.idx_name) OVER w THEN f.bc_count / sum(f.bc_count) OVER w END, {PLACES}) AS x_idx
FROM flagged f LEFT JOIN parent p ON p.idx_name = f.idx_name AND p.bc_name = f.bc_name WINDOW w AS (PARTITION BY f.bc_name)""")
def parse_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = parsed_run(spark, sf_dir).long
    return long.select("idx_name", "bc_name", "bc_seq", "bc_count", rounded("proportion"), "above_cutoff", "putative_parent", "short_bc", rounded("x_idx"))


@query(f"""WITH {_PARSED} SELECT idx_name, coalesce(sum(bc_count), 0)::BIGINT AS n_reads, count(bc_seq) AS n_bc, count(*) FILTER (WHERE bc_name LIKE 'R.%') AS n_bc_named, coalesce(sum(bc_count) FILTER (WHERE above_cutoff), 0)::BIGINT AS n_reads_ac,
  CASE WHEN any_value(s.cut) = 0.1 THEN 0.0 ELSE round(coalesce(sum(bc_count), 0) * any_value(s.cut), 6) END AS count_to_input_ratio FROM samples s LEFT JOIN flagged f USING (idx_name) GROUP BY 1""")
def parse_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = parsed_run(spark, sf_dir).summary
    return found.select("idx_name", "n_reads", "n_bc", "n_bc_named", "n_reads_ac", F.round("count_to_input_ratio", 6).alias("count_to_input_ratio"))


@query(f"WITH {READS}, {_SINGLE} SELECT p5_seq AS idx_seq, bc_seq, count(*) AS bc_count FROM parsed WHERE p5_q >= {LEAST} AND bc_q >= {LEAST} GROUP BY 1, 2")
def stream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of a stream of reads that has ended."""
    folder = work_folder(spark)
    read_rows(spark, sf_dir).select("seq", "qual").write.parquet(f"{folder}/reads")
    stream = spark.readStream.schema("seq string, qual string").parquet(f"{folder}/reads")
    counts = streaming_counts(stream, replace(M, dual=None), LEAST)
    # the last whole table of counts; written by tasks, so that the driver holds none of it
    writer = counts.writeStream.outputMode("complete").option("checkpointLocation", f"{folder}/check").trigger(availableNow=True)
    writer.foreachBatch(lambda rows, _: rows.write.mode("overwrite").parquet(f"{folder}/counts")).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(f"{folder}/counts")


# ---------------------------------------------------------------- workbooks and compilation


_BRANDS = f"""brands AS (SELECT r_name AS samp_group, n_name AS samp_name, CAST(year(l_shipdate) AS VARCHAR) AS run_number, n_name AS idx_name, p_brand, sum(CAST(l_quantity AS BIGINT))::BIGINT AS bc_count
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey GROUP BY ALL),
coded AS (SELECT *, CAST(regexp_extract(p_brand, '[0-9]+') AS BIGINT) AS k FROM brands),
long AS (SELECT samp_group, samp_name, run_number, idx_name, run_number || '-01-02' AS samp_date, bc_count, {dna_sql('k * 7', 6)} AS bc_seq, CASE WHEN k % 5 = 0 THEN 'Unique.' || k ELSE 'B.' || k END AS bc_name,
  100.0::DOUBLE AS input, bc_count / sum(bc_count) OVER (PARTITION BY samp_name, run_number) AS proportion, k % 2 = 0 AS short_bc FROM coded),
judged AS (SELECT *, CASE WHEN bc_name LIKE 'Unique%' THEN proportion > coalesce(100 * min(CASE WHEN bc_name NOT LIKE 'Unique%' AND proportion > 0.01 THEN proportion END) OVER (PARTITION BY samp_name, run_number), 0.01) ELSE proportion > 0.01 END AS above_cutoff FROM long)"""


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: table(spark, sf_dir, n) for n in ("lineitem", "supplier", "nation", "region", "part")}
    rows = t["lineitem"].join(t["supplier"], F.col("l_suppkey") == F.col("s_suppkey")).join(t["nation"], F.col("s_nationkey") == F.col("n_nationkey"))
    rows = rows.join(t["region"], F.col("n_regionkey") == F.col("r_regionkey")).join(t["part"], F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.groupBy("r_name", "n_name", F.year("l_shipdate").cast("string").alias("run_number"), "p_brand").agg(F.sum(F.col("l_quantity").cast("long")).alias("bc_count"))
    k = F.regexp_extract("p_brand", "[0-9]+", 0).cast("long")
    flat = rows.select(
        F.col("r_name").alias("samp_group"), F.col("n_name").alias("samp_name"), "run_number", F.col("n_name").alias("idx_name"), F.concat("run_number", F.lit("-01-02")).alias("samp_date"), "bc_count",
        dna(k * 7, 6).alias("bc_seq"), F.concat(F.when(k % 5 == 0, F.lit("Unique.")).otherwise(F.lit("B.")), k.cast("string")).alias("bc_name"), F.lit(100.0).alias("input"), (k % 2 == 0).alias("short_bc"),
        F.concat(F.lit("run_"), "run_number").alias("filename"), F.concat(F.lit("name "), "run_number").alias("run_name"), F.concat("run_number", F.lit("-02-03")).alias("run_date"),
    )
    whole = conform(flat)
    return settled(flags.with_above_cutoff(flags.with_proportion(whole)))


def _books(spark: SparkSession, rows: DataFrame) -> str:
    """A workbook for each run: its metadata sheet and the samples of each group."""
    folder = work_folder(spark)
    # the lines of all runs at once: a run's group is a group of its own
    grids = sinks.sidelong_grids(rows.withColumn("samp_group", F.concat_ws("|", "run_number", "samp_group")))
    samples = rows.select("run_number", "samp_group", "samp_name", "samp_date", "idx_name", "input").distinct().orderBy("run_number", "samp_group", "samp_name").collect()
    for run in sorted({r["run_number"] for r in samples}):
        mine = [r for r in samples if r["run_number"] == run]
        info: list[list[object]] = [list(METADATA[:6])]
        info += [[None if i else run, *(r[c] for c in ("samp_group", "samp_name", "samp_date", "idx_name", "input"))] for i, r in enumerate(mine)]
        info += [["Run Name"], [f"name {run}"], ["Date"], [f"{run}-02-03"]]
        own = {g: f"{run}|{g}" for g in sorted({r["samp_group"] for r in mine})}
        sheets = {f"{g} samples": [[g if v == own[g] else v for v in line] for line in grids[own[g]]] for g in own}
        workbook.write_workbook(f"{folder}/run_{run}_Analysis.xlsx", {"runinfo": info, **sheets})
    return folder


@query(f"WITH {_BRANDS} SELECT samp_group, samp_name, samp_date, bc_name, bc_seq, bc_count, above_cutoff, short_bc FROM judged")
def workbook_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The side-by-side sheets, read back as cells and blocks."""
    cells = settled(workbook.read_cells(workbook.find_workbooks(spark, _books(spark, brands(spark, sf_dir)))))
    found = workbook.sample_blocks(cells)
    return found.select("samp_group", "samp_name", labels.date_text(F.col("samp_date")).alias("samp_date"), "bc_name", "bc_seq", F.col("bc_count").cast("long").alias("bc_count"), "above_cutoff", labels.flag(F.col("short_bc")).alias("short_bc"))


_SERIES = f"""{_BRANDS}, top AS (SELECT max(run_number) AS last FROM judged),
kept AS (SELECT *, CASE WHEN run_number = last THEN 'base_csv: base' ELSE 'analysis: run_' || run_number || '_Analysis.xlsx' END AS source FROM judged, top),
uniques AS (SELECT bc_seq, row_number() OVER (ORDER BY sum(bc_count) DESC, bc_seq) AS n FROM kept WHERE bc_name LIKE 'Unique%' GROUP BY 1),
series AS (SELECT k.* EXCLUDE (bc_name), CASE WHEN bc_name LIKE 'Unique%' THEN 'Unique.' || n ELSE bc_name END AS bc_name, concat_ws('::', samp_group, samp_name, samp_date, run_number) AS sample_id FROM kept k LEFT JOIN uniques USING (bc_seq))"""


def _series(spark: SparkSession, sf_dir: str) -> compiled.Compiled:
    """All runs but the last from workbooks; a former compilation with wrong counts for these, and the last run."""
    rows = brands(spark, sf_dir)
    last = rows.agg(F.max("run_number")).first()[0]
    books = _books(spark, rows.filter(F.col("run_number") != last))
    base = f"{work_folder(spark)}/base"
    sinks.write_long(rows.withColumn("bc_count", F.when(F.col("run_number") == last, F.col("bc_count")).otherwise(F.lit(1))), base)
    return compiled.compile_runs(spark, books, base, compiled.CompileSettings(collapse_to_parent=False))


@query(f"""WITH {_SERIES} SELECT sample_id, bc_name, bc_seq, bc_count, above_cutoff, source,
  round(CASE WHEN min(idx_name) OVER r <> max(idx_name) OVER r THEN bc_count / sum(bc_count) OVER r END, 6) AS x_idx, coalesce(min(samp_name) OVER g <> max(samp_name) OVER g, false) AS multi_idx
FROM series WINDOW r AS (PARTITION BY run_number, bc_name), g AS (PARTITION BY run_number, samp_group, bc_name)""")
def compile_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = _series(spark, sf_dir).every
    return every.select("sample_id", "bc_name", "bc_seq", "bc_count", "above_cutoff", F.col("source_note_").alias("source"), F.round("x_idx", 6).alias("x_idx"), "multi_idx")


_STORED = f"""{_BRANDS}, uniques AS (SELECT bc_seq, row_number() OVER (ORDER BY sum(bc_count) DESC, bc_seq) AS n FROM judged WHERE bc_name LIKE 'Unique%' GROUP BY 1),
series AS (SELECT k.* EXCLUDE (bc_name), CASE WHEN bc_name LIKE 'Unique%' THEN 'Unique.' || n ELSE bc_name END AS bc_name, concat_ws('::', samp_group, samp_name, samp_date, run_number) AS sample_id FROM judged k LEFT JOIN uniques USING (bc_seq)),
{_parents_sql('sample_id', 'series', 6)}"""


@query(f"""WITH {_STORED} SELECT s.sample_id, s.bc_name, s.bc_seq, s.bc_count, above_cutoff, putative_parent AS ldist_samp_lvl,
  coalesce(min(samp_name) OVER g <> max(samp_name) OVER g, false) AS multi_idx FROM series s LEFT JOIN parent p ON p.sample_id = s.sample_id AND p.bc_name = s.bc_name WINDOW g AS (PARTITION BY run_number, samp_group, s.bc_name)""")
def compile_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A store of all runs but the last, to which the last is added, compiled with the parents within samples."""
    rows, store = brands(spark, sf_dir), work_folder(spark)
    last = rows.agg(F.max("run_number")).first()[0]
    compiled.update_store(spark, store, _books(spark, rows.filter(F.col("run_number") != last)))
    compiled.update_store(spark, store, _books(spark, rows.filter(F.col("run_number") == last)))
    every = compiled.compile_runs(spark, settings=compiled.CompileSettings(collapse_to_parent=False, sample_level=True), store=store).every
    return every.select("sample_id", "bc_name", "bc_seq", "bc_count", "above_cutoff", "ldist_samp_lvl", "multi_idx")


@query(f"WITH {_SERIES} SELECT DISTINCT 'name ' || run_number AS run_name, run_number, samp_group AS Animal, samp_name AS Sample, samp_date AS Date, CASE WHEN source LIKE 'base%' THEN split_part(idx_name, '_', 1) ELSE idx_name END AS Barcodes, sample_id, source FROM series")
def compile_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _series(spark, sf_dir).runinfo.filter("sample_id IS NOT NULL")
    return found.select("run_name", "run_number", "Animal", "Sample", "Date", "Barcodes", "sample_id", "source")


@query(f"WITH {_SERIES}, a AS (SELECT *, bc_count / sum(bc_count) OVER (PARTITION BY sample_id) AS p FROM series WHERE above_cutoff) SELECT sample_id, bc_name, bc_seq, bc_count, round(p, 6) AS proportion FROM a")
def compile_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sheet of all rows above the cutoff, read back."""
    _, path = sinks.write_compiled(_series(spark, sf_dir), work_folder(spark), "C")
    files = spark.read.format("binaryFile").load(path).select(F.lit("C").alias("filename"), F.col("modificationTime").alias("modified"), "content")
    cells = workbook.read_cells(files).filter("sheet = 'all_samples'").withColumn("sheet_no", F.lit(0))
    wide = workbook.header_table(cells, ["sample_id", "bc_name", "bc_seq", "bc_count", "proportion"])
    return wide.select("sample_id", "bc_name", "bc_seq", F.col("bc_count").cast("long").alias("bc_count"), F.round(F.col("proportion").cast("double"), 6).alias("proportion"))


@query(f"WITH {OBS} SELECT sample_id, bc_name, bc_seq, bc_count, round(proportion, {PLACES}) AS proportion, above_cutoff FROM obs")
def long_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long table written as CSV and taken up again."""
    path = f"{work_folder(spark)}/long"
    sinks.write_long(obs(spark, sf_dir), path, compression="gzip")  # many times smaller; a task reads a file that a task wrote
    back = conform(spark.read.csv(path, header=True))
    return back.select("sample_id", "bc_name", "bc_seq", "bc_count", rounded("proportion"), "above_cutoff")
