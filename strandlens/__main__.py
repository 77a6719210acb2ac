"""Command line: python -m strandlens parse | screen | compile."""

from __future__ import annotations

import argparse
import os
from functools import reduce

from pyspark.sql import functions as F

from .plans import sinks
from .plans.compile import CompileSettings, compile_runs, update_store
from .plans.parse import ParseSettings, parse_run, sorted_long
from .plans.screen import ScreenSettings, screen_run
from .profiles import CONTROL, P5_FILE, P7_FILE, read_profile, screen_stocks, stock_profile
from .session import session
from .sources import fastq, refs, runinfo


def arguments() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="strandlens")
    modes = top.add_subparsers(dest="mode", required=True)
    parse, screen, compile_ = (modes.add_parser(m) for m in ("parse", "screen", "compile"))
    for p in (parse, screen):
        p.add_argument("fastq")
        p.add_argument("--refs", required=True, help="folder of primer tables and FASTA files")
        p.add_argument("--mean-quality", type=float, default=30.0)
        p.add_argument("--mismatches", type=int, default=1)
    parse.add_argument("--runinfo", required=True)
    parse.add_argument("--stock", help="a known stock")
    parse.add_argument("--profile", help="a JSON file with the fields of a read profile, and reference (a FASTA file in --refs) or discover, instead of a stock")
    parse.add_argument("--dual", action="store_true")
    parse.add_argument("--spike", action="store_true", help="add the control's reference")
    parse.add_argument("--mask", action="store_true", help="bases below --mask-below become N")
    parse.add_argument("--mask-below", type=int, default=20)
    parse.add_argument("--collapse-ambiguous", action="store_true")
    parse.add_argument("--collapse-to-parent", action=argparse.BooleanOptionalAction, default=True, help="add children to their parents in the workbook; raw sheets keep them")
    parse.add_argument("--matrix-above-only", action="store_true", help="matrices of the barcodes that count, not of all")
    parse.add_argument("--legacy-format", action="store_true", help="the older form of the sample tables")
    compile_.add_argument("--workbooks", help="folder of result workbooks, or a .txt file that names them")
    compile_.add_argument("--base-csv")
    compile_.add_argument("--store", help="a folder that keeps the runs: the workbooks are added to it, then all its runs are compiled")
    compile_.add_argument("--keep-children", action="store_true")
    for level in ("sample-level", "group-level", "contamination"):
        compile_.add_argument(f"--{level}", action="store_true")
    for p, distance in ((parse, 1), (screen, 0), (compile_, 1)):
        p.add_argument("--distance", type=int, default=distance)
        p.add_argument("--out", default=".")
        p.add_argument("--name", default="run")
    return top


def main(given: list[str] | None = None) -> None:
    a = arguments().parse_args(given)
    spark = session()
    os.makedirs(a.out, exist_ok=True)
    if a.mode == "parse":
        if (a.stock is None) == (a.profile is None):
            raise SystemExit("give either --stock or --profile")
        stock, profile = stock_profile(a.stock, a.dual) if a.stock else read_profile(a.profile, a.dual)
        samples, runs = runinfo.read_samples(spark, a.runinfo, a.dual)
        raw = runinfo.raw_metadata(runinfo.sheet_cells(spark, a.runinfo), a.dual)
        primers = [refs.read_primers(spark, os.path.join(a.refs, f)) for f in (P5_FILE, P7_FILE)[: 2 if a.dual else 1]]
        known = spark.createDataFrame([], "name string, seq string")
        if stock.fasta:
            known = refs.merge_refs(known, refs.read_fasta(spark, os.path.join(a.refs, stock.fasta)))
        if a.spike:
            known = refs.merge_refs(known, refs.read_fasta(spark, os.path.join(a.refs, CONTROL.fasta)), "control")
        run = runs.first()
        settings = ParseSettings(profile, stock.discover, a.mean_quality, a.mask_below if a.mask else None, a.mismatches, parent_distance=a.distance, collapse_ambiguous=a.collapse_ambiguous)
        found = parse_run(fastq.read_fastq(spark, a.fastq), samples, primers[0], known, settings, primers[1] if a.dual else None, os.path.basename(a.fastq), run["run_name"], run["run_date"])
        sinks.write_long(sorted_long(found.long), os.path.join(a.out, f"{a.name}_concat.csv"))
        groups = sinks.groups_of(samples)
        sinks.write_parse_workbook(found, raw, a.out, a.name, stock.discover, vars(a), a.collapse_to_parent, a.matrix_above_only, a.legacy_format, groups)
    elif a.mode == "screen":
        parts = [refs.read_fasta(spark, os.path.join(a.refs, s.fasta)).select(F.lit(s.profile).alias("profile"), F.lit(s.name).alias("stock"), F.col("name").alias("ref_name"), F.col("seq").alias("ref_seq")) for s in screen_stocks() if os.path.exists(os.path.join(a.refs, s.fasta))]
        if not parts:
            raise FileNotFoundError(f"no reference of any stock in {a.refs}")
        used = {f"reference:{s.profile}:{s.name}": s.fasta for s in screen_stocks() if os.path.exists(os.path.join(a.refs, s.fasta))}
        found = screen_run(fastq.read_fastq(spark, a.fastq), reduce(lambda x, y: x.unionByName(y), parts), ScreenSettings(a.mean_quality, a.mismatches, a.distance))
        sinks.write_screen_workbook(found, os.path.join(a.out, f"{a.name}_screen.xlsx"), vars(a) | used)
    else:
        books = a.workbooks
        if a.store and books:
            update_store(spark, a.store, books)
            books = None
        found = compile_runs(spark, books, a.base_csv, CompileSettings(not a.keep_children, a.distance, a.sample_level, a.group_level, a.contamination), a.store)
        sinks.write_compiled(found, a.out, a.name, a.contamination)


if __name__ == "__main__":
    main()
