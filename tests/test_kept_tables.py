"""Long tables that are read several times are kept as Parquet, not as checkpoints of rows."""

from pyspark.sql import functions as F

from strandlens import catalog
from strandlens.operators import collapse
from strandlens.plans import sinks, views

SF = "/root/testdata/sf0.001"


def leaves(df):
    plan = df._jdf.queryExecution().analyzed().toString()
    return "LogicalRDD" in plan, "parquet" in plan


def test_collapsed_rows_are_kept_as_parquet(spark):
    rows = spark.sql("SELECT 'a' AS sample_id, 'B.' || id AS bc_name, 'ACGT' AS bc_seq, id AS bc_count, 0.1D AS proportion, true AS above_cutoff, 9.0D AS input, if(id = 1, 'B.2_1A', null) AS putative_parent FROM range(1, 5)")
    assert leaves(collapse.collapse_to_parent(rows)) == (False, True)
    assert leaves(collapse.collapse_ambiguous(rows)) == (False, True)
    assert {r["bc_name"]: r["bc_count"] for r in collapse.collapse_to_parent(rows).collect()} == {"B.2": 3, "B.3": 3, "B.4": 4}


def test_side_by_side_rows_are_kept_as_parquet(spark):
    rows = catalog.obs(spark, SF).withColumnsRenamed({"ldist_all": "putative_parent"}).withColumns({"ldist_samp_lvl": F.lit(None).cast("string"), "x_idx": F.lit(None).cast("double")})
    assert leaves(views.sidelong_rows(rows)) == (False, True)


def test_a_long_table_is_written_compressed_and_read_whole(spark, tmp_path):
    rows = spark.range(5000, numPartitions=2).selectExpr("'sample' AS sample_id", "'BC.' || id AS bc_name")
    sinks.write_long(rows, str(tmp_path / "plain"))
    sinks.write_long(rows, str(tmp_path / "gz"), compression="gzip")
    size = {f: sum(p.stat().st_size for p in (tmp_path / f).glob("part-*")) for f in ("plain", "gz")}
    assert size["gz"] * 3 < size["plain"] and sorted(map(tuple, spark.read.csv(str(tmp_path / "gz"), header=True).collect())) == sorted(map(tuple, rows.collect()))
