"""Session settings the engine is designed for."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import NullType

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "strandlens", **settings: str) -> SparkSession:
    """A session with the engine's settings; keyword names have underscores for dots."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a new local one only where that is unset and Spark runs on this machine alone (tests)."""
    import tempfile

    found = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if not found and current.isDefined():
        found = current.get()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="strandlens-")
    if not current.isDefined():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


_scratch: dict[str, SparkSession] = {}


def scratch(spark: SparkSession) -> str:
    """The path of a new folder in the shared one, which is removed when the program ends."""
    path = f"{shared_folder(spark)}/strandlens/{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_remove_scratch)
    _scratch[path] = spark
    return path


def _remove_scratch() -> None:
    for path, spark in _scratch.items():
        if spark.sparkContext._jsc is not None:  # a stopped session leaves its folders to their owner
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def keep_checkpoints(spark: SparkSession) -> None:
    """Checkpoints go to the shared folder."""
    shared_folder(spark)


def settled(df: DataFrame) -> DataFrame:
    """df computed once and kept in the checkpoint folder, for tables that several later branches read; what is kept already stays."""
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRDD":
        return df
    keep_checkpoints(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame) -> DataFrame:
    """`settled` for long tables: kept as Parquet, which takes a tenth of the disk and of which a branch reads its own columns only."""
    names = [c.lower() for c in df.columns]
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() == "LogicalRDD" or len(set(names)) < len(names) or any(isinstance(f.dataType, NullType) for f in df.schema):
        return settled(df)
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
