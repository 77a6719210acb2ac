"""Small helpers of the corpus operators: inputs, and tables that cut lineage."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a new local one only where that is unset and Spark runs on this machine alone (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            found = current.get()
        elif spark.sparkContext.master.startswith("local"):
            found = tempfile.mkdtemp(prefix="strandlens-")
            spark.sparkContext.setCheckpointDir(found)
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return found.rstrip("/")


_made: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends here and survives lost executors.

    The table stays until `drop`, or until the program ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strandlens/{uuid.uuid4().hex}-{name}"
    df.write.option("compression", "zstd").parquet(path)
    if not _left:
        atexit.register(_drop_left)
    _left[path] = spark
    out = spark.read.schema(df.schema).parquet(path)
    _made[out] = path
    return out


_left: dict[str, SparkSession] = {}


def drop(*tables: DataFrame) -> None:
    """Remove tables that `cut` wrote and that nothing reads any more."""
    for table in tables:
        path = _made.pop(table, None)
        if path:
            _remove(_left.pop(path), path)


def _remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def _drop_left() -> None:
    for path, spark in _left.items():
        if spark.sparkContext._jsc is not None:  # a stopped session leaves its tables to the folder's owner
            _remove(spark, path)


def file_bytes(df: DataFrame) -> int:
    """Spark's own estimate of the size of df from its files, or where it has none, the length of its texts."""
    found = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if found < 1 << 58:
        return found
    lengths = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in df.dtypes if kind == "string"]
    return int(df.agg(F.sum(sum(lengths, F.lit(8)))).first()[0] or 0)


def parts_for(df: DataFrame, size: int) -> int:
    """Partitions of about size bytes of files each, and at least twice the shuffle partitions."""
    return max(2 * shuffle_partitions(df.sparkSession), min(1 << 20, -(-file_bytes(df) // size)))


def fresh(taken: list[str], *names: str) -> list[str]:
    """The names, each with as many underscores after it as it takes to differ from all those taken."""
    out, low = [], {t.lower() for t in taken}
    for name in names:
        while name.lower() in low:
            name += "_"
        low.add(name.lower())
        out.append(name)
    return out


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under names of its own; null text becomes empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def whole_ids(rows: DataFrame) -> DataFrame:
    """rows with doc_id as long; ids of a type that isn't a whole number are refused."""
    kind = rows.schema["doc_id"].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"ids must be whole numbers, not {kind.simpleString()}")
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))
