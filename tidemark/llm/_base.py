"""Shared helpers: reading tables, cutting lineage in the shared folder, size-checked broadcasts."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that a Python worker gets at once, at most.
BATCH_ROWS, BATCH_BYTES = 2_000, 16 << 20
#: Most rows that a side may have to be broadcast; a larger side is joined by shuffle.
BROADCAST_ROWS = 200_000

_FALLBACK: dict[str, str] = {}
_KEPT: dict = {}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; only where it is unset on one machine (tests) a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _FALLBACK:
        _FALLBACK[app] = "file://" + tempfile.mkdtemp(prefix="spark-tidemark-")
    return _FALLBACK[app]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the JVM may be gone at exit; the folder's own cleaner then removes it
        pass


def cut(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most `rows` rows (counted, at most rows + 1 of them), else df."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded_batches(df: DataFrame) -> DataFrame:
    """df, whose session hands Python workers at most so many rows and bytes at once from now on: long texts would make
    larger batches heavy. The session's settings are only ever lowered."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return df


def kept(key, make):
    """What a Python worker remembers under that key from task to task; it holds one such thing at a time, so that
    the stages of a job, which share their workers, don't add up."""
    if key not in _KEPT:
        _KEPT.clear()
        free_memory()
        _KEPT[key] = make()
    return _KEPT[key]


def free_memory() -> None:
    """Gives memory that this Python worker no longer uses back to the system."""
    import ctypes

    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    if hasattr(trim := ctypes.CDLL(None), "malloc_trim"):
        trim.malloc_trim(0)


def ascii_lower(col):
    """Lower-cases A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def is_held_out(doc_id):
    """Rows that no classifier may learn from: crc32(doc_id as text) mod 5 = 0."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
