"""A folder that driver and executors share, tables cut off from their lineage in it, and paths of any file system."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from .errors import TidemarkError

_OWN: dict[str, str] = {}


def _path(spark: SparkSession, sub: str) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise TidemarkError("no_shared_folder", "set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        root = _OWN.setdefault(app, "") or _OWN.update({app: "file://" + tempfile.mkdtemp(prefix="spark-tidemark-")}) or _OWN[app]
    return f"{root.rstrip('/')}/tidemark-{sub}-{uuid.uuid4().hex}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir; only on one machine (tests) it may be unset, then below a temporary folder."""
    path = _path(spark, name)
    atexit.register(remove, spark, path)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """(file system, qualified path) of a path."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(where)


def remove(spark: SparkSession, path: str) -> None:
    """Removes a path, if it and the session are still there."""
    try:
        fs, where = hadoop_path(spark, path)
        fs.delete(where, True)
    except Exception:  # the JVM may be gone at exit; the folder's own cleaner then removes it
        pass


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = hadoop_path(spark, path)
    return fs.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none if it isn't there."""
    fs, where = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def bytes_in(spark: SparkSession, path: str) -> int:
    """Bytes of a file, or of all files below a folder."""
    fs, where = hadoop_path(spark, path)
    return fs.getContentSummary(where).getLength()


def local(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A few rows at hand as a frame of one partition. They are part of the plan, so reading them takes no Python
    worker, and no shuffle where they meet another frame of one partition."""
    fields = StructType.fromDDL(schema)
    plain = [{n: v.asDict() if isinstance(v, Row) else v for n, v in zip(fields.names, r)} for r in rows]
    at_hand = pa.Table.from_pylist(plain, to_arrow_schema(fields))
    return spark.createDataFrame(at_hand, fields).coalesce(1)


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Moves a file to a name that nothing has yet; False if something has it. The file system decides who is first."""
    jvm = spark.sparkContext._jvm
    fs, to = hadoop_path(spark, target)
    fs.mkdirs(to.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(to.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.NONE
    try:
        context.rename(hadoop_path(spark, source)[1], to, how)
        return True
    except Exception as e:
        if "FileAlreadyExistsException" in str(e):
            return False
        raise


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written once in the shared folder and read back."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Staged tables of one run; all are removed when it ends. For use in a with statement."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def staged(self, df: DataFrame, name: str) -> DataFrame:
        self.paths.append(_path(self.spark, name))
        df.write.parquet(self.paths[-1])
        return self.spark.read.schema(df.schema).parquet(self.paths[-1])

    def __enter__(self):
        return self

    def __exit__(self, *_):
        for p in self.paths:
            remove(self.spark, p)
