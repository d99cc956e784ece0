"""Tables written between the jobs of an iterative or multi-pass operator.

A staged table cuts lineage, survives the loss of an executor (it lies in the folder that all
executors share) and tells the planner its true size, so that Catalyst broadcasts it only where
``spark.sql.autoBroadcastJoinThreshold`` allows.
"""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SHARED = "spark.checkpoint.dir"
_local_root: str | None = None
_written: list[Staged] = []


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by the session, or, in local mode only, a temporary one."""
    given = spark.conf.get(SHARED, None)
    if given:
        return given.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SHARED} to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="lexloom-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return f"file://{_local_root}"


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet."""
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


class Staged:
    """A written table: ``df`` reads it, ``bytes`` and ``rows`` are exact, ``drop()`` removes it."""

    def __init__(self, df: DataFrame, name: str):
        spark = df.sparkSession
        self._spark = spark
        self.path = new_folder(spark, name)
        df.write.parquet(self.path)
        self.df = spark.read.schema(df.schema).parquet(self.path)
        _written.append(self)

    def _fs(self):
        jvm = self._spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(self._spark.sparkContext._jsc.hadoopConfiguration())

    @property
    def bytes(self) -> int:
        path, fs = self._fs()
        return fs.getContentSummary(path).getLength()

    @property
    def rows(self) -> int:
        return self.df.count()

    def drop(self) -> None:
        path, fs = self._fs()
        fs.delete(path, True)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back."""
    return Staged(df, name).df


def sweep(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished writes now; else they stay until the driver happens to collect garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def release() -> int:
    """Remove all tables staged so far; to be called once the results that read them are written. Returns their number."""
    n = len(_written)
    while _written:
        _written.pop().drop()
    return n
