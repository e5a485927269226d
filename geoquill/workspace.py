"""Intermediate tables in the folder that driver and executors share.

A table written here cuts the lineage of what reads it: losing an executor costs
a re-read of Parquet files, not a re-run of the stages before.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: Spark's setting by which a query's shuffle files are removed when it ends; on while a table is written, which cuts the lineage anyway.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; a folder of this machine only where that is unset (tests)."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("geoquill.local.dir", None)
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='geoquill-')}"
        spark.conf.set("geoquill.local.dir", found)
    return found.rstrip("/")


class Workspace:
    """Names written tables of one run and drops those that are no longer read."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def put(self, df: DataFrame, name: str = "t") -> DataFrame:
        """Write df and read it back; the returned frame knows its path for drop(). Shuffle files of the write go with its end."""
        path, conf = self.path(name), self.spark.conf
        before = conf.get(CLEANUP, "false")
        conf.set(CLEANUP, "true")
        try:
            df.write.parquet(path)
        finally:
            conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._workspace_path = path
        return out

    def delete(self, path: str) -> None:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)

    def drop(self, *frames: DataFrame) -> None:
        for f in frames:
            if getattr(f, "_workspace_path", None):
                self.delete(f._workspace_path)
                f._workspace_path = None

    def release(self) -> None:
        """Let Spark's cleaner remove the shuffle files of frames that are no longer referenced."""
        gc.collect()
        self.spark._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
