"""Intermediate tables in the cluster's shared checkpoint folder.

Iterative operators cut their lineage by writing a table and reading it back:
a lost executor then costs one stage, not the whole history.  The folder is
``spark.checkpoint.dir``; only a local master without that setting gets a
temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a fresh folder for a local master without it."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="platehub-llm-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


class Scratch:
    """Tables of one run of an operator, in a folder of their own."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/platehub-llm/{name}-{uuid.uuid4().hex}"
        self._n = 0

    def cut(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write ``df`` and read it back; the new frame has no lineage, and the
        shuffle files of the write go when it ends, not when the driver next
        collects its garbage."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        before = self.spark.conf.get(CLEANUP, "false")
        self.spark.conf.set(CLEANUP, "true")
        try:
            writer.parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables written by :meth:`cut` that nothing reads any more."""
        for df in frames:
            self._delete(df._scratch_path)

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
