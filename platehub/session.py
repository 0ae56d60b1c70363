"""SparkSession construction and cluster-facing settings.

Everything here is plain Spark configuration.  The defaults are chosen for a
large cluster (AQE on, skew-join splitting on, partition coalescing on) and are
only narrowed for local tests through arguments.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; each one is a stock Spark option.
SCALE_CONF = {
    # Adaptive execution: re-plans joins from runtime sizes, coalesces small
    # shuffle partitions and splits skewed ones.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128MB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
    # Runtime broadcast only for sides measured below this size.
    "spark.sql.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
    "spark.sql.files.maxPartitionBytes": "256MB",
    # Start wide and let AQE coalesce toward the advisory size: at 100 TB a
    # fixed 200 would give partitions far beyond executor memory, while
    # coalescing makes an over-wide start cheap for small stages.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "4096",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Whether Spark deletes an execution's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Default shuffle width for cluster sessions (stateful streams keep the width
# of their first run, so it is set up front rather than left to AQE).
CLUSTER_SHUFFLE_PARTITIONS = 4096


def build_session(
    master: str | None = None,
    app_name: str = "platehub",
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SCALE_CONF.items():
        builder = builder.config(key, value)
    builder = builder.config(
        "spark.sql.shuffle.partitions", str(shuffle_partitions if shuffle_partitions is not None else CLUSTER_SHUFFLE_PARTITIONS)
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``; a local master without
    it gets a fresh scratch folder, any other is an error: its executors would
    write to disks of their own."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="platehub-ckpt-")
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    spark.sparkContext.setCheckpointDir(conf_dir)
    return conf_dir


def checkpoint_dir(spark: SparkSession) -> str:
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def cut(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: what uses it several
    times computes it once, and a lost executor does not bring back its history."""
    path = os.path.join(checkpoint_dir(df.sparkSession), "platehub", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of what is written in here go when each write ends, not when
    the driver next collects its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextmanager
def cut_once(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """:func:`cut` of a table that is deleted again, and compressed more."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "platehub", f"{name}-{uuid.uuid4().hex[:12]}")
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    try:
        with tidy(spark):
            df.write.option("compression", "zstd").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def local_session(cpus: int | None = None, shuffle_partitions: int = 8) -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=shuffle_partitions,
        extra={"spark.driver.memory": "16g"},
    )
