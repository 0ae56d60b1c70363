"""Versions of several tables that change together (K1, K5).

A version's tables are written first, each to a folder of its own, and a manifest
that names their paths last, as one file.  Readers ask the newest manifest, so they
see all tables of a version or none: a publisher that dies midway leaves the version
before in force, and its folders are overwritten by the next attempt.  Tables that
a version leaves out keep the paths of the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, table_name string, path string"


def _manifests(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")


def _started(spark: SparkSession, root: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest")
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def current_version(spark: SparkSession, root: str) -> int | None:
    """The newest version, or None before the first."""
    return _manifests(spark, root).agg(F.max("version")).first()[0] if _started(spark, root) else None


def paths_of(spark: SparkSession, root: str, version: int) -> dict[str, str]:
    """Paths of a version's tables; a manifest has one row for each table."""
    return {r["table_name"]: r["path"] for r in _manifests(spark, root).where(F.col("version") == version).collect()}


def publish(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> int:
    """Write the tables as the next version and put it in force; its number."""
    before = current_version(spark, root)
    version = 0 if before is None else before + 1
    paths = {} if before is None else paths_of(spark, root, before)
    for name, rows in tables.items():
        paths[name] = f"{root}/data/version={version}/{name}"
        rows.write.mode("overwrite").parquet(paths[name])
    manifest = spark.createDataFrame([(version, name, path) for name, path in sorted(paths.items())], MANIFEST)
    manifest.coalesce(1).write.mode("append").parquet(f"{root}/manifest")
    return version


def read(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame:
    """A table of a version (default: the newest); an unknown one is an error."""
    version = current_version(spark, root) if version is None else version
    paths = {} if version is None else paths_of(spark, root, version)
    if name not in paths:
        raise KeyError(f"version {version} has no table {name!r}")
    return spark.read.parquet(paths[name])
