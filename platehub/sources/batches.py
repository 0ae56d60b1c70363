"""Batch file source (S1, S2): a typed CSV read that fails on any bad row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes

# ids keep their leading zeros, so every column is read as text
BATCH_SCHEMA = "id string, mm string, sheet_name string, remnant string"


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """``id, mm, sheet_name, type``: header row, explicit schema, FAILFAST on
    malformed rows, and an unknown Y/N flag raises when evaluated."""
    raw = (
        spark.read.schema(BATCH_SCHEMA)
        .option("header", True)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .csv(path)
    )
    typed = raw.select("id", "mm", "sheet_name", codes.batch_type(F.col("remnant")).alias("type"))
    # a filter keeps the decode (and its failure on unknown codes) even when a
    # caller does not select ``type``; it never drops a row
    return typed.where(F.col("type").isNotNull())


def cached_batches(spark: SparkSession, path: str, view: str = "batches") -> DataFrame:
    """Load once and reuse across requests (S2): cached temp view."""
    df = read_batches(spark, path).cache()
    df.createOrReplaceTempView(view)
    return df


def read_batch_dimensions(spark: SparkSession, path: str) -> DataFrame:
    """Odd-batch sheet: width / length overrides kept as text and cast with
    ``try_cast`` so a value such as ``x`` gives NULL and the row is kept."""
    raw = (
        spark.read.schema("batch string, sheet_name string, batch_level string, width string, length string")
        .option("header", True)
        .csv(path)
    )
    return raw.select(
        "batch",
        "sheet_name",
        (F.col("batch_level") == "Y").alias("batch_level"),
        F.col("width").try_cast("double").alias("width"),
        F.col("length").try_cast("double").alias("length"),
    )
