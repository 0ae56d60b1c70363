"""Spreadsheet demand export (S4): the sheet saved as CSV, five columns
(event id, part, qty, an unused column, shipment); numbers arrive as floats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SHEET_SCHEMA = "event_id string, part string, qty double, unused string, shipment double"


def read_spreadsheet_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHEET_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)
