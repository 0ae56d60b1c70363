"""The staged-transaction queue (TransAct) as an append-only table.

Parquet has no MERGE/DELETE, so a reconciliation produces the next queue
version: pre-existing rows plus new rows, minus rows superseded by a later
add (last-write-wins on a key).  Every row carries ``Ordinal``: NULL for
rows that existed before the batch, ``2*seq`` for a call's removals and
``2*seq+1`` for its add, so "later" is a single integer comparison.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import survivors_after_later_writes
from ..operators.joins import bounded_broadcast

# Full column set of the queue rows we stage (names as in the queue table).
QUEUE_COLUMNS: dict[str, str] = {
    "TransType": "string",
    "District": "int",
    "TransID": "string",
    "OrderNo": "string",
    "ItemName": "string",
    "Qty": "int",
    "Material": "string",
    "Thickness": "double",
    "Width": "double",
    "Length": "double",
    "PrimeCode": "string",
    "BinNumber": "string",
    "FileName": "string",
    "Customer": "string",
    "DwgNumber": "string",
    "Remark": "string",
    "ItemData1": "string",
    "ItemData2": "string",
    "ItemData3": "string",
    "ItemData4": "string",
    "ItemData5": "string",
    "ItemData6": "string",
    "ItemData7": "string",
    "ItemData8": "string",
    "ItemData9": "string",
    "ItemData10": "string",
    "ItemData14": "string",
    "ItemData18": "string",
    "ProgramName": "string",
    "ProgramRepeat": "long",
    "Ordinal": "long",
}

CONFIG_MAX_ROWS = 10_000


def conform(df: DataFrame) -> DataFrame:
    """Project onto the queue schema; absent columns become typed NULLs and
    only columns of another type are cast."""
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    cols = []
    for c, t in QUEUE_COLUMNS.items():
        if c not in have:
            cols.append(F.lit(None).cast(t).alias(c))
        elif have[c] == {"long": "bigint"}.get(t, t):
            cols.append(F.col(c))
        else:
            cols.append(F.col(c).cast(t).alias(c))
    return df.select(*cols)


def district_by_system(config: DataFrame) -> DataFrame:
    """``TOP 1 SimTransDistrict WHERE SapSystem = ?`` for every system at once
    (L1, D5: the smallest district if a system had several rows).  The
    result is one row per ERP system; it is broadcast after a row count."""
    cfg = config.groupBy("SapSystem").agg(
        F.min_by(F.struct("SimTransDistrict", "RemnantDxfTemplate"), "SimTransDistrict").alias("c")
    ).select(
        F.col("SapSystem").alias("cfg_system"),
        F.col("c.SimTransDistrict").alias("cfg_district"),
        F.col("c.RemnantDxfTemplate").alias("cfg_template"),
    )
    return bounded_broadcast(cfg, CONFIG_MAX_ROWS)


def with_column_defaults(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    """Add absent optional call parameters as typed NULL columns."""
    for c, t in cols.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast(t))
    return df


def compact(existing: DataFrame, new_rows: DataFrame, adds: DataFrame, keys: list[str]) -> DataFrame:
    """Next queue version: ``existing`` rows (already in the queue before the
    batch) plus ``new_rows`` (removals and adds of the batch), minus rows
    superseded by a later add with the same non-NULL key.  Existing rows are
    older than every add of the batch whatever their stored ordinal, so
    replaying a batch against its own output gives the same queue."""
    rows = existing.withColumn("__cmp", F.lit(None).cast("long")).unionByName(
        new_rows.withColumn("__cmp", F.col("Ordinal"))
    )
    writes = adds.withColumn("__cmp", F.col("Ordinal"))
    return survivors_after_later_writes(rows, writes, keys, "__cmp").drop("__cmp")
