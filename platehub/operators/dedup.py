"""First / last row per key without a window over the whole group.

``min_by`` / ``max_by`` are partial aggregates: each map task reduces its
share of a key before the shuffle, so a key holding a third of all rows costs
one row per task on the wire, not a third of the table in one sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _order_key(order_cols: list[str]) -> Column:
    """A struct is never NULL, so rows without an order value count too; within
    it NULL comes before every value."""
    return F.struct(*[F.col(c) for c in order_cols])


def pick_per_key(df: DataFrame, keys: list[str], order_cols: list[str], last: bool = False) -> DataFrame:
    """One row per key: the row with the smallest (or largest) order tuple; a
    NULL order value is smaller than any other."""
    value_cols = [c for c in df.columns if c not in keys]
    payload = F.struct(*[F.col(c) for c in value_cols])
    by = F.max_by if last else F.min_by
    agg = df.groupBy(*keys).agg(by(payload, _order_key(order_cols)).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in value_cols])


def first_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    return pick_per_key(df, keys, order_cols, last=False)


def last_per_key(df: DataFrame, keys: list[str], order_cols: list[str]) -> DataFrame:
    return pick_per_key(df, keys, order_cols, last=True)


def survivors_after_later_writes(
    rows: DataFrame,
    writes: DataFrame,
    keys: list[str],
    ord_col: str,
) -> DataFrame:
    """Last-write-wins compaction of a queue.

    A row of ``rows`` survives unless some row of ``writes`` with the same
    non-NULL key has a larger ordinal (a single integer column).  Rows with a
    NULL ordinal are older than every write.  Implemented as: per key, the largest write ordinal
    (partial aggregate) -> left join -> compare.  NULL keys never group.
    """
    not_null = None
    for k in keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else not_null & c
    last_write = (
        writes.where(not_null)
        .groupBy(*keys)
        .agg(F.max(ord_col).alias("__last"))
        .select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__last")
    )
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__k_{k}")
        cond = c if cond is None else cond & c
    joined = rows.join(last_write, cond, "left")
    me = F.col(ord_col)
    keep = F.col("__last").isNull() | (me.isNotNull() & (me >= F.col("__last")))
    return joined.where(keep).drop("__last", *[f"__k_{k}" for k in keys])
