"""``row_number()`` within a key that stays parallel when one key is huge.

A plain window ``partitionBy(key)`` puts every row of a key into one task.  A
key of more than ``max_rows_per_task`` rows is cut into ranges at approximate
quantiles of its order values, so ranges are even however skewed the values
are; each range is numbered by its own task and shifted by the row count of the
ranges before it.  NULL order values come first, as in the plain window, and
NULL keys are a key like any other.  Both ways give the same numbers whenever
the order column is unique within the key.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS_PER_TASK = 2_000_000


def row_number_within(
    df: DataFrame,
    keys: list[str],
    order: str,
    out: str = "rn",
    max_rows_per_task: int = DEFAULT_MAX_ROWS_PER_TASK,
) -> DataFrame:
    """``row_number()`` over ``partitionBy(keys).orderBy(order)``, split for hot keys."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    largest = counts.agg(F.max("__n")).first()[0] or 0
    if largest <= max_rows_per_task:
        return df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(order)))

    ranges = min(10_000, 2 * math.ceil(largest / max_rows_per_task))
    # One row per hot key: at most total rows / max_rows_per_task of them.
    cuts = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.percentile_approx(order, [k / ranges for k in range(1, ranges)]).alias("__cuts"))
        .where(F.col("__n") > max_rows_per_task).select(*[F.col(k).alias(f"__k_{k}") for k in keys], "__cuts")
    )
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    above = F.coalesce(F.size(F.filter("__cuts", lambda c: c < F.col(order))), F.lit(0))
    piece = F.when(F.col("__cuts").isNull(), F.lit(0)).when(F.col(order).isNull(), F.lit(-1)).otherwise(above)
    tagged = df.join(cuts, same, "left").withColumn("__piece", piece).select(*df.columns, "__piece")
    local = tagged.withColumn("__local", F.row_number().over(Window.partitionBy(*keys, "__piece").orderBy(order)))
    before = Window.partitionBy(*keys).orderBy("__piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        tagged.groupBy(*keys, "__piece").agg(F.count(F.lit(1)).alias("__c"))
        .withColumn("__off", F.coalesce(F.sum("__c").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"__o_{k}") for k in keys], F.col("__piece").alias("__o_piece"), "__off")
    )
    own = F.col("__piece") == F.col("__o_piece")
    for k in keys:
        own = own & F.col(k).eqNullSafe(F.col(f"__o_{k}"))
    return local.join(offsets, own).select(*df.columns, (F.col("__local") + F.col("__off")).cast("int").alias(out))
