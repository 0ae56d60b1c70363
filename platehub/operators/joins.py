"""Join helpers: size-checked broadcast and a scalable literal ``NOT IN``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A side is broadcast only when it is proven to hold at most this many rows.
DEFAULT_BROADCAST_ROWS = 100_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows (a bounded job); above the
    bound the plain DataFrame is returned and the join falls back to a
    shuffle join (AQE may still convert it from measured stage sizes).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def has_null(df: DataFrame, col: str) -> bool:
    """True when ``col`` holds a NULL (bounded: stops at the first one)."""
    return df.where(F.col(col).isNull()).limit(1).count() > 0


def is_empty(df: DataFrame) -> bool:
    return df.limit(1).count() == 0


def not_in(left: DataFrame, left_key: str, right: DataFrame, right_key: str) -> DataFrame:
    """Rows of ``left`` where ``left_key NOT IN (SELECT right_key FROM right)``
    with SQL's three-valued logic, without a null-aware broadcast.

    * right empty            -> every left row (even NULL keys)
    * right holds a NULL     -> no left row
    * otherwise              -> non-NULL left keys absent from right (anti join)

    The two probes are bounded single-row jobs; the anti join shuffles on
    the key so neither side has to fit in memory.
    """
    if is_empty(right):
        return left
    if has_null(right, right_key):
        return left.limit(0)
    keys = right.select(F.col(right_key).alias("__nk")).where(F.col("__nk").isNotNull())
    return left.where(F.col(left_key).isNotNull()).join(
        keys, F.col(left_key) == F.col("__nk"), "left_anti"
    )


def not_exists(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Correlated ``NOT EXISTS`` on equality pairs: a left-anti join.  NULL
    keys never match, so such left rows are kept."""
    cond: Column | None = None
    r = right.select(*[F.col(rc).alias(f"__r_{i}") for i, (_, rc) in enumerate(on)])
    for i, (lc, _) in enumerate(on):
        c = F.col(lc) == F.col(f"__r_{i}")
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left_anti")
