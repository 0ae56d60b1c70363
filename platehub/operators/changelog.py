"""Mutable-table operators on append-only data (no MERGE on parquet):
outbox ack (J15), retention purge (U2), snapshot diff (J16), feedback entry
equality (J17) and full overlay with marker rows (K5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ack(outbox: DataFrame, acked: DataFrame, id_col: str = "AutoID") -> DataFrame:
    """Remove consumed outbox rows by id: a left-anti join."""
    ids = acked.select(F.col(id_col).alias("__ack")).where(F.col("__ack").isNotNull())
    return outbox.join(ids, F.col(id_col) == F.col("__ack"), "left_anti")


def purge_keep(df: DataFrame, code_col: str, keep: tuple[str, ...]) -> DataFrame:
    """``DELETE ... WHERE code NOT IN (keep)``: rows with a NULL code are kept
    because the predicate is unknown for them (U2)."""
    return df.where(F.col(code_col).isNull() | F.col(code_col).isin(*keep))


def purged(df: DataFrame, code_col: str, keep: tuple[str, ...]) -> DataFrame:
    """The complement of :func:`purge_keep` (rows the purge deletes)."""
    return df.where(F.col(code_col).isNotNull() & ~F.col(code_col).isin(*keep))


def snapshot_diff(old: DataFrame, new: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """Per key: ``same``, ``add``, ``delete`` or ``change``.

    Full outer join on the key; values compared NULL-safely.  Output: keys,
    ``status`` and the new values (NULL for deletes).
    """
    values = values or [c for c in new.columns if c not in keys]
    o = old.select(*[F.col(k).alias(f"__ok_{k}") for k in keys], *[F.col(v).alias(f"__o_{v}") for v in values],
                   F.lit(True).alias("__in_old"))
    n = new.select(*[F.col(k).alias(f"__nk_{k}") for k in keys], *[F.col(v).alias(f"__n_{v}") for v in values],
                   F.lit(True).alias("__in_new"))
    cond = None
    for k in keys:
        c = F.col(f"__ok_{k}").eqNullSafe(F.col(f"__nk_{k}"))
        cond = c if cond is None else cond & c
    j = o.join(n, cond, "full_outer")
    same = F.lit(True)
    for v in values:
        same = same & F.col(f"__o_{v}").eqNullSafe(F.col(f"__n_{v}"))
    status = (
        F.when(F.col("__in_old").isNull(), F.lit("add"))
        .when(F.col("__in_new").isNull(), F.lit("delete"))
        .when(same, F.lit("same"))
        .otherwise(F.lit("change"))
    )
    return j.select(
        *[F.coalesce(F.col(f"__nk_{k}"), F.col(f"__ok_{k}")).alias(k) for k in keys],
        status.alias("status"),
        *[F.col(f"__n_{v}").alias(v) for v in values],
    )


def apply_diff(old: DataFrame, diff: DataFrame, keys: list[str]) -> DataFrame:
    """Inverse check of :func:`snapshot_diff`: old + diff -> new."""
    values = [c for c in diff.columns if c not in keys and c != "status"]
    kept = old.join(diff.where(F.col("status").isin("delete", "change")).select(*keys), keys, "left_anti")
    upserts = diff.where(F.col("status").isin("add", "change")).select(*keys, *values)
    return kept.select(*keys, *values).unionByName(upserts)


def dedupe_feedback(df: DataFrame, id_col: str = "ArchivePacketID", state_col: str = "state") -> DataFrame:
    """Feedback entries are equal on (packet id, state tag) whatever the
    payload (J17); keep one entry per class."""
    return df.dropDuplicates([id_col, state_col])


def match_feedback(a: DataFrame, b: DataFrame, id_col: str = "ArchivePacketID", state_col: str = "state") -> DataFrame:
    """Entries of ``a`` that have an equal entry in ``b`` (left-semi)."""
    return a.join(b.select(id_col, state_col), [id_col, state_col], "left_semi")


def overlay(markers: DataFrame | None, reload: DataFrame, ord_col: str = "ordinal") -> DataFrame:
    """Full overlay (K5): reset marker rows first, then the whole reloaded
    table; attributes absent from the feed are not carried over."""
    if markers is None:
        return reload
    return markers.unionByName(reload, allowMissingColumns=True)
