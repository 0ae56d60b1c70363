"""Audits: constraint audit from the DDL (C18), id headroom (F18), table
snapshots (K1) and the P7 / P8 / P11 data-quality projections."""

from __future__ import annotations

import datetime as _dt
import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import split_required

INT_MAX = 2_147_483_647


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (PK check): partial count aggregate."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def orphans(child: DataFrame, child_keys: list[str], parent: DataFrame, parent_keys: list[str]) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (FK check)."""
    p = parent.select(*[F.col(k).alias(f"__p{i}") for i, k in enumerate(parent_keys)])
    cond = None
    for i, k in enumerate(child_keys):
        c = F.col(k) == F.col(f"__p{i}")
        cond = c if cond is None else cond & c
    not_null = None
    for k in child_keys:
        c = F.col(k).isNotNull()
        not_null = c if not_null is None else not_null & c
    return child.where(not_null).join(p, cond, "left_anti")


def constraint_audit(checks: list[tuple]) -> DataFrame:
    """Run PK / FK / NOT NULL checks and return one row per check:
    ``table_name, constraint_name, kind, violations``.

    ``checks`` items: ``("pk", table, df, keys)``,
    ``("fk", table, df, keys, parent_df, parent_keys)`` or
    ``("not_null", table, df, cols)``.  Violations are rows beyond the first of a
    key (PK; NULL keys are equal), rows without a parent (FK; a NULL in the key is
    none), and rows with a NULL (NOT NULL).

    Each table is scanned once: a row gives an entry for each check that it takes
    part in, as child or as parent, and one aggregate by check and key serves all
    of them.
    """
    spark = checks[0][2].sparkSession
    meta, tables = [], {}

    def entry(df: DataFrame, number: int, keys: list[Column], when: Column, child: int, parent: int) -> None:
        e = F.struct(F.lit(number).alias("check"), F.array(*[k.cast("string") for k in keys]).alias("key"), F.lit(child).alias("child"), F.lit(parent).alias("parent"))
        tables.setdefault(df.semanticHash(), (df, []))[1].append(F.when(when, e))

    for number, (kind, table, df, cols, *parent) in enumerate(checks):
        meta.append((number, table, f"{kind}({','.join(cols)})", kind))
        own = [F.col(c) for c in cols]
        whole = reduce(lambda x, y: x & y, [c.isNotNull() for c in own])
        if kind == "pk":
            entry(df, number, own, F.lit(True), 1, 0)
        elif kind == "not_null":
            entry(df, number, [F.lit("")], ~whole, 1, 0)
        elif kind == "fk":
            rows, keys = parent
            types = dict(rows.dtypes)
            entry(df, number, [c.cast(types[k]) for c, k in zip(own, keys)], whole, 1, 0)
            entry(rows, number, [F.col(k) for k in keys], F.lit(True), 0, 1)
        else:
            raise ValueError(kind)
    entries = None
    for df, parts in tables.values():
        rows = df.select(F.explode(F.array(*parts)).alias("e")).where("e is not null").select("e.*")
        entries = rows if entries is None else entries.unionByName(rows)
    # Dealt out by key first: nearly every key differs, so that to add up in the
    # tasks that scan would hold the keys of a whole stretch of a table.
    entries = entries.repartition("check", "key")
    keys = entries.groupBy("check", "key").agg(F.sum("child").alias("children"), F.max("parent").alias("parent"))
    about = F.broadcast(spark.createDataFrame(meta, "check int, table_name string, constraint_name string, kind string"))  # one row a check
    bad = F.when(F.col("kind") == "pk", F.col("children") - 1).when(F.col("kind") == "fk", F.when(F.col("parent") == 0, F.col("children")).otherwise(0)).otherwise(F.col("children"))
    found = keys.join(about.select("check", "kind"), "check").groupBy("check").agg(F.sum(bad).alias("v"))
    return about.join(found, "check", "left").select("table_name", "constraint_name", "kind", F.coalesce(F.col("v"), F.lit(0)).cast("long").alias("violations"))


def id_headroom(df: DataFrame, id_col: str, ts_col: str) -> DataFrame:
    """How long an INT id column lasts at the observed rate (F18, re-aimed):
    ``max_id, ids_per_day, days_left, years_left``.  One aggregation chain:
    per-day counts and maxima (partial aggregate), then one row."""
    per_day = df.groupBy(F.to_date(F.col(ts_col)).alias("d")).agg(
        F.count(F.lit(1)).alias("n"), F.max(id_col).alias("m")
    )
    j = per_day.agg(
        F.max("m").cast("long").alias("max_id"),
        (F.sum("n") / F.count(F.lit(1))).cast("long").alias("ids_per_day"),
    )
    left = F.lit(INT_MAX) - F.col("max_id")
    days = F.when(F.col("ids_per_day") > 0, F.floor(left / F.col("ids_per_day")).cast("long"))
    return j.select("max_id", "ids_per_day", days.alias("days_left"), F.floor(days / 365).cast("long").alias("years_left"))


def id_budget(years: list[int]) -> list[tuple[int, int, int, int]]:
    """Per-day / per-week / per-year id budget for a horizon (scalar helper)."""
    return [(y, INT_MAX // (365 * y), INT_MAX // (52 * y), INT_MAX // y) for y in years]


def required_quarantine(df: DataFrame, key: str, required: list[str]) -> DataFrame:
    """Rows missing a required field, with the missing names."""
    _, bad = split_required(df, required)
    return bad.select(key, "missing")


def snapshot_tables(tables: dict[str, DataFrame], root: str, ts: _dt.datetime | None = None) -> str:
    """Dump several tables to JSON under one timestamped folder (K1).

    Each table is written by the executors (``df.write.json``); nothing is
    collected.  Non-JSON values (timestamps, decimals) are written as text
    by the JSON writer.  Returns the snapshot folder."""
    ts = ts or _dt.datetime.now(_dt.timezone.utc)
    folder = os.path.join(root, "snapshot_ts=" + ts.strftime("%Y%m%d_%H%M%S"))
    for name, df in tables.items():
        # overwrite: a retried snapshot job writes the same folder again
        df.write.mode("overwrite").json(os.path.join(folder, f"table={name}"))
    return folder


def read_snapshot(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.json(os.path.join(folder, f"table={name}"))


def diff_snapshots(spark: SparkSession, before: str, after: str, name: str, keys: list[str],
                   schema: str | None = None) -> DataFrame:
    """J16 between two K1 snapshots of one table: ``keys, status, values``.
    Pass the table's DDL ``schema`` to skip JSON schema inference."""
    from ..operators.changelog import snapshot_diff

    def load(folder):
        r = spark.read
        if schema:
            r = r.schema(schema)
        return r.json(os.path.join(folder, f"table={name}"))

    old, new = load(before), load(after)
    return snapshot_diff(old, new, keys, [c for c in new.columns if c not in keys])
