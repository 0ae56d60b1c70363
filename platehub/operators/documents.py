"""Nested documents from flat tables.

Children are grouped under their parent key into sorted arrays.  A parent with
more than ``page_size`` children is spread over ``ceil(n / page_size)`` pages by
a hash of the child's id, ``n`` being counted exactly by a partial aggregate, so
no parent gathers an unbounded list in one task.  ``page`` is part of the
document's key; a parent of up to ``page_size`` children has page 0 alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_PAGE_SIZE = 50_000


def child_arrays(
    children: DataFrame,
    keys: list[str],
    fields: list[str],
    name: str,
    page_size: int | None = DEFAULT_PAGE_SIZE,
    child_id: list[str] | None = None,
) -> DataFrame:
    """``keys, page, name: array<struct<fields>>`` sorted by the fields.

    ``child_id``: columns that tell children of one parent apart (default: the
    fields), so that equal children of a large parent are spread as well.
    ``page_size=None`` (for keys known to be small): one page.
    """
    item = F.struct(*[F.col(f) for f in fields])
    page = F.lit(0).cast("long")
    if page_size is not None:
        children = children.join(page_counts(children, keys, page_size), keys, "left")
        page = F.when(F.col("__pages").isNull(), page).otherwise(F.pmod(F.xxhash64(*(child_id or fields)), F.col("__pages")))
    return children.withColumn("page", page).groupBy(*keys, "page").agg(F.array_sort(F.collect_list(item)).alias(name))


def page_counts(children: DataFrame, keys: list[str], page_size: int) -> DataFrame:
    """``keys, __pages`` of the parents that have more than ``page_size`` children."""
    large = children.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > page_size)
    return large.select(*keys, F.ceil(F.col("__n") / F.lit(page_size)).cast("long").alias("__pages"))


def attach_children(
    heads: DataFrame,
    keys: list[str],
    children: list[tuple[DataFrame, list[str], str, list[str]]],
    page_size: int | None = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """Every head with its children: ``<heads>, page, <name1>, <name2>, ...``; each
    child list is (rows, fields, name, id columns).

    The heads go to the children: a head is repeated for each of its pages and
    meets the lists where they were made, dealt out by ``keys`` alone: the page is
    compared, it is no key of the join, and the arrays are not shuffled.  Page
    ``p`` of each list stands beside page ``p`` of the others, so the widest row
    holds about ``page_size`` children of each kind.  Missing lists are empty
    arrays; a head without children has page 0, a paged one the pages that hold any."""
    page = F.lit(0).cast("long")
    j = heads.withColumn("__pages", F.lit(None).cast("long"))
    if page_size is not None:
        counts = [page_counts(df, keys, page_size) for df, _, _, _ in children]
        most = reduce(DataFrame.unionByName, counts).groupBy(*keys).agg(F.max("__pages").alias("__pages"))
        j = heads.join(most, keys, "left")
        page = F.explode(F.sequence(page, F.coalesce(F.col("__pages") - 1, page)))
    j = j.select(*heads.columns, "__pages", page.alias("page"))
    types = {}
    for df, fields, name, child_id in children:
        arr = child_arrays(df, keys, fields, name, page_size, child_id)
        types[name] = arr.schema[name].dataType
        arr = arr.select(*[F.col(k).alias(f"__c_{k}") for k in keys], F.col("page").alias("__c_page"), name)
        same = reduce(Column.__and__, [F.col(k) == F.col(f"__c_{k}") for k in keys], F.col("page").between(F.col("__c_page"), F.col("__c_page")))
        j = j.join(arr, same, "left").drop("__c_page", *[f"__c_{k}" for k in keys])
    held = reduce(Column.__or__, [F.col(n).isNotNull() for n in types], F.col("__pages").isNull())
    return j.where(held).select(*heads.columns, "page", *[F.coalesce(F.col(n), F.array().cast(t)).alias(n) for n, t in types.items()])


def child_summary(children: DataFrame, keys: list[str], prefix: str, sums: list[str], names: str | None = None,
                  int_sums: list[str] | None = None) -> DataFrame:
    """Order-independent summary of each parent's children: count, exact
    sums (decimal, so summation order cannot change the value), integer
    sums and the min / max of a name column.  All partial aggregates:
    skew-safe."""
    aggs = [F.count(F.lit(1)).alias(f"{prefix}_n")]
    for s in sums:
        aggs.append(exact_sum(F.col(s)).alias(f"{prefix}_{s}"))
    for s in int_sums or []:
        aggs.append(F.sum(F.col(s).cast("long")).alias(f"{prefix}_{s}"))
    if names:
        aggs += [F.min(names).alias(f"{prefix}_min_{names}"), F.max(names).alias(f"{prefix}_max_{names}")]
    return children.groupBy(*keys).agg(*aggs)


def exact_sum(col):
    """Sum of a double column rounded to 4 decimals, summed exactly as a
    decimal and returned as a double (identical in any summation order)."""
    return F.sum(col.cast("decimal(20,4)")).cast("double")
