"""BOM classification (C17): grade, size labels, pre-nest filter and the
export row, all as Column expressions over a BOM table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bom as B
from ..functions.text import inches_text, size_label
from ..operators.dedup import first_per_key
from ..operators.documents import exact_sum


def _c(name):
    return F.col(name)


def classify_bom(bom: DataFrame, prenest_type: str = "all", skip_stock: bool = True, literal: bool = False) -> DataFrame:
    """One row per BOM line with its classification."""
    spec, grade, test, remark = _c("spec"), _c("grade"), _c("test"), _c("remark")
    return bom.select(
        "job",
        "shipment",
        "mark",
        "qty",
        B.is_main_item(_c("item")).alias("is_main"),
        B.matl_grade(spec, grade, test, remark).alias("matl_grade"),
        B.matl_grade_cvn(spec, grade, test, remark, literal).alias("matl_grade_cvn"),
        size_label(_c("type"), _c("thk"), _c("wid"), _c("len")).alias("size"),
        B.for_prenest(_c("type"), _c("thk"), _c("wid"), _c("len"), spec, grade, test, remark, _c("item"),
                      prenest_type, skip_stock).alias("for_prenest"),
        B.gets_thickness_mill(remark).alias("thk_mill"),
    )


def stock_thickness_match(bom: DataFrame) -> DataFrame:
    """Stock-thickness tests per line."""
    thk, remark = _c("thk"), _c("remark")
    return bom.select(
        "mark",
        "thk",
        B.gets_thickness_mill(remark).alias("thk_mill"),
        B.near_stock_thickness(thk).alias("near_stock"),
        B.is_stock_thickness(thk).alias("is_stock_thk"),
    )


def bom_export(bom: DataFrame, literal: bool = False) -> DataFrame:
    """Export row of 15 positions, five of them empty."""
    spec, grade, test, remark = _c("spec"), _c("grade"), _c("test"), _c("remark")
    dwg = _c("dwg") if "dwg" in bom.columns else F.lit(None).cast("string")
    blanks = [F.lit(None).cast("string").alias(f"blank{i}") for i in range(1, 6)]
    return bom.select(
        "mark",
        "qty",
        "thk",
        "wid",
        "len",
        B.matl_grade_cvn(spec, grade, test, remark, literal).alias("grade"),
        "item",
        dwg.alias("dwg"),
        *blanks,
        "remark",
        B.extended_length_text(_c("len"), _c("qty")).alias("ext_len"),
    )


def bom_length_rollup(bom: DataFrame) -> DataFrame:
    """Total extended length per (job, shipment), exact, in feet-inches (A10)."""
    agg = bom.groupBy("job", "shipment").agg(
        exact_sum(_c("len") * _c("qty")).alias("total_len"), F.count(F.lit(1)).alias("lines")
    )
    return agg.select("job", "shipment", "lines", "total_len", inches_text(_c("total_len"), feet=True).alias("total_text"))


def bom_lookup(bom: DataFrame, job: int, shipment: int, mark: str | None = None) -> DataFrame:
    """BOM lines of one (job, shipment) (S5); with ``mark``, the first line
    whose mark matches case-insensitively, or nothing (P12)."""
    rows = bom.where((_c("job") == job) & (_c("shipment") == shipment))
    if mark is None:
        return rows
    hit = rows.where(F.lower(_c("mark")) == mark.lower())
    return hit.orderBy("mark").limit(1)


BOM_COLLATION = "UTF8_LCASE"


def bom_lookups(bom: DataFrame, requests: DataFrame) -> DataFrame:
    """Many lookups at once (S5, P12): ``requests`` has request, job, shipment, mark.

    With a mark: the first line of the job and shipment whose mark equals it but
    for case, first by the mark's bytes, then by the other columns; nothing if there
    is none.  Without one (NULL): all lines.  One row for each line found, with the
    request's id.  The marks are compared by collation, so they are join keys.
    """
    wanted = requests.select("request", F.col("job").alias("__job"), F.col("shipment").alias("__shipment"), F.col("mark").alias("__mark"))
    place = (_c("job") == _c("__job")) & (_c("shipment") == _c("__shipment"))
    same = F.collate(_c("mark"), BOM_COLLATION) == F.collate(_c("__mark"), BOM_COLLATION)
    hits = bom.join(wanted, place & same).select("request", *bom.columns)
    first = first_per_key(hits, ["request"], ["mark", *[c for c in bom.columns if c != "mark"]])
    lines = bom.join(wanted.where(_c("__mark").isNull()), place).select("request", *bom.columns)
    return first.select("request", *bom.columns).unionByName(lines)
