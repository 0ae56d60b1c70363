"""Bill-of-material line classification expressions.

Each rule is a Column expression over the BOM columns
(``type thk wid len spec grade test remark item``); nothing runs in Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import inches_text

# Stock plate thicknesses (inches) and the mill buffer.
STOCK_THICKNESSES = (0.25, 0.375, 0.5, 0.625, 0.75, 0.875, 1.0, 1.125, 1.25, 1.5, 2.0)
MILL_THICKNESS_BUFFER = 0.125
# Grades compatible with stock plate (50 / 50W / 345W with T or T2).
STOCK_GRADE_PATTERN = r"^\w+-(50|345)W?(T|T2)?$"
# Spec rewrites (spec -> (spec, grade)).
SPEC_REWRITES = (
    ("A240 Type 304", "A240", "304"),
    ("A240 Type 316", "A240", "316"),
    ("A606 TYPE 4", "A606", "TYPE4"),
)
PLATE_TYPES = ("PL", "SHT")
CVN_EXEMPT_SPECS = ("A240", "A606")
MAX_STOCK_WIDTH = 95.0
MAX_THIN_LENGTH = 120.0
THIN_LIMIT = 0.375
MAX_STOCK_LENGTH = 240.0


def _rewrite(spec: Column, grade: Column, pick_grade: bool) -> Column:
    expr = None
    for raw, new_spec, new_grade in SPEC_REWRITES:
        val = F.lit(new_grade if pick_grade else new_spec)
        expr = F.when(spec == raw, val) if expr is None else expr.when(spec == raw, val)
    return expr.otherwise(grade if pick_grade else spec)


def norm_spec(spec: Column) -> Column:
    return _rewrite(spec, None, False)


def norm_grade(spec: Column, grade: Column) -> Column:
    return _rewrite(spec, grade, True)


def norm_test(test: Column, remark: Column) -> Column:
    """Impact test after the SRM rule (an SRM remark forces FCM)."""
    return F.when(remark.contains("SRM"), F.lit("FCM")).otherwise(test)


def matl_grade(spec: Column, grade: Column, test: Column, remark: Column) -> Column:
    """``{spec}-{grade}{test}{zone}``: zone '' without a test, 3 for HPS
    grades, else 2; FCM is written F (F6)."""
    s, g, t = norm_spec(spec), norm_grade(spec, grade), norm_test(test, remark)
    has_test = t.isNotNull() & (t != "")
    zone = F.when(~has_test, F.lit("")).when(g.contains("HPS"), F.lit("3")).otherwise(F.lit("2"))
    t_out = F.when(t == "FCM", F.lit("F")).otherwise(F.coalesce(t, F.lit("")))
    return F.concat(s, F.lit("-"), g, t_out, zone)


def matl_grade_cvn(spec: Column, grade: Column, test: Column, remark: Column, literal: bool = False) -> Column:
    """Grade with the default CVN suffix: T3 for HPS grades, else T2, unless
    tested or an exempt spec (F7).  ``literal`` tests the raw spec/test as
    the original did before normalising (D9)."""
    base = matl_grade(spec, grade, test, remark)
    if literal:
        s, t, g = spec, test, grade
    else:
        s, t, g = norm_spec(spec), norm_test(test, remark), norm_grade(spec, grade)
    exempt = (t.isNotNull() & (t != "")) | s.isin(*CVN_EXEMPT_SPECS)
    suffix = F.when(g.contains("HPS"), F.lit("T3")).otherwise(F.lit("T2"))
    return F.when(exempt, base).otherwise(F.concat(base, suffix))


def is_main_item(item: Column) -> Column:
    """Main member when the item code starts with 03 or 04."""
    return item.startswith("03") | item.startswith("04")


def gets_thickness_mill(remark: Column) -> Column:
    """Thickness milling when the remark starts with ``BEV. FILL``."""
    return remark.startswith("BEV. FILL")


def near_stock_thickness(thk: Column) -> Column:
    """Some stock thickness t with 0 < t - thk <= buffer."""
    arr = F.array(*[F.lit(t) for t in STOCK_THICKNESSES])
    return F.exists(arr, lambda t: ((t - thk) > 0) & ((t - thk) <= MILL_THICKNESS_BUFFER))


def is_stock_thickness(thk: Column) -> Column:
    return thk.isin(*STOCK_THICKNESSES)


def for_prenest(
    kind: Column,
    thk: Column,
    wid: Column,
    length: Column,
    spec: Column,
    grade: Column,
    test: Column,
    remark: Column,
    item: Column,
    prenest_type: str = "all",
    skip_stock: bool = True,
) -> Column:
    """Pre-nest eligibility of a BOM line (F8)."""
    main = is_main_item(item)
    if prenest_type == "secondary":
        member_ok = ~main
    elif prenest_type == "main":
        member_ok = main
    else:
        member_ok = F.lit(True)
    base = member_ok & kind.isin(*PLATE_TYPES)
    if skip_stock:
        return base
    grade_ok = matl_grade(spec, grade, test, remark).rlike(STOCK_GRADE_PATTERN)
    oversize = (
        (wid > MAX_STOCK_WIDTH)
        | ((thk <= THIN_LIMIT) & (length > MAX_THIN_LENGTH))
        | (length > MAX_STOCK_LENGTH)
    )
    stock_match = F.when(gets_thickness_mill(remark), near_stock_thickness(thk)).otherwise(is_stock_thickness(thk))
    return base & (~grade_ok | oversize | ~stock_match)


def extended_length_text(length: Column, qty: Column) -> Column:
    """``len * qty`` in feet-inches, the last field of the export row (A10)."""
    return inches_text(length * qty, feet=True)
