"""String / number formatting expressions.

Each function maps Columns to a Column built from ``pyspark.sql.functions``
only, so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: main-member piece mark pattern, anchored at the start only.
MAIN_MEMBER_PATTERN = r"^\d{7}[A-Z]-[FTB]?G\d+[A-Z]-[A-Z]\d"


def trans_id(event_id: Column) -> Column:
    """Diagnostic transaction id: the last 10 characters of the event id (F1)."""
    return F.right(event_id, F.lit(10))


def derive_mark(mark: Column, part_name: Column, job: Column) -> Column:
    """Mark = part name with every ``<job>-`` removed, only where mark is NULL.
    A NULL job concatenates as '' (so every '-' is removed) (F2)."""
    needle = F.concat(F.coalesce(job, F.lit("")), F.lit("-"))
    return F.coalesce(mark, F.replace(part_name, needle, F.lit("")))


def fill_template(template: Column, sheet_name: Column) -> Column:
    """``<sheet_name>`` placeholder substitution."""
    return F.replace(template, F.lit("<sheet_name>"), sheet_name)


def job_of(part: Column) -> Column:
    """Text before the first '-' (F4)."""
    return F.substring_index(part, "-", 1)


def first_dash_to_underscore(part: Column) -> Column:
    """Replace only the first '-' by '_' (F4)."""
    return F.regexp_replace(part, r"^([^-]*)-", "$1_")


def is_main_member(part: Column) -> Column:
    """Main-member test on a piece mark."""
    return part.rlike(MAIN_MEMBER_PATTERN)


def _whole_and_frac(x: Column, force_zero: bool | Column) -> Column:
    """``<whole> <num>/<den>`` with the fraction reduced in 64ths, '' parts
    dropped.  The whole part truncates like ``int()``."""
    whole = x.cast("long")
    n64 = F.round((x - F.floor(x)) * 64).cast("long")
    # largest power of two dividing n64 (n64 & -n64) reduces n64/64
    low = n64.bitwiseAND(-n64)
    frac = F.when(n64 % 64 == 0, F.lit("")).otherwise(
        F.concat((n64 / low).cast("long").cast("string"), F.lit("/"), (F.lit(64) / low).cast("long").cast("string"))
    )
    carry = F.when(n64 == 64, F.lit(1)).otherwise(F.lit(0))
    whole = whole + carry
    fz = force_zero if isinstance(force_zero, Column) else F.lit(bool(force_zero))
    whole_txt = F.when((whole == 0) & ~fz, F.lit("")).otherwise(whole.cast("string"))
    return F.trim(F.concat(whole_txt, F.lit(" "), frac))


def inches_text(x: Column, feet: bool = False) -> Column:
    """Inches as a mixed fraction; with ``feet`` values >= 12 are shown as
    ``<ft>'-<in>`` (F12).  Fractions are rounded to 1/64."""
    plain = _whole_and_frac(x, False)
    if not feet:
        return plain
    rounded = F.round(x * 64) / 64  # before the feet are taken off, so that no 12" is left
    ft = F.floor(rounded / 12).cast("long")
    rest = rounded - ft * 12
    with_feet = F.concat(ft.cast("string"), F.lit("'-"), _whole_and_frac(rest, True))
    return F.when(rounded >= 12.0, with_feet).otherwise(plain)


def size_label(kind: Column, thk: Column, wid: Column, length: Column) -> Column:
    """``TYPE thk x wid x len`` with the length in feet-inches."""
    return F.concat_ws(
        " ",
        kind,
        inches_text(thk),
        F.lit("x"),
        inches_text(wid),
        F.lit("x"),
        inches_text(length, feet=True),
    )


def runtime_text(seconds: Column) -> Column:
    """``h:m:s`` without padding; seconds are rounded, so 60 can appear."""
    h = F.floor(seconds / 3600).cast("long")
    m = (F.floor(seconds / 60) % 60).cast("long")
    s = F.round(seconds % 60).cast("long")
    return F.concat_ws(":", h.cast("string"), m.cast("string"), s.cast("string"))


def skeleton_area(nested_area: Column, true_area: Column) -> Column:
    """Plate area not used by the part (F16)."""
    return nested_area - true_area


def shipment_int(data2: Column) -> Column:
    """Shipment text to int: '' / NULL -> 0, non-numeric -> NULL."""
    t = F.trim(data2)
    return F.when(data2.isNull() | (t == ""), F.lit(0)).otherwise(t.try_cast("int"))
