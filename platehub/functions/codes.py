"""Transaction codes and their decode / encode expressions.

All are ``CASE`` chains on JVM-side Column expressions.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Transaction codes of the staged-transaction queue.
ADD_PART = "SN81"
ADD_PART_ARCHIVED = "SN81B"
DELETE_PART = "SN82"
DEMAND_OVERLAY_MARK = "SN89I"
ADD_SHEET = "SN91A"
STOCK_RESET_MARKS = ("SN95", "SN95R")
ADD_REMNANT = "SN97"
PROGRAM_COMPLETE = "SN70"
PROGRAM_UPDATE = "SN76"
FEEDBACK_CREATED = "SN100"
FEEDBACK_DELETED = "SN101"
FEEDBACK_UPDATED = "SN102"
HIGH_HEAT_NUM = "HighHeatNum"

# Feedback code <-> state label.
FEEDBACK_STATES = (
    (FEEDBACK_CREATED, "created"),
    (FEEDBACK_DELETED, "deleted"),
    (FEEDBACK_UPDATED, "updated"),
)

# Retention: codes kept by the purge of each outbox table.
PROGRAM_OUTBOX_KEEP = (FEEDBACK_CREATED, FEEDBACK_DELETED)
PART_OUTBOX_KEEP = (FEEDBACK_CREATED,)


def decode_state(code: Column, strict: bool = False) -> Column:
    """SN100/SN101/SN102 -> created/deleted/updated.  Unknown codes give NULL
    (the procedures' behaviour) or raise in strict mode."""
    expr = None
    for c, label in FEEDBACK_STATES:
        expr = (F.when(code == c, F.lit(label)) if expr is None else expr.when(code == c, F.lit(label)))
    if strict:
        return expr.otherwise(F.raise_error(F.concat(F.lit("unknown TransType: "), F.coalesce(code, F.lit("NULL")))))
    return expr


def status_label(code: Column) -> Column:
    """Program feed status of the retrieval procedure: Created / Deleted."""
    return F.when(code == FEEDBACK_CREATED, "Created").when(code == FEEDBACK_DELETED, "Deleted")


def encode_state(state: Column) -> Column:
    """Inverse of :func:`decode_state`; ``notfound`` has no code (NULL)."""
    expr = None
    for c, label in FEEDBACK_STATES:
        expr = (F.when(state == label, F.lit(c)) if expr is None else expr.when(state == label, F.lit(c)))
    return expr


def sheet_trans_type(sheet_type: Column) -> Column:
    """Remnants are staged as SN97, everything else as SN91A (P10)."""
    return F.when(sheet_type == "Remnant", F.lit(ADD_REMNANT)).otherwise(F.lit(ADD_SHEET))


def batch_type(code: Column) -> Column:
    """Batch file ``remnant`` flag: N -> New, Y -> Remnant; anything else fails."""
    return (
        F.when(code == "N", F.lit("New"))
        .when(code == "Y", F.lit("Remnant"))
        .otherwise(F.raise_error(F.concat(F.lit("unknown batch type: "), F.coalesce(code, F.lit("NULL")))))
    )
