"""Demand (C1) and inventory (C2) reconciliation as set-based plans.

The original runs a stored procedure once per ERP call; each call may stage
pre-emptive removals (first call of an event only), then deletes staged rows
it supersedes and stages its add.  Over a batch of calls ordered by ``seq``
the same result is:

1. first call per event (gate, W1) -- a partial ``min_by`` aggregate;
2. removals of the gated first calls, ordinal ``2*seq``;
3. adds of calls with a positive net quantity, ordinal ``2*seq+1``;
4. queue = pre-existing rows + removals + adds, minus every row that has a
   later add on the same non-NULL key (W2 for demand: work order, part,
   event; W3 for inventory: sheet name alone).

``literal=True`` reproduces the original's NULL behaviour (D1 NULL netting,
D2 ``NOT IN`` gate closed by NULL TransIDs, D3 gate on the 10-char id).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import derive_mark, fill_template, trans_id
from ..operators.dedup import first_per_key
from ..operators.joins import has_null
from ..session import cut
from .queue import compact, conform, district_by_system, with_column_defaults

DEMAND_OPTIONAL = {
    "matl": "string", "state": "string", "dwg": "string", "codegen": "string", "shipment": "string",
    "chargeref": "string", "op1": "string", "op2": "string", "op3": "string", "mark": "string",
    "raw_mm": "string",
}
INVENTORY_OPTIONAL = {
    "matl": "string", "thk": "double", "wid": "double", "len": "double",
    "notes1": "string", "notes2": "string", "notes3": "string", "notes4": "string",
}


def first_calls(calls: DataFrame, key: str) -> DataFrame:
    """The first call (lowest ``seq``) of each event; calls without one are left out."""
    return first_per_key(calls.where(F.col(key).isNotNull()), [key], ["seq"])


def _gate(calls: DataFrame, trans_act: DataFrame, adds: DataFrame, literal: bool, event_col: str, name_col: str) -> DataFrame:
    """First calls whose event passes the once-per-event gate (J9, W1, T3), with
    what their removals need: ``name_col`` is what they are looked up by.  The first
    calls are sorted for, so the other columns are left out before.

    Intended (D3): the event is not in the queue, by its whole id, which staged
    rows carry in ``ItemData18`` or ``event_col``.  ``literal``: by the last ten characters, with
    the NULLs of SQL's ``NOT IN``.
    """
    calls = calls.select("seq", "sap_event_id", "trans_id", "sap_system", name_col)
    if not literal:
        # One column of the queue at a time, so that a scan reads nothing else.  An event
        # has many rows there: each task sends it once.  The ids grow with the queue and
        # their files say little of their size, so they are never hashed whole.
        firsts, queue = first_calls(calls, "sap_event_id"), conform(trans_act)
        for column in dict.fromkeys(["ItemData18", event_col]):
            known = queue.select(F.col(column).alias("__event")).where(F.col("__event").isNotNull()).distinct()
            firsts = firsts.join(known.hint("merge"), F.col("sap_event_id") == F.col("__event"), "left_anti")
        return firsts
    firsts = first_calls(calls, "trans_id")
    staged = trans_act.select(F.col("TransID").alias("__tid"))
    # NOT IN: one NULL TransID in the queue closes every gate.
    if has_null(staged, "__tid"):
        return firsts.limit(0)
    # An add from a call with a NULL event id stages a NULL TransID, which
    # closes the gate for every later first call (bounded probe first).
    if has_null(calls, "sap_event_id"):
        first_null = adds.where(F.col("ItemData18").isNull()).agg(F.min("Ordinal")).first()[0]
        if first_null is not None:
            firsts = firsts.where(F.col("seq") * 2 < F.lit(first_null))
    return firsts.join(staged, F.col("trans_id") == F.col("__tid"), "left_anti")


def unknown_system_calls(calls: DataFrame, config: DataFrame) -> DataFrame:
    """Quarantine (D10): calls whose ERP system has no config row; they stage
    and remove nothing."""
    return calls.join(config.select(F.col("SapSystem").alias("sap_system")), "sap_system", "left_anti")


def _prepare_calls(calls: DataFrame, optional: dict[str, str]) -> DataFrame:
    calls = with_column_defaults(calls, optional)
    return calls.withColumn("trans_id", trans_id(F.col("sap_event_id")))


def _touched(table: DataFrame, keys: list[tuple[str, str]], calls: DataFrame) -> DataFrame:
    """Rows of a large table whose key occurs in the call batch: a left-semi
    join before any aggregation, so only the touched keys are shuffled.  A
    semi join ignores duplicate keys, so the batch side is not de-duplicated
    (no extra shuffle)."""
    wanted = calls.select(*[F.col(c).alias(f"__w_{t}") for t, c in keys])
    cond = None
    for t, _ in keys:
        c = F.col(t) == F.col(f"__w_{t}")
        cond = c if cond is None else cond & c
    return table.join(wanted, cond, "left_semi")


def demand_adds(calls: DataFrame, slab_part_alloc: DataFrame, cfg: DataFrame, literal: bool) -> DataFrame:
    alloc_rows = _touched(slab_part_alloc, [("PartName", "part_name"), ("WoNumber", "work_order")], calls)
    alloc = alloc_rows.groupBy("PartName", "WoNumber").agg(F.sum("Qty").alias("__alloc"))
    j = calls.join(
        alloc,
        (F.col("part_name") == F.col("PartName")) & (F.col("work_order") == F.col("WoNumber")),
        "left",
    )
    alloc_col = F.col("__alloc") if literal else F.coalesce(F.col("__alloc"), F.lit(0))
    j = j.withColumn("__net", F.col("qty") - alloc_col).where(F.col("__net") > 0)
    j = j.join(cfg, F.col("sap_system") == F.col("cfg_system"), "inner")
    mark = derive_mark(F.col("mark"), F.col("part_name"), F.col("job"))
    return conform(
        j.select(
            F.lit(codes.ADD_PART).alias("TransType"),
            F.col("cfg_district").alias("District"),
            F.col("trans_id").alias("TransID"),
            F.col("work_order").alias("OrderNo"),
            F.col("part_name").alias("ItemName"),
            F.col("__net").cast("int").alias("Qty"),
            F.col("matl").alias("Material"),
            F.col("state").alias("Customer"),
            F.col("dwg").alias("DwgNumber"),
            F.col("codegen").alias("Remark"),
            F.col("job").alias("ItemData1"),
            F.col("shipment").alias("ItemData2"),
            F.col("chargeref").alias("ItemData5"),
            F.col("op1").alias("ItemData6"),
            F.col("op2").alias("ItemData7"),
            F.col("op3").alias("ItemData8"),
            mark.alias("ItemData9"),
            F.col("raw_mm").alias("ItemData10"),
            F.lit(codes.HIGH_HEAT_NUM).alias("ItemData14"),
            F.col("sap_event_id").alias("ItemData18"),
            (F.col("seq") * 2 + 1).alias("Ordinal"),
        )
    )


def committed_qty(part: DataFrame, pip: DataFrame) -> DataFrame:
    """``QtyCompleted + COALESCE(SUM(QtyInProcess), 0)`` per work-order part
    (A3): PIP is pre-aggregated (partial sums) and left-joined."""
    in_proc = pip.groupBy("PartName", "WONumber").agg(F.sum("QtyInProcess").alias("__inproc"))
    j = part.join(in_proc, ["PartName", "WONumber"], "left")
    return j.withColumn(
        "QtyCommitted", (F.col("QtyCompleted") + F.coalesce(F.col("__inproc"), F.lit(0))).cast("int")
    ).drop("__inproc")


def _stored_adds(adds: DataFrame) -> DataFrame:
    """The adds are staged, and compared with every row of the queue."""
    return cut(adds, "adds")


#: Keys by which a later add supersedes a staged row.
DEMAND_KEYS = ["OrderNo", "ItemName", "ItemData18"]
INVENTORY_KEYS = ["ItemName"]


def demand_changes(
    calls: DataFrame,
    part: DataFrame,
    pip: DataFrame,
    slab_part_alloc: DataFrame,
    config: DataFrame,
    trans_act: DataFrame,
    literal: bool = False,
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(removals, adds) that a batch of demand calls stages (C1).  Of the queue
    only the ids that the gate reads are used.  ``hold`` may store the adds, for
    callers that use them more than once."""
    calls = _prepare_calls(calls, DEMAND_OPTIONAL)
    cfg = district_by_system(config)
    adds = demand_adds(calls, slab_part_alloc, cfg, literal)
    adds = hold(adds) if hold else adds
    gated = _gate(calls, trans_act, adds, literal, "ItemData18", "part_name")
    # Removals: every work order of the called part not yet stamped with the
    # event (a NULL Data18 never compares unequal, so it is not removed).
    prt = part.select("PartName", "WONumber", "QtyCompleted", "Data18")
    rem = gated.join(
        prt,
        (F.col("PartName") == F.col("part_name"))
        & F.col("Data18").isNotNull()
        & (F.col("Data18") != F.col("sap_event_id")),
        "inner",
    )
    touched_pip = _touched(pip, [("PartName", "part_name")], calls)
    in_proc = touched_pip.groupBy("PartName", "WONumber").agg(F.sum("QtyInProcess").alias("__inproc"))
    rem = rem.join(in_proc, ["PartName", "WONumber"], "left")
    rem = rem.join(cfg, F.col("sap_system") == F.col("cfg_system"), "inner")
    committed = F.col("QtyCompleted") + F.coalesce(F.col("__inproc"), F.lit(0))
    removals = conform(
        rem.select(
            F.when(committed == 0, F.lit(codes.DELETE_PART)).otherwise(F.lit(codes.ADD_PART)).alias("TransType"),
            F.col("cfg_district").alias("District"),
            F.col("trans_id").alias("TransID"),
            F.col("WONumber").alias("OrderNo"),
            F.col("PartName").alias("ItemName"),
            committed.cast("int").alias("Qty"),
            F.col("sap_event_id").alias("ItemData18"),
            (F.col("seq") * 2).alias("Ordinal"),
        )
    )
    return removals, adds


def reconcile_demand(
    calls: DataFrame,
    part: DataFrame,
    pip: DataFrame,
    slab_part_alloc: DataFrame,
    config: DataFrame,
    trans_act: DataFrame,
    literal: bool = False,
) -> DataFrame:
    """Next version of the queue after a batch of demand calls."""
    removals, adds = demand_changes(calls, part, pip, slab_part_alloc, config, trans_act, literal, _stored_adds)
    return compact(conform(trans_act), removals.unionByName(adds), adds, DEMAND_KEYS)


#: Shares into which the sheets of a material are dealt for the removals' join.
MATERIAL_SALTS = 8


def _removable(gated: DataFrame, stock: DataFrame, adds: DataFrame) -> DataFrame:
    """Pairs of a gated call and a sheet of its material that another event put
    there, less those that a later add of the same sheet would supersede.

    Each sheet gets its last add before the join, whose condition then compares
    the call's ordinal with it, so superseded pairs are never made; and the
    sheets of a material are dealt to MATERIAL_SALTS shares, as one material may
    hold most of them.
    """
    last = adds.groupBy(F.col("ItemName").alias("SheetName")).agg(F.max("Ordinal").alias("__last"))
    sheets = stock.select("SheetName", "PrimeCode", "Material", "Thickness", "Width", "Length", "BinNumber").where(F.col("BinNumber").isNotNull())
    sheets = sheets.join(last, "SheetName", "left").withColumn("__share", F.pmod(F.xxhash64("SheetName"), F.lit(MATERIAL_SALTS)).cast("int"))
    events = gated.select("seq", "sap_event_id", "trans_id", "sap_system", "mm", F.explode(F.sequence(F.lit(0), F.lit(MATERIAL_SALTS - 1))).alias("__salt"))
    return events.join(
        sheets,
        (F.col("PrimeCode") == F.col("mm"))
        & (F.col("__share") == F.col("__salt"))
        & (F.col("BinNumber") != F.col("sap_event_id"))
        & (F.col("__last").isNull() | (F.col("seq") * 2 >= F.col("__last"))),
        "inner",
    )


def inventory_changes(
    calls: DataFrame,
    stock: DataFrame,
    slab_sheet_alloc: DataFrame,
    config: DataFrame,
    trans_act: DataFrame,
    literal: bool = False,
    hold: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(removals, adds) that a batch of inventory calls stages (C2); removals that
    an add of the batch supersedes are left out.  ``hold`` as in
    :func:`demand_changes`."""
    calls = _prepare_calls(calls, INVENTORY_OPTIONAL)
    cfg = district_by_system(config)
    alloc_rows = _touched(slab_sheet_alloc, [("SheetName", "sheet_name")], calls)
    alloc = alloc_rows.groupBy("SheetName").agg(F.count("SheetName").alias("__alloc"))
    a = calls.join(alloc, F.col("sheet_name") == F.col("SheetName"), "left")
    a = a.withColumn("__net", F.col("qty") - F.coalesce(F.col("__alloc"), F.lit(0))).where(F.col("__net") > 0)
    a = a.join(cfg, F.col("sap_system") == F.col("cfg_system"), "inner")
    remnant = F.col("sheet_type") == "Remnant"
    adds = conform(
        a.select(
            codes.sheet_trans_type(F.col("sheet_type")).alias("TransType"),
            F.col("cfg_district").alias("District"),
            F.col("trans_id").alias("TransID"),
            F.col("sheet_name").alias("ItemName"),
            F.col("__net").cast("int").alias("Qty"),
            F.col("matl").alias("Material"),
            F.col("thk").alias("Thickness"),
            F.col("wid").alias("Width"),
            F.col("len").alias("Length"),
            F.col("mm").alias("PrimeCode"),
            F.col("sap_event_id").alias("BinNumber"),
            F.col("notes1").alias("ItemData1"),
            F.col("notes2").alias("ItemData2"),
            F.col("notes3").alias("ItemData3"),
            F.col("notes4").alias("ItemData4"),
            F.when(remnant, fill_template(F.col("cfg_template"), F.col("sheet_name"))).alias("FileName"),
            F.lit(None).cast("string").alias("ItemData18"),
            (F.col("seq") * 2 + 1).alias("Ordinal"),
        )
    )
    adds = hold(adds) if hold else adds
    # the gate's NULL-event rule looks at the add's event id
    gate_adds = a.select(F.col("sap_event_id").alias("ItemData18"), (F.col("seq") * 2 + 1).alias("Ordinal"))
    gated = _gate(calls, trans_act, gate_adds, literal, "BinNumber", "mm")
    rem = _removable(gated, stock, adds).join(cfg, F.col("sap_system") == F.col("cfg_system"), "inner")
    removals = conform(
        rem.select(
            F.lit(codes.ADD_SHEET).alias("TransType"),
            F.col("cfg_district").alias("District"),
            F.col("trans_id").alias("TransID"),
            F.col("SheetName").alias("ItemName"),
            F.lit(0).alias("Qty"),
            "Material",
            "Thickness",
            "Length",
            "Width",
            # the event that passed the gate, so that it does not pass again
            (F.lit(None).cast("string") if literal else F.col("sap_event_id")).alias("ItemData18"),
            (F.col("seq") * 2).alias("Ordinal"),
        )
    )
    return removals, adds


def reconcile_inventory(
    calls: DataFrame,
    stock: DataFrame,
    slab_sheet_alloc: DataFrame,
    config: DataFrame,
    trans_act: DataFrame,
    literal: bool = False,
) -> DataFrame:
    """Next version of the queue after a batch of inventory calls."""
    removals, adds = inventory_changes(calls, stock, slab_sheet_alloc, config, trans_act, literal, _stored_adds)
    return compact(conform(trans_act), removals.unionByName(adds), adds, INVENTORY_KEYS)


def gate_not_in_literal(calls: DataFrame, trans_act: DataFrame) -> DataFrame:
    """Calls whose 10-char id is ``NOT IN`` the queue's TransIDs, with SQL's
    NULL semantics (J9, D2)."""
    from ..operators.joins import not_in

    c = calls.select("seq", "sap_event_id", trans_id(F.col("sap_event_id")).alias("trans_id"))
    return not_in(c, "trans_id", trans_act.select("TransID"), "TransID")
