"""Demand scenarios: revision (C13), overlay (C14), spreadsheet ingest
(C16); stock overlay (C15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import first_dash_to_underscore, is_main_member, job_of
from ..operators.changelog import overlay
from ..operators.dedup import last_per_key
from .queue import with_column_defaults


def parts_in_process(part: DataFrame, pip: DataFrame) -> DataFrame:
    """The PartWithQtyInProcess view: every work-order part with its
    in-process quantity (0 when nothing is nested).  PIP is reduced by a
    partial aggregate before the join."""
    sums = pip.groupBy("PartName", "WONumber").agg(F.sum("QtyInProcess").alias("__q"))
    return part.select("PartName", "WONumber").join(sums, ["PartName", "WONumber"], "left").select(
        "PartName", "WONumber", F.coalesce(F.col("__q"), F.lit(0)).cast("int").alias("QtyInProcess")
    )


def revise_demand(part: DataFrame, in_process: DataFrame, part_name: str | None = None) -> DataFrame:
    """``UPDATE Part SET QtyOrdered = QtyCompleted + QtyInProcess`` from an
    inner join with the in-process view (J14).  Parts without an in-process
    row (or not named, when ``part_name`` is given) keep their order."""
    ip = in_process.select("PartName", "WONumber", F.col("QtyInProcess").alias("__ip"), F.lit(True).alias("__m"))
    j = part.join(ip, ["PartName", "WONumber"], "left")
    hit = F.col("__m").isNotNull()
    if part_name is not None:
        hit = hit & (F.col("PartName") == part_name)
    return j.withColumn(
        "QtyOrdered",
        F.when(hit, F.col("QtyCompleted") + F.col("__ip")).otherwise(F.col("QtyOrdered")).cast("int"),
    ).drop("__ip", "__m")


def zero_order_deletes(revised_part: DataFrame) -> DataFrame:
    """SN82 for every work-order part with nothing left on order -- with no
    filter on the revised part's name (C13)."""
    return (
        revised_part.where(F.col("QtyOrdered") == 0)
        .select(
            F.lit(codes.DELETE_PART).alias("TransType"),
            F.lit(1).cast("int").alias("District"),
            F.col("WONumber").alias("OrderNo"),
            F.col("PartName").alias("ItemName"),
        )
        .distinct()
    )


def demand_feed(calls: DataFrame) -> DataFrame:
    """The ERP's current demand: the last call per (work order, part) with a
    positive quantity, as SN81 rows (the reload of an overlay)."""
    feed = with_column_defaults(calls, {"matl": "string", "thk": "double", "shipment": "string"})
    last = last_per_key(
        feed.select("work_order", "part_name", "seq", "qty", "job", "matl", "thk", "shipment"), ["work_order", "part_name"], ["seq"]
    )
    return last.where(F.col("qty") > 0).select(
        F.lit(codes.ADD_PART).alias("TransType"),
        F.lit(1).cast("int").alias("District"),
        F.col("work_order").alias("OrderNo"),
        F.col("part_name").alias("ItemName"),
        F.col("qty").cast("int").alias("Qty"),
        F.col("matl").alias("Material"),
        F.col("thk").alias("Thickness"),
        F.col("job").alias("ItemData1"),
        F.col("shipment").alias("ItemData2"),
    )


def revise_and_stage(part: DataFrame, in_process: DataFrame, calls: DataFrame, part_name: str | None = None) -> DataFrame:
    """Revision of a part (C13): its orders are cut to what is done or nested,
    SN82 is staged for every work order left at zero, then SN81 for the part's
    current demand.  ``part_name=None`` revises every part."""
    deletes = zero_order_deletes(revise_demand(part, in_process, part_name))
    if part_name is not None:
        calls = calls.where(F.col("part_name") == part_name)
    return deletes.unionByName(demand_feed(calls), allowMissingColumns=True)


def overlay_demand(part: DataFrame, in_process: DataFrame, calls: DataFrame) -> DataFrame:
    """Demand overlay (C14): revise every part, stage SN82 for zero orders,
    one SN89I marker, then the full reload.  ``Phase`` orders the three
    blocks (0 deletes, 1 marker, 2 reload)."""
    deletes = zero_order_deletes(revise_demand(part, in_process)).withColumn("Phase", F.lit(0))
    marker = part.sparkSession.range(1).select(
        F.lit(codes.DEMAND_OVERLAY_MARK).alias("TransType"), F.lit(1).cast("int").alias("District"),
        F.lit(1).alias("Phase"),
    )
    reload = demand_feed(calls).withColumn("Phase", F.lit(2))
    return overlay(deletes.unionByName(marker, allowMissingColumns=True), reload)


def overlay_stock(inventory_calls: DataFrame, config: DataFrame) -> DataFrame:
    """Stock overlay (C15): SN95 and SN95R reset markers, then the whole
    current stock feed (last call per sheet with a positive quantity) as
    SN91A sheets / SN97 remnants; remnants get their DXF file name."""
    from .queue import district_by_system

    cfg = district_by_system(config)
    last = last_per_key(
        with_column_defaults(inventory_calls, {"thk": "double", "wid": "double", "len": "double"}).select(
            "sheet_name", "seq", "sap_system", "sheet_type", "qty", "mm", "matl", "thk", "wid", "len"
        ),
        ["sheet_name"],
        ["seq"],
    ).where(F.col("qty") > 0)
    last = last.join(cfg, F.col("sap_system") == F.col("cfg_system"), "left")
    remnant = F.col("sheet_type") == "Remnant"
    reload = last.select(
        codes.sheet_trans_type(F.col("sheet_type")).alias("TransType"),
        F.lit(1).cast("int").alias("District"),
        F.col("sheet_name").alias("ItemName"),
        F.col("qty").cast("int").alias("Qty"),
        F.col("matl").alias("Material"),
        F.col("thk").alias("Thickness"),
        F.col("wid").alias("Width"),
        F.col("len").alias("Length"),
        F.col("mm").alias("PrimeCode"),
        F.when(remnant, F.replace(F.col("cfg_template"), F.lit("<sheet_name>"), F.col("sheet_name"))).alias(
            "FileName"
        ),
        F.lit(1).alias("Phase"),
    )
    spark = inventory_calls.sparkSession
    markers = spark.createDataFrame(
        [(c, 1, 0) for c in codes.STOCK_RESET_MARKS], "TransType string, District int, Phase int"
    )
    return overlay(markers, reload)


def spreadsheet_rows(demand_calls: DataFrame) -> DataFrame:
    """Spreadsheet export rows (event id, part, qty, unused, shipment),
    derived from the demand calls: purchases carry main-member marks."""
    yard = F.lpad(F.col("work_order").substr(3, 20), 7, "0")
    part = F.when(
        F.col("event_type") == "purchase",
        F.concat(yard, F.lit("B-G"), (F.col("seq") % 50).cast("string"), F.lit("A-A1")),
    ).otherwise(F.concat(yard, F.lit("B-"), F.col("part_name")))
    return demand_calls.select(
        F.right(F.col("sap_event_id"), F.lit(10)).alias("event_id"),
        part.alias("part"),
        (F.col("qty").cast("double") + F.lit(0.5)).alias("qty"),
        F.col("event_type").alias("unused"),
        (F.col("seq") % 4 + 1).cast("double").alias("shipment"),
    )


def ingest_spreadsheet_demand(rows: DataFrame) -> DataFrame:
    """Spreadsheet demand rows -> SN81B queue rows.

    ``job`` is the text before the first '-'; the order is
    ``job-shipment-main|sec``; the part name gets its first '-' replaced by
    '_'; spreadsheet floats are truncated to int."""
    job = job_of(F.col("part"))
    ship = F.col("shipment").cast("int")
    kind = F.when(is_main_member(F.col("part")), F.lit("main")).otherwise(F.lit("sec"))
    return rows.select(
        F.lit(codes.ADD_PART_ARCHIVED).alias("TransType"),
        F.lit(1).cast("int").alias("District"),
        F.col("event_id").alias("TransID"),
        F.concat_ws("-", job, ship.cast("string"), kind).alias("OrderNo"),
        first_dash_to_underscore(F.col("part")).alias("ItemName"),
        F.lit("MS").alias("Material"),
        F.col("qty").cast("int").alias("Qty"),
        job.alias("ItemData1"),
        ship.alias("ItemData2"),
    )
