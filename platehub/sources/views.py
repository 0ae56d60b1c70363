"""Shop-floor tables expressed as DataFrames over the driver's test tables.

Each property derives one table of the manufacturing data model (program
outbox, parts, stock, queue, ...) from the TPC-H-like parquet files, so every
job reads data whose size grows with the scale factor.  The SQL twins of these
definitions (used only by the DuckDB oracle) live in ``proxy_sql``; the two
are written independently so the oracle also checks the views.

Nothing is cached: each property returns a lazy plan and Catalyst prunes the
columns a job does not use down to the parquet scan.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table


def _s(c) -> Column:
    """Integer-like column rendered as decimal text."""
    return F.col(c).cast("string") if isinstance(c, str) else c.cast("string")


def _event_key20(c: Column) -> Column:
    """20-position zero-padded numeric event id (ERP style)."""
    return F.lpad(c.cast("string"), 20, "0")


def _part_name(partkey: Column) -> Column:
    return F.concat(F.lit("J"), (partkey % 50).cast("string"), F.lit("-P"), partkey.cast("string"))


def _erp_system(event_id: Column) -> Column:
    # fixed values: the five configured ERP systems and one that has no config row
    codes = F.array(*[F.lit(c) for c in ("AFR", "AME", "ASI", "EUR", "MID", "OLD")])
    return F.element_at(codes, (event_id % 6 + 1).cast("int"))


def _group(column: str, size: int) -> Column:
    """Whole-number groups of ``size`` neighbours; their number grows with the data."""
    return F.floor(F.col(column) / size).cast("long")


class Views:
    """Lazily built proxy tables for one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    # -- configuration -----------------------------------------------------
    @cached_property
    def config(self) -> DataFrame:
        r = self.table("region")
        return r.select(
            F.upper(F.substring("r_name", 1, 3)).alias("SapSystem"),
            (F.col("r_regionkey") + 1).cast("int").alias("SimTransDistrict"),
            F.concat(F.lit("/dxf/"), F.lower("r_name"), F.lit("/<sheet_name>.dxf")).alias(
                "RemnantDxfTemplate"
            ),
        )

    # -- program outbox and programs ---------------------------------------
    @cached_property
    def st_prg_arc(self) -> DataFrame:
        # The order key is a repeat number: unique in a program, and in order.
        o = self.table("orders")
        return o.select(
            F.col("o_orderkey").alias("AutoID"),
            F.col("o_orderkey").alias("ArchivePacketID"),
            F.when(F.col("o_orderstatus") == "O", "SN100")
            .when(F.col("o_orderstatus") == "F", "SN101")
            .when(F.col("o_orderpriority") == "5-LOW", "SN109")  # a code nothing knows
            .otherwise("SN102")
            .alias("TransType"),
            F.concat(F.lit("PRG"), _s("o_custkey")).alias("ProgramName"),
            F.col("o_orderkey").alias("RepeatID"),
            F.col("o_orderpriority").alias("MachineName"),
            F.col("o_totalprice").alias("CuttingTime"),
            F.concat(F.lit("S"), _s("o_custkey")).alias("SheetName"),
        )

    @cached_property
    def program(self) -> DataFrame:
        return self.st_prg_arc.where(F.col("TransType") != "SN101").select(
            "ProgramName", "RepeatID", "ArchivePacketID", "MachineName", "CuttingTime", "SheetName"
        )

    @cached_property
    def sip(self) -> DataFrame:
        return self.program.select("ProgramName", "RepeatID", "SheetName")

    @cached_property
    def program_machine(self) -> DataFrame:
        return self.program.select("MachineName", "ProgramName", "CuttingTime").distinct()

    # -- stock ---------------------------------------------------------------
    @cached_property
    def stock(self) -> DataFrame:
        p = self.table("part")
        key = F.col("p_partkey")
        return p.select(
            F.concat(F.lit("S"), _s(key)).alias("SheetName"),
            F.concat(F.lit("MM"), _group("p_partkey", 10).cast("string")).alias("PrimeCode"),
            F.col("p_type").alias("Material"),
            (F.col("p_size").cast("double") * F.lit(0.125)).alias("Thickness"),
            (F.lit(48) + F.col("p_size")).cast("double").alias("Width"),
            F.col("p_retailprice").alias("Length"),
            (F.col("p_size") % 10).cast("int").alias("Qty"),
            F.when(key % 7 == 0, F.lit(None).cast("string"))
            .otherwise(_event_key20(key % 100))
            .alias("BinNumber"),
        )

    # -- parts / work orders -------------------------------------------------
    @cached_property
    def part_wo(self) -> DataFrame:
        li = self.table("lineitem")
        pk = F.col("l_partkey")
        completed = F.when(
            (F.col("l_linestatus") == "F") & (F.col("l_returnflag") == "A"), F.col("l_quantity")
        ).otherwise(F.lit(0.0))
        return li.groupBy("l_partkey", "l_orderkey").agg(
            F.sum("l_quantity").cast("int").alias("QtyOrdered"),
            F.sum(completed).cast("int").alias("QtyCompleted"),
            F.min("l_linenumber").alias("__line"),
        ).select(
            _part_name(pk).alias("PartName"),
            F.concat(F.lit("WO"), _s("l_orderkey")).alias("WONumber"),
            "QtyOrdered",
            "QtyCompleted",
            F.concat(F.lit("J"), (pk % 50).cast("string")).alias("Data1"),
            F.when(F.col("__line") == 3, "").when(F.col("__line") == 4, "n/a").when(F.col("__line") == 5, F.lit(None))
            .otherwise(F.concat(F.lit(" "), _s("__line"))).alias("Data2"),
            F.when(pk % 7 == 0, F.lit(None).cast("string"))
            .otherwise(_event_key20(pk % 100))
            .alias("Data18"),
        )

    def _lines_with_program(self) -> DataFrame:
        li = self.table("lineitem")
        # The orders, one row a key, are hashed; the lines, several times as many,
        # pass by unsorted and are held by no task.
        prg = self.st_prg_arc.hint("shuffle_hash")
        return li.join(prg, li["l_orderkey"] == prg["ArchivePacketID"], "inner")

    @cached_property
    def pip(self) -> DataFrame:
        j = self._lines_with_program().where(F.col("l_linestatus") == "O")
        return j.select(
            _part_name(F.col("l_partkey")).alias("PartName"),
            F.concat(F.lit("WO"), _s("l_orderkey")).alias("WONumber"),
            "ProgramName",
            F.col("l_quantity").cast("int").alias("QtyInProcess"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("TrueArea"),
            F.col("l_extendedprice").alias("NestedArea"),
        )

    @cached_property
    def st_pip_arc(self) -> DataFrame:
        j = self._lines_with_program()
        auto_id = (
            F.col("l_orderkey") * 1000000000
            + F.col("l_partkey") * 10000
            + F.col("l_suppkey") * 10
            + F.col("l_linenumber")
        )
        return j.select(
            auto_id.alias("AutoID"),
            F.col("l_orderkey").alias("ArchivePacketID"),
            "TransType",
            "SheetName",
            _part_name(F.col("l_partkey")).alias("PartName"),
            F.concat(F.lit("WO"), _s("l_orderkey")).alias("WONumber"),
            F.when(F.col("l_returnflag") == "R", F.lit(0.0))
            .otherwise(F.col("l_quantity"))
            .cast("int")
            .alias("QtyInProcess"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("TrueArea"),
            F.col("l_extendedprice").alias("NestedArea"),
        )

    @cached_property
    def remnant(self) -> DataFrame:
        j = self._lines_with_program().where(F.col("l_returnflag") == "R")
        return j.select(
            F.concat_ws(
                "-",
                F.concat(F.lit("R"), _s("l_orderkey")),
                _s("l_partkey"),
                _s("l_suppkey"),
                _s("l_linenumber"),
            ).alias("RemnantName"),
            "ProgramName",
            "RepeatID",
            F.col("l_quantity").alias("Length"),
            (F.col("l_quantity") / 2).alias("Width"),
            (F.col("l_quantity") * F.col("l_quantity") / 2).alias("Area"),
            (F.col("l_quantity") * 7.5).alias("Weight"),
            F.concat(F.lit("MM"), _group("l_partkey", 10).cast("string")).alias("PrimeCode"),
            F.col("l_linenumber").cast("int").alias("Qty"),
        )

    # -- further archive tables of the outbox --------------------------------
    @cached_property
    def st_prt_arc(self) -> DataFrame:
        """Completed parts (STPrtArc)."""
        li = self.table("lineitem").where(F.col("l_linestatus") == "F")
        return li.select(
            F.col("l_orderkey").alias("ArchivePacketID"),
            _part_name(F.col("l_partkey")).alias("PartName"),
            F.col("l_quantity").cast("int").alias("QtyProgram"),
            F.concat(F.lit("J"), (F.col("l_partkey") % 50).cast("string")).alias("Data1"),
            F.when(F.col("l_linenumber") == 4, "n/a").when(F.col("l_linenumber") != 3, _s("l_linenumber")).alias("Data2"),
            (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("TrueArea"),
            F.col("l_extendedprice").alias("NestedArea"),
        )

    @cached_property
    def st_wo_arc(self) -> DataFrame:
        return self.table("orders").select(F.concat(F.lit("WO"), _s("o_orderkey")).alias("WONumber"))

    # -- batch file ----------------------------------------------------------
    @cached_property
    def batches(self) -> DataFrame:
        p = self.table("part")
        return p.select(
            F.lpad(_s("p_partkey"), 10, "0").alias("id"),
            F.col("p_brand").alias("mm"),
            F.concat(F.lit("S"), _group("p_partkey", 4).cast("string")).alias("sheet_name"),
            F.when(F.col("p_type") == "PROMO", "Y").otherwise("N").alias("remnant"),
        )

    # -- staged-transaction queue -------------------------------------------
    @cached_property
    def trans_act(self) -> DataFrame:
        """Staged SN70 rows of the low-priority programs, with the ids of the
        events that staged them: every second id shares only its tail with an
        ERP call's."""
        prg = self.st_prg_arc.where(F.col("MachineName") == "5-LOW")
        event = F.when(F.col("AutoID") % 2 == 0, _event_key20(_group("AutoID", 8))).otherwise(
            F.concat(F.lit("9"), F.lpad(_group("AutoID", 8).cast("string"), 19, "0"))
        )
        return prg.select(
            F.lit("SN70").alias("TransType"),
            F.lit(1).cast("int").alias("District"),
            F.right(event, F.lit(10)).alias("TransID"),
            event.alias("ItemData18"),
            event.alias("BinNumber"),
            "ProgramName",
            F.col("RepeatID").alias("ProgramRepeat"),
        )

    # -- slab allocations ----------------------------------------------------
    @cached_property
    def slab_part_alloc(self) -> DataFrame:
        e = self.table("events").where(F.col("event_type") == "purchase")
        return e.select(
            _part_name(_group("event_id", 10)).alias("PartName"),
            F.concat(F.lit("WO"), _s("user_id")).alias("WoNumber"),
            F.floor(F.col("value") / 2).cast("int").alias("Qty"),
        )

    @cached_property
    def slab_sheet_alloc(self) -> DataFrame:
        p = self.table("part")
        return p.select(F.concat(F.lit("S"), _group("p_partkey", 20).cast("string")).alias("SheetName"))

    # -- ERP event calls -----------------------------------------------------
    @cached_property
    def demand_events(self) -> DataFrame:
        """Ten calls an ERP event; events, parts and work orders grow with the data."""
        e = self.table("events")
        ev = _group("event_id", 10)
        kind = F.col("event_type")
        return e.select(
            F.col("event_id").alias("seq"),
            _event_key20(ev).alias("sap_event_id"),
            _erp_system(ev).alias("sap_system"),
            _part_name(ev).alias("part_name"),
            F.concat(F.lit("WO"), _s("user_id")).alias("work_order"),
            F.floor("value").cast("int").alias("qty"),
            F.when(ev % 9 != 0, F.concat(F.lit("J"), (ev % 50).cast("string"))).alias("job"),
            F.concat(F.lit("M"), _s(ev % 7)).alias("matl"),
            F.concat(F.lit("C-"), kind).alias("state"),
            F.concat(F.lit("D"), _s(ev)).alias("dwg"),
            F.when(kind == "click", "CG").alias("codegen"),
            _s(ev % 4).alias("shipment"),
            F.concat(F.lit("CR"), _s("user_id")).alias("chargeref"),
            F.when(kind == "error", "DRILL").alias("op1"),
            F.when(kind == "signup", "BEVEL").alias("op2"),
            F.when(kind == "view", "PAINT").alias("op3"),
            F.when(ev % 13 == 0, F.concat(F.lit("MK"), _s(ev))).alias("mark"),
            F.concat(F.lit("R"), _s(ev % 11)).alias("raw_mm"),
            "event_type",
            "ts",
        )

    @cached_property
    def inventory_events(self) -> DataFrame:
        e = self.table("events")
        ev = _group("event_id", 10)
        return e.select(
            F.col("event_id").alias("seq"),
            _event_key20(ev).alias("sap_event_id"),
            _erp_system(ev).alias("sap_system"),
            F.concat(F.lit("S"), _group("event_id", 5).cast("string")).alias("sheet_name"),
            F.when(F.col("event_type") == "error", "Remnant").otherwise("Sheet").alias("sheet_type"),
            F.floor(F.col("value") / 2).cast("int").alias("qty"),
            F.concat(F.lit("MM"), _group("event_id", 100).cast("string")).alias("mm"),
            F.concat(F.lit("A"), _s(ev % 7)).alias("matl"),
            (F.col("user_id") % 8 / 8).cast("double").alias("thk"),
            (F.col("user_id") % 90).cast("double").alias("wid"),
            (F.col("user_id") % 500).cast("double").alias("len"),
            F.concat(F.lit("n"), _s("user_id")).alias("notes1"),
            F.when(F.col("event_type") == "error", "check").alias("notes2"),
            _s(ev % 3).alias("notes3"),
            F.col("event_type").alias("notes4"),
        )

    # -- engineering BOM -----------------------------------------------------
    @cached_property
    def bom(self) -> DataFrame:
        p = self.table("part")
        k = F.col("p_partkey")
        size = F.col("p_size")
        return p.select(
            (k % 20).cast("int").alias("job"),
            (k % 4).cast("int").alias("shipment"),
            F.concat(F.lit("X"), _s(k)).alias("mark"),
            (1 + size % 5).cast("int").alias("qty"),
            F.when(F.col("p_type") == "ECONOMY", "PL")
            .when(F.col("p_type") == "MEDIUM", "SHT")
            .when(F.col("p_type") == "LARGE", "PL")
            .otherwise("W")
            .alias("type"),
            (size.cast("double") / 16).alias("thk"),
            (20 + size * 2).cast("double").alias("wid"),
            (size.cast("double") * 7.25).alias("len"),
            F.when(k % 5 == 0, "A240 Type 304")
            .when(k % 5 == 1, "A606 TYPE 4")
            .when(k % 5 == 2, "A709")
            .when(k % 5 == 3, "A709")
            .otherwise("A588")
            .alias("spec"),
            F.when(k % 3 == 0, "50").when(k % 3 == 1, "HPS70W").otherwise("345W").alias("grade"),
            F.when(k % 4 == 0, "T").when(k % 4 == 1, "FCM").otherwise("").alias("test"),
            F.when(k % 11 == 0, "SRM").when(k % 11 == 1, "BEV. FILL").otherwise("").alias("remark"),
            F.when(k % 3 == 0, "03").when(k % 3 == 1, "04").otherwise("07").alias("item"),
        )

    # -- program state posts and program update events (ours) ----------------
    @cached_property
    def program_state_events(self) -> DataFrame:
        """Operator posts per program, one per order: priority picks the state."""
        o = self.table("orders")
        state = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "Complete")
            .when(F.col("o_orderpriority") == "2-HIGH", "Processing")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "Initiated")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Cancelled")
            .otherwise("Complete")
        )
        return o.select(
            F.col("o_orderkey").alias("post_seq"),
            F.concat(F.lit("PRG"), _s("o_custkey")).alias("program"),
            F.lpad(_s("o_orderkey"), 10, "0").alias("batch"),
            state.alias("state"),
        )

    @cached_property
    def program_update_events(self) -> DataFrame:
        e = self.table("events").where(F.col("event_type") == "purchase")
        return e.select(
            F.col("event_id").alias("seq"),
            _erp_system(F.col("event_id")).alias("sap_system"),
            _event_key20(F.col("event_id")).alias("sap_event_id"),
            F.col("event_id").alias("archive_packet_id"),
        )
