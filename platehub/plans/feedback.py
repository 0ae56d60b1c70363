"""Feedback (outbox) jobs: retention purge (C3), program feed (C4), part /
sheet / remnant feeds (C5, J1, J2, J4, J5), program -> sheet map (J6, A8)
and the nested feedback documents (C6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import shipment_int
from ..operators.changelog import purge_keep
from ..operators.dedup import last_per_key
from ..operators.documents import DEFAULT_PAGE_SIZE, attach_children, child_summary

# -- C3 / C4 -------------------------------------------------------------------


def purge_program_outbox(st_prg_arc: DataFrame) -> DataFrame:
    """Rows of the program outbox that survive the retention purge."""
    return purge_keep(st_prg_arc, "TransType", codes.PROGRAM_OUTBOX_KEEP)


def purge_part_outbox(st_pip_arc: DataFrame) -> DataFrame:
    """Rows of the part outbox that survive the retention purge."""
    return purge_keep(st_pip_arc, "TransType", codes.PART_OUTBOX_KEEP)


def program_feedback(st_prg_arc: DataFrame) -> DataFrame:
    """Program feed after the purge: created / deleted programs (C4)."""
    kept = purge_program_outbox(st_prg_arc)
    return kept.where(F.col("TransType").isin(*codes.PROGRAM_OUTBOX_KEEP)).select(
        "AutoID",
        "ArchivePacketID",
        codes.status_label(F.col("TransType")).alias("Status"),
        "ProgramName",
        "MachineName",
        "CuttingTime",
    )


def program_feed(st_prg_arc: DataFrame) -> DataFrame:
    """All programs of the unpurged outbox with their state (S3)."""
    return st_prg_arc.select(
        "ArchivePacketID", codes.decode_state(F.col("TransType")).alias("state"), "ProgramName", "RepeatID", "MachineName", "CuttingTime"
    )


def completed_parts(st_prt_arc: DataFrame) -> DataFrame:
    """Completed parts of the archive (S3): typed, with P6 defaults."""
    return st_prt_arc.select(
        "ArchivePacketID", F.coalesce("PartName", F.lit("")).alias("PartName"), F.col("QtyProgram").alias("PartQty"),
        F.coalesce("Data1", F.lit("")).alias("Job"), shipment_int(F.col("Data2")).alias("Shipment"), "TrueArea", "NestedArea",
    )


def purge_outbox(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The outbox tables after the retention purge (U2, C3): programs and parts
    keep the codes that are still read; the other archives are emptied."""
    keep = {"st_prg_arc": purge_program_outbox, "st_pip_arc": purge_part_outbox}
    return {name: keep[name](df) if name in keep else df.limit(0) for name, df in tables.items()}


def purge_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows before and after the purge, by table."""
    out = None
    for name, kept in purge_outbox(tables).items():
        row = tables[name].select(F.lit(name).alias("table_name"), F.lit(1).alias("before"), F.lit(0).alias("after")).unionByName(
            kept.select(F.lit(name).alias("table_name"), F.lit(0).alias("before"), F.lit(1).alias("after"))
        )
        out = row if out is None else out.unionByName(row)
    return out.groupBy("table_name").agg(F.sum("before").cast("long").alias("rows_before"), F.sum("after").cast("long").alias("rows_after"))


def unknown_code_counts(st_prg_arc: DataFrame) -> DataFrame:
    """Quarantine (D8): outbox rows by codes that no state has."""
    return st_prg_arc.where(codes.decode_state(F.col("TransType")).isNull()).groupBy("TransType").agg(F.count("*").alias("n"))


def shipment_quarantine(part: DataFrame) -> DataFrame:
    """Quarantine (D7): work-order parts whose shipment is text but no number;
    the feeds show them without a shipment."""
    return part.where(shipment_int(F.col("Data2")).isNull()).select("PartName", "WONumber", "Data2")


# -- parts ---------------------------------------------------------------------


def _part_payload(j: DataFrame) -> list:
    """Typed rename projection of a part feedback row."""
    return [
        F.coalesce(F.col("PartName"), F.lit("")).alias("PartName"),
        F.col("QtyInProcess").alias("PartQty"),
        F.coalesce(F.col("Data1"), F.lit("")).alias("Job"),
        shipment_int(F.col("Data2")).alias("Shipment"),
        "TrueArea",
        "NestedArea",
    ]


def _pip_with_part(st_pip_arc: DataFrame, part: DataFrame) -> DataFrame:
    prt = part.select("PartName", "WONumber", "Data1", "Data2")
    return st_pip_arc.join(prt, ["PartName", "WONumber"], "inner")


def part_feedback(st_pip_arc: DataFrame, part: DataFrame, created_only: bool = True) -> DataFrame:
    """Part feedback joined to its work-order part (J1).  ``created_only``:
    SN100 rows with a positive in-process quantity (the retrieval procedure);
    otherwise every outbox row with its state."""
    src = st_pip_arc
    if created_only:
        src = src.where((F.col("TransType") == codes.FEEDBACK_CREATED) & (F.col("QtyInProcess") > 0))
    j = _pip_with_part(src, part)
    cols = ["AutoID", "ArchivePacketID", "SheetName"] + _part_payload(j)
    if not created_only:
        cols.insert(2, codes.decode_state(F.col("TransType")).alias("state"))
    return j.select(*cols)


def part_feedback_sheets(st_pip_arc: DataFrame, part: DataFrame, stock: DataFrame) -> DataFrame:
    """Part feedback with its sheet (J2): two chained inner joins."""
    j = _pip_with_part(st_pip_arc, part)
    stk = stock.select("SheetName", F.col("PrimeCode").alias("MaterialMaster"))
    j = j.join(stk, "SheetName", "inner")
    return j.select(
        F.col("AutoID").alias("Id"),
        "ArchivePacketID",
        *_part_payload(j),
        F.coalesce(F.col("SheetName"), F.lit("")).alias("SheetName"),
        F.coalesce(F.col("MaterialMaster"), F.lit("")).alias("MaterialMaster"),
    )


# -- sheets / remnants ------------------------------------------------------------


def program_sheets(st_prg_arc: DataFrame, sip: DataFrame, stock: DataFrame) -> DataFrame:
    """Sheets of created programs via sheets-in-process."""
    prg = st_prg_arc.where(F.col("TransType") == codes.FEEDBACK_CREATED).select(
        "ArchivePacketID", "ProgramName", "RepeatID"
    )
    j = prg.join(sip.select("ProgramName", "RepeatID", "SheetName"), ["ProgramName", "RepeatID"], "inner")
    j = j.join(stock.select("SheetName", "PrimeCode"), "SheetName", "inner")
    return j.select("ArchivePacketID", "SheetName", F.col("PrimeCode").alias("MaterialMaster"))


def program_remnants(st_prg_arc: DataFrame, remnant: DataFrame) -> DataFrame:
    """Remnants to be produced by created programs."""
    prg = st_prg_arc.where(F.col("TransType") == codes.FEEDBACK_CREATED).select(
        "ArchivePacketID", "ProgramName", "RepeatID"
    )
    j = prg.join(remnant.select("ProgramName", "RepeatID", "RemnantName", "Area"), ["ProgramName", "RepeatID"])
    return j.select("ArchivePacketID", "RemnantName", "Area")


def program_sheet_rows(st_prg_arc: DataFrame, stock: DataFrame) -> DataFrame:
    """Outbox programs with their sheet (J6).  Programs whose sheet is not in
    Stock drop out, as in the original inner join."""
    stk = stock.select("SheetName", F.col("PrimeCode").alias("MaterialMaster"))
    return st_prg_arc.join(stk, "SheetName", "inner")


def dropped_programs(st_prg_arc: DataFrame, stock: DataFrame) -> DataFrame:
    """Audit of J6: outbox programs that disappear because of a missing sheet."""
    return st_prg_arc.join(stock.select("SheetName"), "SheetName", "left_anti")


def sheet_by_program(st_prg_arc: DataFrame, stock: DataFrame, order_col: str = "AutoID") -> DataFrame:
    """Program -> sheet map; on duplicate programs the last row wins (A8,
    D5: last = largest outbox id)."""
    rows = program_sheet_rows(st_prg_arc, stock).select("ProgramName", order_col, "SheetName", "MaterialMaster")
    return last_per_key(rows, ["ProgramName"], [order_col]).drop(order_col).select(
        "ProgramName",
        F.coalesce(F.col("SheetName"), F.lit("")).alias("SheetName"),
        F.coalesce(F.col("MaterialMaster"), F.lit("")).alias("MaterialMaster"),
    )


# -- C6: nested documents --------------------------------------------------------

PART_FIELDS = ["partName", "partQty", "job", "shipment", "trueArea", "nestedArea"]
REMNANT_FIELDS = ["remnantName", "length", "width", "area"]


def _created_parts(st_pip_arc: DataFrame, part: DataFrame) -> DataFrame:
    src = st_pip_arc.where(F.col("TransType") == codes.FEEDBACK_CREATED)
    j = _pip_with_part(src, part)
    return j.select(
        "AutoID",
        "ArchivePacketID",
        F.coalesce(F.col("PartName"), F.lit("")).alias("partName"),
        F.col("QtyInProcess").alias("partQty"),
        F.coalesce(F.col("Data1"), F.lit("")).alias("job"),
        shipment_int(F.col("Data2")).alias("shipment"),
        F.col("TrueArea").alias("trueArea"),
        F.col("NestedArea").alias("nestedArea"),
    )


def _remnant_rows(remnant: DataFrame) -> DataFrame:
    return remnant.select(
        "ProgramName",
        "RepeatID",
        F.col("RemnantName").alias("remnantName"),
        F.col("Length").alias("length"),
        F.col("Width").alias("width"),
        F.col("Area").alias("area"),
    )


def _feedback_heads(st_prg_arc: DataFrame, stock: DataFrame) -> DataFrame:
    rows = program_sheet_rows(st_prg_arc, stock)
    return rows.select(
        "AutoID",
        "ArchivePacketID",
        codes.decode_state(F.col("TransType")).alias("state"),
        "ProgramName",
        "RepeatID",
        "MachineName",
        "CuttingTime",
        "SheetName",
        "MaterialMaster",
    ).where(F.col("state").isNotNull())


def feedback_documents(
    st_prg_arc: DataFrame,
    stock: DataFrame,
    st_pip_arc: DataFrame,
    part: DataFrame,
    remnant: DataFrame,
    page_size: int | None = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """One row per outbox program with its sheet (and per page of its
    children): ``AutoID, ArchivePacketID, state, page, nest`` where ``nest``
    is the document for created programs and NULL for the marker states
    (C6, J13, A7, P13).

    The per-program lookups of the original (two round trips per created
    program) become two child tables keyed by packet id, grouped into sorted
    arrays and attached by joins; children are optional (empty arrays).
    Remnants are keyed by (program, repeat) and reach the packet through the
    heads.  Unknown codes are dropped (D8).
    """
    heads = _feedback_heads(st_prg_arc, stock)
    packets = heads.where(F.col("state") == "created").select("ArchivePacketID")
    # Only the children of created packets are joined and grouped at all.
    parts = _created_parts(st_pip_arc.join(packets, "ArchivePacketID", "left_semi"), part)
    return _documents(heads, parts, _remnant_rows(remnant), page_size)


def child_tables(st_pip_arc: DataFrame, part: DataFrame, remnant: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The children of all documents: parts, by ArchivePacketID, and remnants, by
    (ProgramName, RepeatID).  They do not depend on the outbox, so they can be
    stored once, bucketed by these keys."""
    return _created_parts(st_pip_arc, part), _remnant_rows(remnant)


def documents_of_children(st_prg_arc: DataFrame, stock: DataFrame, parts: DataFrame, remnants: DataFrame, page_size: int | None = DEFAULT_PAGE_SIZE) -> DataFrame:
    """:func:`feedback_documents` from the tables of :func:`child_tables`."""
    heads = _feedback_heads(st_prg_arc, stock)
    packets = heads.where(F.col("state") == "created").select("ArchivePacketID")
    return _documents(heads, parts.join(packets, "ArchivePacketID", "left_semi"), remnants, page_size)


def _documents(heads: DataFrame, parts: DataFrame, remnants: DataFrame, page_size: int | None) -> DataFrame:
    created = heads.where(F.col("state") == "created")
    # An outbox that delivers at least once may hold a packet twice.
    owners = created.select("ArchivePacketID", "ProgramName", "RepeatID").distinct()
    rems = remnants.join(owners, ["ProgramName", "RepeatID"], "inner")
    j = attach_children(
        created,
        ["ArchivePacketID"],
        [(parts, PART_FIELDS, "parts", ["AutoID"]), (rems.drop("ProgramName", "RepeatID"), REMNANT_FIELDS, "remnants", REMNANT_FIELDS)],
        page_size,
    )
    nest = F.struct(
        F.col("ArchivePacketID").alias("archivePacketId"),
        F.struct(
            F.col("ProgramName").alias("programName"),
            F.col("RepeatID").alias("repeatId"),
            F.col("MachineName").alias("machineName"),
            F.col("CuttingTime").alias("cuttingTime"),
        ).alias("program"),
        F.col("parts"),
        F.struct(
            F.coalesce(F.col("SheetName"), F.lit("")).alias("sheetName"),
            F.coalesce(F.col("MaterialMaster"), F.lit("")).alias("materialMaster"),
        ).alias("sheet"),
        F.col("remnants"),
    )
    documents = j.select("AutoID", "ArchivePacketID", "state", "page", nest.alias("nest"))
    markers = heads.where(F.col("state") != "created").select(
        "AutoID", "ArchivePacketID", "state", F.lit(0).cast("long").alias("page"), F.lit(None).cast(documents.schema["nest"].dataType).alias("nest")
    )
    return documents.unionByName(markers)


def feedback_document_rows(documents: DataFrame) -> DataFrame:
    """The documents, one row per child: kind ``part``, ``remnant`` or, for
    documents without children and for markers, ``none``."""
    part = F.transform("nest.parts", lambda x: F.struct(
        F.lit("part").alias("kind"), x["partName"].alias("name"), x["partQty"].cast("double").alias("n1"), x["job"].alias("job"),
        x["shipment"].alias("shipment"), x["trueArea"].alias("n2"), x["nestedArea"].alias("n3")))
    remnant = F.transform("nest.remnants", lambda x: F.struct(
        F.lit("remnant").alias("kind"), x["remnantName"].alias("name"), x["length"].alias("n1"), F.lit(None).cast("string").alias("job"),
        F.lit(None).cast("int").alias("shipment"), x["width"].alias("n2"), x["area"].alias("n3")))
    rows = documents.select(
        "AutoID", "ArchivePacketID", "state", "page", F.col("nest.program.programName").alias("ProgramName"), F.col("nest.program.repeatId").alias("RepeatID"),
        F.col("nest.program.machineName").alias("MachineName"), F.col("nest.program.cuttingTime").alias("CuttingTime"),
        F.col("nest.sheet.sheetName").alias("SheetName"), F.col("nest.sheet.materialMaster").alias("MaterialMaster"),
        F.explode_outer(F.concat(part, remnant)).alias("c"),
    )
    return rows.select(*[c for c in rows.columns if c != "c"], "c.*").withColumn("kind", F.coalesce("kind", F.lit("none")))


def feedback_summary(
    st_prg_arc: DataFrame,
    stock: DataFrame,
    st_pip_arc: DataFrame,
    part: DataFrame,
    remnant: DataFrame,
) -> DataFrame:
    """Order-independent digest of :func:`feedback_documents` (for audits and
    the SQL oracle): head fields plus child counts and exact sums.  Only
    partial aggregates, so a program holding a third of all parts is reduced
    map-side before the shuffle."""
    heads = _feedback_heads(st_prg_arc, stock)
    parts = child_summary(
        _created_parts(st_pip_arc, part), ["ArchivePacketID"], "parts", ["trueArea", "nestedArea"], "partName",
        int_sums=["partQty"],
    )
    rems = child_summary(_remnant_rows(remnant), ["ProgramName", "RepeatID"], "remnants", ["area"])
    j = heads.join(parts, "ArchivePacketID", "left").join(rems, ["ProgramName", "RepeatID"], "left")
    created = F.col("state") == "created"

    def only_created(c, default=None):
        v = F.col(c) if default is None else F.coalesce(F.col(c), F.lit(default))
        return F.when(created, v)

    return j.select(
        "ArchivePacketID",
        "state",
        only_created("ProgramName").alias("ProgramName"),
        only_created("RepeatID").alias("RepeatID"),
        only_created("SheetName").alias("SheetName"),
        only_created("MaterialMaster").alias("MaterialMaster"),
        only_created("parts_n", 0).alias("parts_n"),
        only_created("parts_partQty", 0).alias("parts_qty"),
        only_created("parts_trueArea", 0.0).alias("parts_true_area"),
        only_created("parts_nestedArea", 0.0).alias("parts_nested_area"),
        only_created("parts_min_partName").alias("parts_first"),
        only_created("parts_max_partName").alias("parts_last"),
        only_created("remnants_n", 0).alias("remnants_n"),
        only_created("remnants_area", 0.0).alias("remnants_area"),
    )


def export_order(docs: DataFrame) -> DataFrame:
    """Boundary ordering of the export: newest outbox row first."""
    return docs.orderBy(F.desc("AutoID"))
