"""Nest documents for programs (C7) and batch matching."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import shipment_int
from ..operators.dedup import first_per_key, last_per_key
from ..operators.documents import DEFAULT_PAGE_SIZE, attach_children, exact_sum

NEST_PART_FIELDS = ["partName", "partQty", "job", "shipment", "trueArea", "nestedArea"]
NEST_REMNANT_FIELDS = ["remnantName", "length", "width", "area", "weight", "primeCode", "qty"]


def _program_heads(program: DataFrame) -> DataFrame:
    """First program row per name (L3; D5: lowest repeat, then packet id)."""
    return first_per_key(
        program.select("ProgramName", "RepeatID", "ArchivePacketID", "MachineName", "CuttingTime"),
        ["ProgramName"],
        ["RepeatID", "ArchivePacketID"],
    )


def program_sheet(program: DataFrame, stock: DataFrame) -> DataFrame:
    """The sheet of each program (J7): distinct Stock rows whose sheet is
    used by the program, the last one kept (L3; D5: largest name)."""
    used = program.select("ProgramName", "SheetName").distinct()
    rows = used.join(stock.select("SheetName", "PrimeCode"), "SheetName", "inner").distinct()
    return last_per_key(rows, ["ProgramName"], ["SheetName", "PrimeCode"]).select(
        "ProgramName",
        F.coalesce(F.col("SheetName"), F.lit("")).alias("sheetName"),
        F.coalesce(F.col("PrimeCode"), F.lit("")).alias("materialMaster"),
    )


def nest_parts(pip: DataFrame, part: DataFrame, literal: bool = False) -> DataFrame:
    """Distinct parts of each program (J3).  ``literal`` joins on the part
    name only, so a part in several work orders fans out (D6)."""
    keys = ["PartName"] if literal else ["PartName", "WONumber"]
    prt = part.select("PartName", "WONumber", "Data1", "Data2")
    if literal:
        prt = prt.withColumnRenamed("WONumber", "__wo_part")
    j = pip.join(prt, keys, "inner").select(
        "ProgramName", "WONumber", "PartName", "QtyInProcess", "Data1", "Data2", "TrueArea", "NestedArea"
    ).distinct()  # of the raw values: texts that default to the same value stay apart
    return j.select(
        "ProgramName",
        "WONumber",
        F.coalesce(F.col("PartName"), F.lit("")).alias("partName"),
        F.col("QtyInProcess").alias("partQty"),
        F.coalesce(F.col("Data1"), F.lit("")).alias("job"),
        shipment_int(F.col("Data2")).alias("shipment"),
        F.col("TrueArea").alias("trueArea"),
        F.col("NestedArea").alias("nestedArea"),
    )


def nest_remnants(remnant: DataFrame) -> DataFrame:
    return remnant.select(
        "ProgramName",
        F.col("RemnantName").alias("remnantName"),
        F.col("Length").alias("length"),
        F.col("Width").alias("width"),
        F.col("Area").alias("area"),
        F.col("Weight").alias("weight"),
        F.col("PrimeCode").alias("primeCode"),
        F.col("Qty").alias("qty"),
    ).distinct()


def nest_documents(
    program: DataFrame,
    pip: DataFrame,
    part: DataFrame,
    stock: DataFrame,
    remnant: DataFrame,
    program_name: str | None = None,
    literal: bool = False,
    page_size: int | None = DEFAULT_PAGE_SIZE,
) -> DataFrame:
    """Nest document per program (C7): ``page, archivePacketId, program,
    parts, sheet, remnants`` (one row per page of children; page 0 always
    exists).  Programs without a program row or without a sheet are absent
    (the original's NotFound).  ``program_name`` restricts to one program;
    the filter reaches every scan."""
    if program_name is not None:
        program = program.where(F.col("ProgramName") == program_name)
        pip = pip.where(F.col("ProgramName") == program_name)
        remnant = remnant.where(F.col("ProgramName") == program_name)
    heads = _program_heads(program).join(program_sheet(program, stock), "ProgramName", "inner")
    j = attach_children(
        heads,
        ["ProgramName"],
        [(nest_parts(pip, part, literal), NEST_PART_FIELDS, "parts", ["WONumber", *NEST_PART_FIELDS]),
         (nest_remnants(remnant), NEST_REMNANT_FIELDS, "remnants", NEST_REMNANT_FIELDS)],
        page_size,
    )
    return j.select(
        "page",
        F.col("ArchivePacketID").alias("archivePacketId"),
        F.struct(
            F.col("ProgramName").alias("programName"),
            F.col("RepeatID").alias("repeatId"),
            F.col("MachineName").alias("machineName"),
            F.col("CuttingTime").alias("cuttingTime"),
        ).alias("program"),
        "parts",
        F.struct("sheetName", "materialMaster").alias("sheet"),
        "remnants",
    )


def nest_document_rows(documents: DataFrame) -> DataFrame:
    """The documents, one row per child: kind ``part``, ``remnant`` or ``none``."""
    part = F.transform("parts", lambda x: F.struct(
        F.lit("part").alias("kind"), x["partName"].alias("name"), x["partQty"].cast("double").alias("n1"), x["job"].alias("text"),
        x["shipment"].alias("qty"), x["trueArea"].alias("n2"), x["nestedArea"].alias("n3"), F.lit(None).cast("double").alias("n4")))
    remnant = F.transform("remnants", lambda x: F.struct(
        F.lit("remnant").alias("kind"), x["remnantName"].alias("name"), x["length"].alias("n1"), x["primeCode"].alias("text"),
        x["qty"].alias("qty"), x["width"].alias("n2"), x["area"].alias("n3"), x["weight"].alias("n4")))
    rows = documents.select(
        "page", F.col("archivePacketId").alias("ArchivePacketID"), F.col("program.programName").alias("ProgramName"), F.col("program.repeatId").alias("RepeatID"),
        F.col("program.machineName").alias("MachineName"), F.col("program.cuttingTime").alias("CuttingTime"),
        F.col("sheet.sheetName").alias("SheetName"), F.col("sheet.materialMaster").alias("MaterialMaster"),
        F.explode_outer(F.concat(part, remnant)).alias("c"),
    )
    return rows.select(*[c for c in rows.columns if c != "c"], "c.*").withColumn("kind", F.coalesce("kind", F.lit("none")))


def nest_summary(program: DataFrame, pip: DataFrame, part: DataFrame, stock: DataFrame, remnant: DataFrame,
                 literal: bool = False) -> DataFrame:
    """Order-independent digest of :func:`nest_documents` (partial aggregates
    only; used by the SQL oracle)."""
    heads = _program_heads(program)
    sheet = program_sheet(program, stock)
    parts = nest_parts(pip, part, literal).groupBy("ProgramName").agg(
        F.count(F.lit(1)).alias("parts_n"),
        F.sum(F.col("partQty").cast("long")).alias("parts_qty"),
        exact_sum(F.col("trueArea")).alias("parts_true_area"),
        exact_sum(F.col("nestedArea") - F.col("trueArea")).alias("skeleton_area"),
    )
    rems = nest_remnants(remnant).groupBy("ProgramName").agg(
        F.count(F.lit(1)).alias("remnants_n"), exact_sum(F.col("area")).alias("remnants_area")
    )
    j = heads.join(sheet, "ProgramName", "inner").join(parts, "ProgramName", "left").join(rems, "ProgramName", "left")
    return j.select(
        "ProgramName",
        "RepeatID",
        "ArchivePacketID",
        "MachineName",
        "CuttingTime",
        F.col("sheetName").alias("SheetName"),
        F.col("materialMaster").alias("MaterialMaster"),
        F.coalesce("parts_n", F.lit(0)).alias("parts_n"),
        F.coalesce("parts_qty", F.lit(0)).alias("parts_qty"),
        F.coalesce("parts_true_area", F.lit(0.0)).alias("parts_true_area"),
        F.coalesce("skeleton_area", F.lit(0.0)).alias("skeleton_area"),
        F.coalesce("remnants_n", F.lit(0)).alias("remnants_n"),
        F.coalesce("remnants_area", F.lit(0.0)).alias("remnants_area"),
    )


# -- batches -----------------------------------------------------------------


def typed_batches(batches: DataFrame) -> DataFrame:
    """Batch rows with the Y/N flag decoded (S1); unknown codes fail."""
    return batches.select("id", "mm", "sheet_name", codes.batch_type(F.col("remnant")).alias("type"))


def batches_by_sheet(batches: DataFrame) -> DataFrame:
    """Batches grouped by sheet: first batch (smallest id) + count."""
    b = typed_batches(batches)
    return b.groupBy("sheet_name").agg(
        F.min_by(F.struct("id", "mm", "type"), "id").alias("first"), F.count(F.lit(1)).alias("batches")
    ).select("sheet_name", "first.id", "first.mm", "first.type", "batches")


def batches_for_programs(program: DataFrame, stock: DataFrame, batches: DataFrame) -> DataFrame:
    """Per program with a nest: its sheet, how many batches match the sheet
    and the default (first) batch (C10, J12, L4).

    The per-sheet side is aggregated before the join, so the output is one
    row per program and never pairs every program with every batch of a
    popular sheet; the batch list itself stays keyed by sheet
    (:func:`batches_by_sheet`) or is fetched for one program with
    :func:`program_batches`."""
    heads = _program_heads(program).select("ProgramName")
    sheet = program_sheet(program, stock)
    nests = heads.join(sheet, "ProgramName", "inner")
    per_sheet = batches_by_sheet(batches)
    j = nests.join(per_sheet, nests["sheetName"] == per_sheet["sheet_name"], "inner")
    return j.select(
        "ProgramName",
        "sheet_name",
        "batches",
        F.col("id").alias("default_batch"),
        F.col("type").alias("default_type"),
    )


def program_batches(program: DataFrame, stock: DataFrame, batches: DataFrame, program_name: str) -> DataFrame:
    """Batches matching the sheet of one program (the original endpoint)."""
    sheet = program_sheet(program.where(F.col("ProgramName") == program_name), stock)
    b = typed_batches(batches)
    return b.join(sheet, b["sheet_name"] == sheet["sheetName"], "left_semi")


def default_machine(program_machine: DataFrame) -> DataFrame:
    """Default machine of the picker: the first name in order (L4)."""
    return program_machine.agg(F.min("MachineName").alias("MachineName"))
