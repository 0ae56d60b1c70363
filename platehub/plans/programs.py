"""Program jobs: open programs per machine (C8), machine list (C9), program
completion (C11) and program update by packet id (C12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions.text import trans_id
from ..operators.dedup import last_per_key
from ..operators.joins import bounded_broadcast, not_exists
from ..operators.ranking import DEFAULT_MAX_ROWS_PER_TASK, row_number_within

# The ERP config table has one row per ERP system: a handful of rows.
CONFIG_MAX_ROWS = 10_000


def open_programs(
    program_machine: DataFrame,
    program: DataFrame,
    trans_act: DataFrame,
    machine: str | None = None,
) -> DataFrame:
    """Programs with at least one repeat that has no staged SN70, per machine.

    ``machine=None`` lists every machine (the scale form); otherwise the
    filter is pushed into the ProgramMachine scan.  Output:
    MachineName, ProgramName, CuttingTime, Repeats.
    """
    staged = trans_act.where(F.col("TransType") == codes.PROGRAM_COMPLETE)
    open_rows = not_exists(
        program.select("ProgramName", "RepeatID"),
        staged,
        [("ProgramName", "ProgramName"), ("RepeatID", "ProgramRepeat")],
    )
    repeats = open_rows.groupBy("ProgramName").agg(F.count("RepeatID").alias("Repeats"))
    pm = program_machine
    if machine is not None:
        pm = pm.where(F.col("MachineName") == machine)
    return (
        pm.join(repeats.where(F.col("Repeats") > 0), "ProgramName", "inner")
        .select("MachineName", "ProgramName", "CuttingTime", F.col("Repeats").cast("int").alias("Repeats"))
        .distinct()
    )


def machine_list(program_machine: DataFrame) -> DataFrame:
    """Distinct machine names; a NULL name is shown as '' (C9)."""
    return program_machine.select(F.coalesce(F.col("MachineName"), F.lit("")).alias("MachineName")).distinct()


def latest_program_state(state_events: DataFrame, order_col: str = "post_seq") -> DataFrame:
    """Latest posted state per program (batch twin of the streaming state
    machine, T4): ``program, batch, state``."""
    return last_per_key(state_events.select("program", order_col, "batch", "state"), ["program"], [order_col]).drop(
        order_col
    )


def stage_completion(
    state_events: DataFrame,
    program: DataFrame,
    trans_act: DataFrame,
    order_col: str = "post_seq",
    max_rows_per_task: int = DEFAULT_MAX_ROWS_PER_TASK,
    literal: bool = False,
) -> DataFrame:
    """SN70 rows for programs posted ``Complete`` (C11).

    ``literal``: the original insert is not valid SQL as written, its error
    is only logged, so nothing is staged (D4).

    Intended rule (D4): the k-th Complete post of a program completes its
    k-th lowest repeat that has no staged SN70 yet; extra posts find no open
    repeat and stage nothing.  Both sides are ranked per program with the
    skew-safe ``row_number_within`` (a hot program is split over many
    tasks) and matched by an equi-join on (program, rank).
    """
    completes = state_events.where(F.col("state") == "Complete").select(
        F.col("program").alias("ProgramName"), order_col
    )
    staged = trans_act.where(F.col("TransType") == codes.PROGRAM_COMPLETE)
    open_rep = not_exists(
        program.select("ProgramName", "RepeatID").where(F.col("RepeatID").isNotNull()).distinct(),
        staged,
        [("ProgramName", "ProgramName"), ("RepeatID", "ProgramRepeat")],
    )
    if literal:
        return completes.limit(0).select(
            F.lit(codes.PROGRAM_COMPLETE).alias("TransType"),
            F.lit(1).cast("int").alias("District"),
            "ProgramName",
            F.lit(None).cast("long").alias("ProgramRepeat"),
        )
    k_post = row_number_within(completes, ["ProgramName"], order_col, "k", max_rows_per_task)
    k_rep = row_number_within(open_rep, ["ProgramName"], "RepeatID", "k", max_rows_per_task)
    return k_post.join(k_rep, ["ProgramName", "k"], "inner").select(
        F.lit(codes.PROGRAM_COMPLETE).alias("TransType"),
        F.lit(1).cast("int").alias("District"),
        "ProgramName",
        F.col("RepeatID").alias("ProgramRepeat"),
    )


def stage_program_update(events: DataFrame, program: DataFrame, config: DataFrame) -> DataFrame:
    """SN76 per program row with the event's packet id.

    An event whose ERP system has no config row stages nothing (the
    original's cross join with an empty config).  Config is broadcast only
    after its row count is checked.
    """
    cfg = config.groupBy("SapSystem").agg(F.min("SimTransDistrict").alias("District"))
    cfg = bounded_broadcast(cfg, CONFIG_MAX_ROWS)
    ev = events.join(cfg, events["sap_system"] == cfg["SapSystem"], "inner")
    prg = program.select("ArchivePacketID", "ProgramName", "RepeatID")
    j = ev.join(prg, ev["archive_packet_id"] == prg["ArchivePacketID"], "inner")
    return j.select(
        F.lit(codes.PROGRAM_UPDATE).alias("TransType"),
        F.col("District").cast("int").alias("District"),
        trans_id(F.col("sap_event_id")).alias("TransID"),
        "ProgramName",
        F.col("RepeatID").alias("ProgramRepeat"),
    )
