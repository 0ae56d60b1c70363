"""Runnable streaming jobs over the proxy tables.

Each job lands its input in a fresh folder under the shared checkpoint location
and lets it arrive in several drops.  For each drop the streaming query is started
with ``trigger(availableNow=True)`` on the checkpoint of the one before, so it
also restarts between micro-batches.  The sink, read back, is the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.feedback import feedback_document_rows
from ..plans.reconcile import DEMAND_KEYS, INVENTORY_KEYS, demand_changes, inventory_changes
from ..sources.views import Views
from .intake import (
    DEMAND_CALL_SCHEMA,
    INVENTORY_CALL_SCHEMA,
    call_stream,
    json_array_calls,
    scratch_dir,
    start_batches,
    start_gate,
)
from .outbox import compact_outbox, start_outbox_export, store_children
from .program_state import StagedCompletions, read_latest_state, stage_batches, start_latest_state
from .program_update import POST_SCHEMA as UPDATE_SCHEMA
from .program_update import PROGRAM_SCHEMA, UpdateStore, posts_and_programs, stage_updates
from .queue_log import QueueLog, stage_changes

POST_SCHEMA = "post_seq long, program string, batch string, state string"
#: Micro-batches of a job's input.
DROPS = 3


class Arrivals:
    """Rows of a producer: written once, by all tasks, into a folder for each value
    0, 1, ... of ``drop``; a folder arrives by its renaming into the one that the
    stream watches, as producers publish files."""

    def __init__(self, rows: DataFrame, root: str, drop: Column, fmt: str = "parquet"):
        self.spark, self.root, self.fmt = rows.sparkSession, root, fmt
        rows.withColumn("__drop", drop).write.partitionBy("__drop").format(fmt).save(f"{root}/staged")

    def arrive(self, k: int) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        staged, arrived = path(f"{self.root}/staged/__drop={k}"), path(f"{self.root}/arrived/{k}")
        fs = staged.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        fs.mkdirs(arrived.getParent())
        if fs.exists(staged) and not fs.rename(staged, arrived):
            raise OSError(f"could not publish {staged}")

    def stream(self, schema) -> DataFrame:
        return call_stream(self.spark, f"{self.root}/arrived/*", schema, self.fmt)


def in_drops(arrivals: list[Arrivals], start: Callable[[], object], drops: int = DROPS) -> None:
    """One run of the query for each drop."""
    for k in range(drops):
        for a in arrivals:
            a.arrive(k)
        start().awaitTermination()


def stored(spark: SparkSession, root: str, **tables: DataFrame) -> dict[str, DataFrame]:
    """The tables that every micro-batch looks up, written once: here they are views
    over other tables, which each batch would compute anew."""
    for name, rows in tables.items():
        rows.write.parquet(f"{root}/tables/{name}")
    return {name: spark.read.schema(rows.schema).parquet(f"{root}/tables/{name}") for name, rows in tables.items()}


def in_order(column: str, df: DataFrame) -> Column:
    """Drops by the order of a column, cut at its approximate quantiles."""
    cuts = df.agg(F.percentile_approx(column, [k / DROPS for k in range(1, DROPS)])).first()[0] or []
    drop = F.lit(0)
    for cut in cuts:
        drop = drop + (F.col(column) > cut).cast("int")
    return drop


def stream_demand_intake(spark: SparkSession, v: Views) -> DataFrame:
    root = scratch_dir(spark, "demand-intake")
    calls = v.demand_events.select(*DEMAND_CALL_SCHEMA.fieldNames())
    arrivals = Arrivals(calls, f"{root}/calls", in_order("seq", calls))
    log = QueueLog(spark, f"{root}/queue", DEMAND_KEYS).start(v.trans_act)
    tables = stored(
        spark, root, part=v.part_wo.select("PartName", "WONumber", "QtyCompleted", "Data18"), pip=v.pip.select("PartName", "WONumber", "QtyInProcess"),
        slab_part_alloc=v.slab_part_alloc.select("PartName", "WoNumber", "Qty"),
    )
    step = stage_changes(log, demand_changes, config=v.config, **tables)
    in_drops([arrivals], lambda: start_batches(arrivals.stream(DEMAND_CALL_SCHEMA), step, f"{root}/_checkpoint"))
    return log.current()


def posted_arrays(calls: DataFrame) -> DataFrame:
    """Each event's calls as a JSON array.  An event has a bounded number of calls:
    they came in one request.  They are dealt out first: lists are no smaller than
    their calls, and the tasks that scan would hold them."""
    arrays = F.to_json(F.collect_list(F.struct(*calls.columns))).alias("value")
    return calls.repartition("sap_event_id").groupBy("sap_event_id").agg(F.min("seq").alias("seq"), arrays)


def stream_inventory_intake(spark: SparkSession, v: Views) -> DataFrame:
    """Calls arrive as posted JSON arrays, one line for all calls of an event."""
    root = scratch_dir(spark, "inventory-intake")
    calls = v.inventory_events.select(*INVENTORY_CALL_SCHEMA.fieldNames())
    posts = posted_arrays(calls)
    drop = in_order("seq", calls)
    arrivals = Arrivals(posts.where("value is not null").select("value", drop.alias("n")), f"{root}/posts", F.col("n"), "json")
    log = QueueLog(spark, f"{root}/queue", INVENTORY_KEYS).start(v.trans_act)
    step = stage_changes(log, inventory_changes, stock=v.stock, slab_sheet_alloc=v.slab_sheet_alloc, config=v.config)
    in_drops([arrivals], lambda: start_batches(json_array_calls(arrivals.stream("value string"), INVENTORY_CALL_SCHEMA), step, f"{root}/_checkpoint"))
    return log.current()


def stream_event_gate(spark: SparkSession, v: Views) -> DataFrame:
    """The calls of an event arrive in different batches, and not in order."""
    root = scratch_dir(spark, "event-gate")
    arrivals = Arrivals(v.demand_events.select(*DEMAND_CALL_SCHEMA.fieldNames()), f"{root}/calls", F.pmod(F.col("seq"), F.lit(DROPS)))
    in_drops([arrivals], lambda: start_gate(arrivals.stream(DEMAND_CALL_SCHEMA), f"{root}/passed", f"{root}/_checkpoint"))
    return spark.read.schema(DEMAND_CALL_SCHEMA).parquet(f"{root}/passed")


def _posts(spark: SparkSession, v: Views, root: str) -> Arrivals:
    posts = v.program_state_events.select("post_seq", "program", "batch", "state")
    return Arrivals(posts, f"{root}/posts", F.pmod(F.xxhash64("post_seq"), F.lit(DROPS)))


def stream_program_state(spark: SparkSession, v: Views) -> DataFrame:
    """The latest state of each program; posts arrive out of order."""
    root = scratch_dir(spark, "program-state")
    posts = _posts(spark, v, root)
    in_drops([posts], lambda: start_latest_state(posts.stream(POST_SCHEMA), f"{root}/latest", f"{root}/_checkpoint"))
    return read_latest_state(spark, f"{root}/latest").select("program", "batch", "state")


def stream_program_complete(spark: SparkSession, v: Views) -> DataFrame:
    """Completions staged by the posts, whatever the cut into batches."""
    root = scratch_dir(spark, "program-complete")
    posts = _posts(spark, v, root)
    store = StagedCompletions(spark, f"{root}/staged").start(v.trans_act)
    step = stage_batches(store, v.program)
    in_drops([posts], lambda: start_batches(posts.stream(POST_SCHEMA), step, f"{root}/_checkpoint"))
    return store.rows()


def stream_program_update(spark: SparkSession, v: Views) -> DataFrame:
    """SN76 rows staged by the posts; a third of the programs is there at the start,
    the others arrive in drops of their own, before or after their posts."""
    root = scratch_dir(spark, "program-update")
    posts = v.program_update_events.select("seq", "sap_system", "sap_event_id", "archive_packet_id")
    programs = v.program.select("ArchivePacketID", "ProgramName", F.col("RepeatID").cast("long").alias("RepeatID"))
    turn = F.pmod(F.xxhash64("ArchivePacketID"), F.lit(DROPS))
    store = UpdateStore(spark, f"{root}/store").start(programs.where(turn == 0))
    sent = Arrivals(posts, f"{root}/posts", F.pmod(F.col("seq"), F.lit(DROPS)))
    late = Arrivals(programs.where(turn > 0), f"{root}/programs", turn)

    def start():
        both = posts_and_programs(sent.stream(UPDATE_SCHEMA), late.stream(PROGRAM_SCHEMA))
        return start_batches(both, stage_updates(store, v.config), f"{root}/_checkpoint")

    in_drops([sent, late], start)
    return store.staged()


OUTBOX_SCHEMA = (
    "AutoID long, ArchivePacketID long, TransType string, ProgramName string, RepeatID long, "
    "MachineName string, CuttingTime double, SheetName string"
)


def stream_outbox_export(spark: SparkSession, v: Views) -> DataFrame:
    """The exported documents, read back, one row per child; acknowledged rows
    have left the outbox, so any that are still there would be added as ``left``."""
    from ..plans.feedback import feedback_documents

    root = scratch_dir(spark, "outbox")
    arrivals = Arrivals(v.st_prg_arc, f"{root}/outbox", F.pmod(F.col("AutoID"), F.lit(DROPS)))
    children = store_children(spark, root, v.st_pip_arc, v.part_wo, v.remnant)
    try:
        in_drops([arrivals], lambda: start_outbox_export(arrivals.stream(OUTBOX_SCHEMA), root, v.stock, children))
    finally:
        children.forget()
    schema = feedback_documents(v.st_prg_arc, v.stock, v.st_pip_arc, v.part_wo, v.remnant).schema
    rows = feedback_document_rows(spark.read.schema(schema).json(f"{root}/docs"))
    left = compact_outbox(spark, v.st_prg_arc, root).select("AutoID", "ArchivePacketID", F.lit("left").alias("state"))
    return rows.unionByName(left, allowMissingColumns=True)
