"""Program posts as a stream (T4).

The latest state of a program is a stateful aggregate: the post of the largest
sequence number, whenever it arrives.  A micro-batch touches the state of its own
programs and writes their new rows, ``<root>/batch=<id>``; readers take the last
row of each program.

Every ``Complete`` post stages the completion of its program's lowest repeat that
is still open; no post is rejected.  A micro-batch looks only at the programs it
has posts of, and overwrites its own folder, so a replay writes the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import codes
from ..operators.dedup import last_per_key
from ..plans.programs import stage_completion
from .intake import start_batches, use_rocksdb

POST_ORDER = ["post_seq", "batch", "state"]


def latest_states(posts: DataFrame) -> DataFrame:
    """The stream of program, post_seq, batch, state: the last post of each program."""
    return posts.groupBy("program").agg(F.max(F.struct(*POST_ORDER)).alias("last")).select("program", "last.*")


def start_latest_state(posts: DataFrame, out: str, checkpoint: str, trigger: dict | None = None):
    """Write the programs whose state a micro-batch changes."""
    use_rocksdb(posts.sparkSession)

    def write(changed: DataFrame, batch_id: int) -> None:
        # The partition column is named apart from the posts' own ``batch``.
        changed.write.mode("overwrite").parquet(f"{out}/step={batch_id}")

    return start_batches(latest_states(posts), write, checkpoint, trigger, "update")


def read_latest_state(spark: SparkSession, out: str) -> DataFrame:
    """program, post_seq, batch, state of each program."""
    return last_per_key(spark.read.parquet(out).select("program", *POST_ORDER), ["program"], POST_ORDER)


class StagedCompletions:
    """Completions staged so far: ``<root>/batch=<id>`` of micro-batches; -1 holds
    those of the queue before."""

    SCHEMA = "TransType string, District int, ProgramName string, ProgramRepeat long, batch long"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def start(self, trans_act: DataFrame) -> StagedCompletions:
        done = trans_act.where(F.col("TransType") == codes.PROGRAM_COMPLETE)
        self.write(-1, done.select("TransType", F.lit(None).cast("int").alias("District"), "ProgramName", F.col("ProgramRepeat").cast("long").alias("ProgramRepeat")))
        return self

    def write(self, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/batch={batch}")

    def all(self, before: int | None = None) -> DataFrame:
        rows = self.spark.read.schema(self.SCHEMA).parquet(self.root)
        return rows if before is None else rows.where(F.col("batch") < before)

    def rows(self) -> DataFrame:
        """What the stream staged."""
        return self.all().where("batch >= 0").drop("batch")


def stage_batches(store: StagedCompletions, program: DataFrame) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: completions of the batch's Complete posts, on
    top of all that is staged already.  The repeats of a program that get
    completed do not depend on how posts are cut into batches."""

    def run(batch: DataFrame, batch_id: int) -> None:
        posts = batch.where(F.col("state") == "Complete").persist()
        try:
            touched = posts.select(F.col("program").alias("ProgramName"))
            repeats = program.select("ProgramName", "RepeatID").join(touched, "ProgramName", "left_semi")
            out = stage_completion(posts, repeats, store.all(batch_id))
            store.write(batch_id, out.select("TransType", "District", "ProgramName", F.col("ProgramRepeat").cast("long").alias("ProgramRepeat")))
        finally:
            posts.unpersist()

    return run
