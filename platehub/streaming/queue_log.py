"""The staged-transaction queue as an append-only log.

``<root>/log/batch=<id>`` holds what one micro-batch staged; batch -1 is the queue
that was there before.  A micro-batch writes its own folder once and reads of the
earlier ones only the event ids for its gate; overwriting that folder on a replay
writes the same rows.  Nothing is listed, rewritten or deleted: Spark discovers the
``batch`` partitions, and batches that a replay has not finished are pruned away.

The current queue is derived: a row stays unless a later add has its key, where
later means a larger (batch, ordinal).  The last add of a key is a partial
aggregate.  ``compact`` is a plain job that writes the current queue as batch -1 of
a new log, for the stream to go on with.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import survivors_after_later_writes
from ..plans.queue import QUEUE_COLUMNS, conform

#: What a log row is: staged before the log, by a removal, by an add; or only the
#: mark of an event whose rows a compaction left out, so that its gate stays shut.
BASE, REMOVAL, ADD, SEEN = "base", "removal", "add", "seen"
FIRST = -1
EVENT_COLUMNS = ("ItemData18", "BinNumber")

LOG_COLUMNS = {"kind": "string", **QUEUE_COLUMNS}


class QueueLog:
    """``keys``: columns by which a later add supersedes a row."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str]):
        self.spark, self.root, self.keys = spark, root, keys

    def start(self, queue: DataFrame) -> QueueLog:
        """A log that begins with the rows of ``queue``."""
        self._write(FIRST, conform(queue).withColumn("kind", F.lit(BASE)))
        return self

    def append(self, batch: int, removals: DataFrame, adds: DataFrame) -> None:
        """The one write of a micro-batch."""
        self._write(batch, conform(removals).withColumn("kind", F.lit(REMOVAL)).unionByName(conform(adds).withColumn("kind", F.lit(ADD))))

    def rows(self, before: int | None = None) -> DataFrame:
        """All rows of the batches ``before`` one, superseded ones included."""
        schema = ", ".join(f"{c} {t}" for c, t in LOG_COLUMNS.items())
        log = self.spark.read.schema(f"{schema}, batch long").parquet(f"{self.root}/log")
        return log if before is None else log.where(F.col("batch") < before)

    def current(self, before: int | None = None) -> DataFrame:
        """The queue: rows that no later add supersedes."""
        rows = self.rows(before).where(F.col("kind") != SEEN).withColumn("__at", F.struct("batch", "Ordinal"))
        kept = survivors_after_later_writes(rows, rows.where(F.col("kind") == ADD), self.keys, "__at")
        return kept.select(*QUEUE_COLUMNS)

    def compact(self, root: str) -> QueueLog:
        """A new log under ``root`` that begins with the current queue and marks
        of the events that it no longer holds."""
        queue = self.current()
        held = [queue.select(F.col(c).alias("event")).where("event is not null") for c in EVENT_COLUMNS]
        seen = self.rows().select(F.explode(F.array(*EVENT_COLUMNS)).alias("event")).where("event is not null").distinct()
        for column in held:
            seen = seen.join(column, "event", "left_anti")
        marks = conform(seen.select(F.col("event").alias("ItemData18"))).withColumn("kind", F.lit(SEEN))
        out = QueueLog(self.spark, root, self.keys)
        out._write(FIRST, queue.withColumn("kind", F.lit(BASE)).unionByName(marks))
        return out

    def _write(self, batch: int, rows: DataFrame) -> None:
        rows.select(*LOG_COLUMNS).write.mode("overwrite").parquet(f"{self.root}/log/batch={batch}")


def stage_changes(log: QueueLog, changes: Callable[..., tuple[DataFrame, DataFrame]], **tables) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: what the calls of a micro-batch stage, appended to
    the log.  ``changes`` gives (removals, adds) of a batch against ``trans_act``."""

    def run(batch: DataFrame, batch_id: int) -> None:
        calls = batch.persist(StorageLevel.MEMORY_AND_DISK)  # read for the gate, the removals and the adds
        try:
            log.append(batch_id, *changes(calls, trans_act=log.rows(batch_id), **tables))
        finally:
            calls.unpersist()

    return run
