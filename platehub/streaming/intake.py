"""Structured Streaming twins of the event interfaces.

* T1 intake: ERP calls arrive as files; what each micro-batch stages is appended
  to the queue's log (``queue_log.py``) in its own folder, so a replayed batch
  writes the same, and the checkpoint records which batches are done.
* T3 once-per-event gate: a deduplication by event id whose state, one key for
  each event, is kept in Spark's state store (RocksDB, on the checkpoint's store).
  There is no watermark: no event is forgotten, and a micro-batch reads only the
  keys of its own events.
* T6 periodic refresh: the ``trigger`` argument (``processingTime``).
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

# Explicit schemas: never infer on a stream.
DEMAND_CALL_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("sap_event_id", T.StringType()),
        T.StructField("sap_system", T.StringType()),
        T.StructField("part_name", T.StringType()),
        T.StructField("work_order", T.StringType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("job", T.StringType()),
        *[T.StructField(c, T.StringType()) for c in ("matl", "state", "dwg", "codegen", "shipment", "chargeref", "op1", "op2", "op3", "mark", "raw_mm")],
        T.StructField("event_type", T.StringType()),
        T.StructField("ts", T.TimestampNTZType()),
    ]
)

INVENTORY_CALL_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("sap_event_id", T.StringType()),
        T.StructField("sap_system", T.StringType()),
        T.StructField("sheet_name", T.StringType()),
        T.StructField("sheet_type", T.StringType()),
        T.StructField("qty", T.IntegerType()),
        T.StructField("mm", T.StringType()),
        T.StructField("matl", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in ("thk", "wid", "len")],
        *[T.StructField(f"notes{k}", T.StringType()) for k in (1, 2, 3, 4)],
    ]
)


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location."""
    return os.path.join(checkpoint_dir(spark), "platehub", f"{name}-{uuid.uuid4().hex[:12]}")


def json_array_calls(raw: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """A POSTed JSON array of calls -> one row per call."""
    return raw.select(F.explode(F.from_json(F.col(value_col), T.ArrayType(schema))).alias("c")).select("c.*")


def json_object_calls(raw: DataFrame, schema: T.StructType, value_col: str = "value") -> DataFrame:
    """A single POSTed JSON object (program update) -> one row."""
    return raw.select(F.from_json(F.col(value_col), schema).alias("c")).select("c.*")


def call_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep the state of streams in RocksDB: on local disk and in the checkpoint,
    not on the executors' heaps."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def start_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None = None, mode: str = "append"):
    """Start a ``foreachBatch`` query; ``trigger`` defaults to availableNow (T6:
    pass ``{"processingTime": "5 minutes"}`` for the periodic refresh)."""
    writer = stream.writeStream.outputMode(mode).foreachBatch(each).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def lowest_per_key(key: str, order: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``mapInArrow`` function: of each key the partition's row of the lowest
    ``order``; rows without a key are left out.  It holds one row for each key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows.filter(pc.is_valid(rows[key]))
            best = pa.concat_tables([best, rows]) if best is not None else rows
            best = best.sort_by([(key, "ascending"), (order, "ascending")]).combine_chunks()
            if best.num_rows > 1:
                again = pc.equal(best[key][1:], best[key][:-1]).combine_chunks()
                best = best.filter(pc.invert(pa.concat_arrays([pa.array([False]), again])))
        if best is not None:
            yield from best.to_batches()

    return run


def gated_calls(calls: DataFrame, event: str = "sap_event_id", order: str = "seq") -> DataFrame:
    """The stream of the calls that pass the once-per-event gate (T3): of an event
    that no earlier micro-batch held, the call of the lowest ``order`` in its
    micro-batch.  Late calls of a new event pass, however late; calls without an
    event never do.  A hot event is one row for each task before the shuffle.
    """
    pick = lowest_per_key(event, order)
    firsts = calls.mapInArrow(pick, calls.schema).repartition(event).mapInArrow(pick, calls.schema)
    return firsts.dropDuplicates([event])


def start_gate(calls: DataFrame, out: str, checkpoint: str, trigger: dict | None = None, event: str = "sap_event_id", order: str = "seq"):
    """Append the calls that pass to the Parquet files of ``out``, each once."""
    use_rocksdb(calls.sparkSession)
    writer = gated_calls(calls, event, order).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
