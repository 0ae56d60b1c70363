"""At-least-once outbox export.

New outbox rows arrive as a file stream.  Each micro-batch writes the
documents of its rows, then the ids it consumed (the ack); both folders are
keyed by the batch id and overwritten on replay, so a batch that is re-run
after a failure writes the same files.  Consumed rows are removed from the
outbox by an anti join with the acks (J15), e.g. during compaction.

The children of the documents are far more than a micro-batch asks for.  They
are stored once as tables bucketed by the keys of the documents' joins, so a
micro-batch shuffles its own rows to the buckets and the children not at all.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.changelog import ack
from ..plans.feedback import child_tables, documents_of_children
from .intake import start_batches

PART_KEYS = ["ArchivePacketID"]
REMNANT_KEYS = ["ProgramName", "RepeatID"]


@dataclass
class Children:
    """Names of the bucketed tables; ``buckets``: as many as a shuffle's partitions."""

    spark: SparkSession
    parts: str
    remnants: str

    def tables(self) -> tuple[DataFrame, DataFrame]:
        return self.spark.table(self.parts), self.spark.table(self.remnants)

    def forget(self) -> None:
        """Take the tables out of the catalog; their files stay under the root."""
        for name in (self.parts, self.remnants):
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def store_children(spark: SparkSession, root: str, st_pip_arc: DataFrame, part: DataFrame, remnant: DataFrame, buckets: int | None = None) -> Children:
    """Write the children of all documents, bucketed, one file a bucket."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = []
    for kind, rows, keys in zip(("parts", "remnants"), child_tables(st_pip_arc, part, remnant), (PART_KEYS, REMNANT_KEYS)):
        names.append(f"platehub_{kind}_{uuid.uuid4().hex[:12]}")
        writer = rows.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
        writer.option("path", f"{root}/children/{kind}").saveAsTable(names[-1])
    return Children(spark, *names)


def export_batches(root: str, stock: DataFrame, children: Children):
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for the documents and for the acks
        try:
            docs = documents_of_children(batch, stock, *children.tables())
            docs.write.mode("overwrite").json(f"{root}/docs/batch={batch_id}")
            batch.select("AutoID").write.mode("overwrite").parquet(f"{root}/acks/batch={batch_id}")
        finally:
            batch.unpersist()

    return run


def start_outbox_export(outbox_stream: DataFrame, root: str, stock: DataFrame, children: Children, trigger: dict | None = None):
    return start_batches(outbox_stream, export_batches(root, stock, children), f"{root}/_checkpoint", trigger)


def compact_outbox(spark: SparkSession, outbox: DataFrame, root: str) -> DataFrame:
    """Outbox rows not yet acknowledged."""
    return ack(outbox, spark.read.parquet(f"{root}/acks"), "AutoID")
