"""Program updates as a stream.

Posts name a packet; the program rows of a packet may arrive later than its post.
A micro-batch stages the posts whose program is known and writes the others as the
pending table; the next one tries them again, but only against the program rows
that have arrived since, as they matched none before.  A post is staged once, by all
rows its packet has at that time.  Posts of an unknown ERP system or without a packet
stage nothing, as in the batch job, and are not kept.

``<root>/program/batch=<id>``, ``staged/batch=<id>`` and ``pending/batch=<id>`` are each
written whole by their micro-batch, so a replay writes the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.programs import stage_program_update

POST_SCHEMA = "seq long, sap_system string, sap_event_id string, archive_packet_id long"
PROGRAM_SCHEMA = "ArchivePacketID long, ProgramName string, RepeatID long"
STAGED_SCHEMA = "TransType string, District int, TransID string, ProgramName string, ProgramRepeat long"


def posts_and_programs(posts: DataFrame, programs: DataFrame) -> DataFrame:
    """One stream of both, told apart by which struct is there."""
    post = F.struct(*posts.columns)
    program = F.struct(*programs.columns)
    none_post, none_program = F.lit(None).cast(f"struct<{_fields(POST_SCHEMA)}>"), F.lit(None).cast(f"struct<{_fields(PROGRAM_SCHEMA)}>")
    return posts.select(post.alias("post"), none_program.alias("program")).unionByName(programs.select(none_post.alias("post"), program.alias("program")))


def _fields(schema: str) -> str:
    return ", ".join(f.strip().replace(" ", ": ", 1) for f in schema.split(","))


class UpdateStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def start(self, programs: DataFrame) -> UpdateStore:
        """Begin with the program rows that are already there."""
        self.write("program", -1, programs.select("ArchivePacketID", "ProgramName", F.col("RepeatID").cast("long").alias("RepeatID")))
        self.write("pending", -1, self.spark.createDataFrame([], POST_SCHEMA))
        return self

    def write(self, table: str, batch: int, rows: DataFrame) -> None:
        rows.write.mode("overwrite").parquet(f"{self.root}/{table}/batch={batch}")

    def programs(self, before: int) -> DataFrame:
        return self.spark.read.schema(f"{PROGRAM_SCHEMA}, batch long").parquet(f"{self.root}/program").where(F.col("batch") < before).drop("batch")

    def pending(self, batch: int) -> DataFrame:
        """Posts that had no program after a micro-batch."""
        return self.spark.read.schema(POST_SCHEMA).parquet(f"{self.root}/pending/batch={batch}")

    def staged(self) -> DataFrame:
        return self.spark.read.schema(STAGED_SCHEMA).parquet(f"{self.root}/staged")


def stage_updates(store: UpdateStore, config: DataFrame) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function over :func:`posts_and_programs`."""
    systems = config.select(F.col("SapSystem").alias("sap_system"))

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # read for both kinds, and by three writes
        try:
            posts = batch.where("post.archive_packet_id is not null").select("post.*").join(systems, "sap_system", "left_semi")
            store.write("program", batch_id, batch.where("program is not null").select("program.*"))
            arrived = batch.where("program is not null").select("program.*")
            waiting = store.pending(batch_id - 1)
            # What waits matched no earlier row: it needs the new ones only.
            known = store.programs(batch_id + 1)
            found = stage_program_update(posts, known, config).unionByName(stage_program_update(waiting, arrived, config))
            store.write("staged", batch_id, found)
            still = posts.join(known, posts["archive_packet_id"] == known["ArchivePacketID"], "left_anti").unionByName(
                waiting.join(arrived, waiting["archive_packet_id"] == arrived["ArchivePacketID"], "left_anti"), allowMissingColumns=True
            )
            store.write("pending", batch_id, still.select("seq", "sap_system", "sap_event_id", "archive_packet_id"))
        finally:
            batch.unpersist()

    return run
