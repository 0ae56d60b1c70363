"""Sinks: document export (K2), bulk insert (K3, K4) and full overlay (K5).

All writes are single Spark jobs through the output committer: a job either
commits every file (``_SUCCESS``) or none, which is the all-or-nothing
behaviour of the original bulk insert.  Paths should sit on the cluster's
shared store.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import cut_once, tidy

DEFAULT_MAX_RECORDS_PER_FILE = 100_000
#: Bytes of JSON that one task of a keyed export sorts and writes, about.
TASK_BYTES = 128 << 20


def export_documents(docs: DataFrame, path: str, max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE) -> None:
    """One JSON document per line (camelCase field names come from the
    document structs).  Files are capped by record count instead of one file
    per document, so millions of programs do not become millions of files;
    each line carries its packet id for lookup."""
    docs.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file).json(path)


def document_json(docs: DataFrame, key: str) -> DataFrame:
    """``key, json``: each document serialised in place (for a key-value
    store or a message bus)."""
    payload = [c for c in docs.columns if c != key]
    return docs.select(key, F.to_json(F.struct(*payload)).alias("json"))


def export_keyed(docs: DataFrame, path: str, key: str, ranges: int) -> None:
    """Documents as a store to look up by key (K2): ``key, json``, cut into ``ranges``
    ranges of the key at its approximate quantiles, one folder each, its files sorted;
    ``<path>/index`` has the least and largest key of each.  Documents without a key
    are in the first range.  A range is one file, or, as the ranges do not grow in
    number, the files of several tasks that sort about TASK_BYTES each."""
    spark = docs.sparkSession
    with cut_once(document_json(docs, key), "keyed-documents") as rows:  # read for the quantiles, and to be dealt out
        points = [k / ranges for k in range(1, ranges)]
        size = F.coalesce(F.sum(F.octet_length("json")), F.lit(0))
        size, *cuts = rows.agg(size, *([F.percentile_approx(key, points)] if points else [])).first()
        part = F.lit(0)
        for least in sorted(set((cuts[0] if cuts else None) or [])):
            part = part + F.coalesce((F.col(key) > least).cast("int"), F.lit(0))
        rows = rows.withColumn("part", part)
        if size <= TASK_BYTES:
            dealt = rows.repartition(ranges, "part")
        else:
            dealt = rows.repartitionByRange(max(ranges, -(-size // TASK_BYTES)), "part", key, F.xxhash64("json"))
        with tidy(spark):
            dealt.sortWithinPartitions("part", key).write.mode("overwrite").option("compression", "zstd").partitionBy("part").parquet(f"{path}/docs")
    index = spark.read.parquet(f"{path}/docs").groupBy("part").agg(F.min(key).alias("least"), F.max(key).alias("largest"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")


def read_keyed(spark: SparkSession, path: str, key: str, value=None) -> DataFrame:
    """``key, json`` of the store, or of one key, for which only its range is
    listed and read."""
    docs = f"{path}/docs"
    if value is None:
        return spark.read.parquet(docs).select(key, "json")
    index = spark.read.parquet(f"{path}/index").where(F.lit(value).between(F.col("least"), F.col("largest")))
    parts = [f"{docs}/part={r['part']}" for r in index.select("part").collect()]  # ranges do not overlap
    if not parts:
        return spark.read.parquet(docs).select(key, "json").limit(0)
    return spark.read.parquet(*parts).where(F.col(key) == value).select(key, "json")


def insert_once(rows: DataFrame, root: str, token: str) -> None:
    """Bulk insert in which every batch of a ``token`` counts once (K4).

    Batches whose token is in the ledger are left out.  The others are written in
    one job, each over its own partition, and their tokens join the ledger last:
    an attempt that died before is written over, one that died after is left out,
    and readers see the batches of the ledger only.  Rows without a token are an error.
    """
    spark = rows.sparkSession
    if rows.where(F.col(token).isNull()).limit(1).count():
        raise ValueError(f"rows without {token}")
    new = rows.join(_ledger(spark, root, token), token, "left_anti") if _exists(spark, f"{root}/ledger") else rows
    new = new.withColumn("batch_token", F.col(token))
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_token").parquet(f"{root}/rows")
    new.select(token).distinct().write.mode("append").parquet(f"{root}/ledger")


def read_inserted(spark: SparkSession, root: str, token: str) -> DataFrame:
    """The rows of all batches that were inserted whole."""
    return spark.read.parquet(f"{root}/rows").drop("batch_token").join(_ledger(spark, root, token), token, "left_semi")


def _ledger(spark: SparkSession, root: str, token: str) -> DataFrame:
    return spark.read.parquet(f"{root}/ledger").select(token)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_version(df: DataFrame, root: str, version: int) -> str:
    """Full overlay (K5): the whole reloaded table as a new version folder;
    readers switch to it once ``_SUCCESS`` is there.  Attributes that are not
    in the feed are not carried over, as in the original reload."""
    path = f"{root}/version={version}"
    df.write.mode("overwrite").parquet(path)
    return path
