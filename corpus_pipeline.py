"""A training corpus from raw documents, stage by stage.

Each stage reads what the one before it kept, as Parquet, and writes what it
keeps: documents of good quality, without repeated lines, one of each group of
near copies, without benchmark items, and at last the texts the mixture takes.

A row without doc_id is a document known by its text: equal texts are one.  A
doc_id on several rows is one document; where its rows are equal, one of them
passes ``near_copies``.  Null and empty texts pass until the mixture, which takes
nothing of them.  Ties go to the smallest doc_id, and to documents that have one.
Other columns stay as they are, and an empty table gives empty stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from platehub.llm.decontaminate import find_leaks
from platehub.llm.jaccard import join_components
from platehub.llm.line_dedup import dedup_lines
from platehub.llm.mixing import domain_of, mix_sources
from platehub.llm.quality import keep_good
from platehub.llm.scratch import Scratch

# The mixture runs in SQL, but the stages before it do not.
ORACLE_SQL = None


#: Ids of texts without one begin here; those of documents are smaller.
UNNAMED = 1 << 60


def known_by():
    """doc_id; for rows without it, a number that equal texts share."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce("text", F.lit(""))).bitwiseAND(F.lit(UNNAMED - 1)) + F.lit(UNNAMED))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the lines that an earlier one has; those that lose all
    they had go, as nothing of theirs is new."""
    kept = dedup_lines(spark, docs).filter((F.col("n_removed") == 0) | (F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) != ""))
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id, and
    one of its equal rows; documents without words are copies of no other id."""
    keyed = docs.withColumn("__key", known_by())
    found = Scratch(spark, "near-copies").cut(join_components(spark, keyed.select(F.col("__key").alias("doc_id"), "text")).groupBy("doc_id").agg(F.min("component_id").alias("first"), F.count("*").alias("n")))
    kept = keyed.join(found.filter("first <> doc_id").select(F.col("doc_id").alias("__key")), "__key", "left_anti")
    # Only rows that share their key can be equal; they alone are compared.
    shared = found.filter("n > 1").select(F.col("doc_id").alias("__key"))
    once = kept.join(shared, "__key", "left_semi").dropDuplicates(["__key", "text"])
    return kept.join(shared, "__key", "left_anti").unionByName(once).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items, with or without doc_id; one with an item
    on any of its rows goes."""
    keyed = docs.withColumn("__key", known_by())
    leaks = find_leaks(spark, keyed.select(F.col("__key").alias("doc_id"), "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    leaks = Scratch(spark, "leaks").cut(leaks.select(F.col("doc_id").alias("__key")).distinct())
    return keyed.join(leaks, "__key", "left_anti").select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed corpus: the documents it takes, how often, and their texts."""
    return mix_sources(spark, docs.withColumn("domain", domain_of(F.col("source"))), texts=True)


STAGES = [
    ("quality", quality),
    ("lines", lines),
    ("near_copies", near_copies),
    ("decontaminate", decontaminate),
    ("mixture", mixture),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each written and read again."""
    docs, scratch = spark.read.parquet(f"{sf_dir}/documents.parquet"), Scratch(spark, "pipeline")
    for _, stage in STAGES:
        docs = scratch.cut(stage(spark, docs, sf_dir))
    return docs
