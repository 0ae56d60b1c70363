"""Mixing sources to target weights (operator 3).

The budget of tokens flows down a tree of levels (domain, language, source).  At
each node it is shared among the children by weight; a child takes at most what
its subtree can give (its tokens times the allowed epochs), and what it cannot
take goes to its siblings by weight.  Only what all siblings together cannot
take is left to the node's own siblings: a node's budget is capped by its
subtree before the children see it.

A leaf gives its whole texts for as many full epochs as its share holds, then a
token-prefix of one more epoch in a seeded order.  The prefix is found without
sorting a leaf in one task: documents fall into ranges of their seeded hash,
about RANGE documents each; the ranges' sums are accumulated, and only within a
range are documents ordered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .host_rules import SPACE
from .scratch import Scratch

LEVELS = ("domain", "lang", "source")
SEED = 17
MAX_EPOCHS = 4
TARGET_SHARE = 0.8
RANGE = 1024
#: Production weights by path from the root; nodes not named weigh 1.
WEIGHTS = {
    ("web",): 5, ("books",): 3, ("code",): 2,
    ("web", "en"): 4, ("books", "en"): 4, ("code", "en"): 4,
    ("web", "fr"): 2, ("books", "de"): 2,
}


def domain_of(source: Column) -> Column:
    """Domain of a source by the number it ends with: 0 web, 1 books, 2 code (mod 3); else web."""
    number = F.regexp_extract(F.coalesce(source, F.lit("")), r"([0-9]{1,9})$", 1)
    rest = F.when(number == "", F.lit(0)).otherwise(F.pmod(number.cast("int"), F.lit(3)))
    return F.when(rest == 1, "books").when(rest == 2, "code").otherwise("web")


def count_words(text: Column) -> Column:
    flat = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACE, " " * len(SPACE)))
    return F.when(flat == "", F.lit(0)).otherwise(F.size(F.split(flat, " +"))).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The first ``n`` words of a text, joined by a space."""
    words = F.split(F.trim(F.translate(text, SPACE, " " * len(SPACE))), " +")
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), " ")


def seeded(seed: int, epoch: Column, doc_id: Column) -> Column:
    """60 bits that order a leaf's documents in an epoch."""
    name = F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 15), 16, 10).cast("long")


def allocate(leaves: DataFrame, levels, weights: dict[tuple[str, ...], int], target: int, max_epochs: int, scratch: Scratch) -> DataFrame:
    """``share`` tokens for every leaf (levels..., n_tokens): one window per level.

    Children that fill up are those with the least capacity for their weight, so
    in that order the first one that does not fill fixes the rate of all others.
    Shares are rounded down: a node may leave less than a token for each child.
    """
    caps = leaves.withColumn("cap", F.col("n_tokens") * max_epochs)
    root = caps.agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("c")).first()["c"]
    nodes = None
    for depth in range(1, len(levels) + 1):
        keys, parent = list(levels[:depth]), list(levels[: depth - 1])
        weight = F.lit(1)
        for path, w in weights.items():
            if len(path) == depth:
                here = F.lit(True)
                for c, v in zip(keys, path):
                    here = here & (F.col(c) == v)
                weight = F.when(here, F.lit(w)).otherwise(weight)
        level = caps.groupBy(*keys).agg(F.sum("cap").alias("cap")).withColumn("w", weight.cast("long"))
        level = level.withColumn("budget", F.lit(min(target, root)).cast("long")) if nodes is None else level.join(nodes, parent)
        # A constant in the first level's partition: the domains are one small family.
        family = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
        order = family.orderBy(F.col("cap") / F.col("w"), *keys)
        before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
        level = level.withColumn("rate", (F.col("budget") - before) / F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        full = F.col("cap") <= F.col("rate") * F.col("w")
        level = level.withColumn("first_rate", F.first(F.when(~full, F.col("rate")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        share = F.when(full, F.col("cap")).otherwise(F.floor(F.col("first_rate") * F.col("w"))).cast("long")
        nodes = level.select(*keys, share.alias("budget"))
    return leaves.join(scratch.cut(nodes), list(levels)).withColumnRenamed("budget", "share")


def mix_sources(
    spark: SparkSession, docs: DataFrame, levels=LEVELS, weights: dict[tuple[str, ...], int] = WEIGHTS,
    target_tokens: int | None = None, target_share: float = TARGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED, texts: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, the levels, n_tokens, epochs (full
    copies), last_tokens (tokens taken in the leaf's last, partial epoch) and
    taken_tokens in all; documents that are not chosen have 0.

    ``texts``: the mixed corpus instead, chosen rows only, with their ``text``
    (to be read ``epochs`` times) and ``last_text``, what the partial epoch takes:
    the text if that is all of it, else its first words joined by a space; null
    where it takes nothing.

    Tokens are words.  ``target_tokens``: the budget; None: ``target_share`` of
    the tokens there are.  Null levels count as empty strings, null or empty
    texts have no tokens, and repeated rows are documents of their own, in an
    order that does not depend on which is which.  An empty table gives no row.
    """
    scratch = Scratch(spark, "mixing")
    rows = docs.select("doc_id", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in levels), count_words(F.col("text")).alias("n_tokens"), *(["text"] if texts else []))
    # Row ids are written with the rows, so that they are the same whenever read.
    held = scratch.cut(rows.withColumn("row", F.monotonically_increasing_id()) if texts else rows)
    rows = held.drop("text")
    leaves = scratch.cut(rows.groupBy(*levels).agg(F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("n_docs")))
    if target_tokens is None:
        target_tokens = int((leaves.agg(F.sum("n_tokens").cast("double")).first()[0] or 0) * target_share)
    plan = allocate(leaves, levels, weights, target_tokens, max_epochs, scratch).select(
        *levels,
        F.when(F.col("n_tokens") > 0, F.floor(F.col("share") / F.col("n_tokens"))).otherwise(0).cast("long").alias("epochs"),
        F.when(F.col("n_tokens") > 0, F.col("share") % F.col("n_tokens")).otherwise(0).cast("long").alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("n_docs") / RANGE)).cast("long").alias("ranges"),
    )
    drawn = rows.join(plan, list(levels)).withColumn("h", seeded(seed, F.col("epochs"), F.col("doc_id")))
    drawn = scratch.cut(drawn.withColumn("range", F.floor(F.col("h") / F.lit(float(1 << 60)) * F.col("ranges")).cast("long")))
    sums = drawn.groupBy(*levels, "range").agg(F.sum("n_tokens").alias("s"))
    before = F.sum("s").over(Window.partitionBy(*levels).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select(*levels, "range", F.coalesce(before, F.lit(0).cast("long")).alias("before"))
    inside = Window.partitionBy(*levels, "range").orderBy("h", "doc_id", "n_tokens")
    prior = F.coalesce(F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long"))
    last = F.greatest(F.lit(0).cast("long"), F.least(F.col("n_tokens"), F.col("rest") - F.col("before") - prior))
    taken = (F.col("epochs") * F.col("n_tokens") + F.col("last_tokens")).alias("taken_tokens")
    drawn = drawn.join(sums, [*levels, "range"]).withColumn("last_tokens", last)
    if not texts:
        return drawn.select("doc_id", *levels, "n_tokens", "epochs", "last_tokens", taken)
    chosen = drawn.select("row", "epochs", "last_tokens", taken).filter("taken_tokens > 0")
    last_text = F.when(F.col("last_tokens") == F.col("n_tokens"), F.col("text")).when(F.col("last_tokens") > 0, first_words(F.col("text"), F.col("last_tokens")))
    return held.join(chosen, "row").select("doc_id", *levels, "n_tokens", "epochs", "last_tokens", "taken_tokens", "text", last_text.alias("last_text"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the production mixture takes of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("domain", domain_of(F.col("source")))
    return mix_sources(spark, docs)


def mixing_sql(docs: str = "documents", weights: dict[tuple[str, ...], int] = WEIGHTS, target_share: float = TARGET_SHARE, max_epochs: int = MAX_EPOCHS, seed: int = SEED) -> str:
    """DuckDB SQL of :func:`mix_sources` over the production levels."""
    number = "regexp_extract(coalesce(source, ''), '([0-9]{1,9})$', 1)"
    ctes, nodes = [], ""
    for depth in (1, 2, 3):
        keys, parent = ", ".join(LEVELS[:depth]), ", ".join(LEVELS[: depth - 1])
        case = "".join(" WHEN " + " AND ".join(f"{c} = '{v}'" for c, v in zip(LEVELS, path)) + f" THEN {w}" for path, w in weights.items() if len(path) == depth)
        weight = f"CASE{case} ELSE 1 END" if case else "1"
        budget = f"n{depth - 1}.budget" if parent else "(SELECT least(CAST(floor(sum(n_tokens)::DOUBLE * {s}) AS BIGINT), CAST(sum(n_tokens) * {e} AS BIGINT)) FROM leaves)".format(s=target_share, e=max_epochs)
        over = f"PARTITION BY {parent} " if parent else ""
        ctes.append(f"""
c{depth} AS (SELECT {keys}, CAST(sum(n_tokens) * {max_epochs} AS BIGINT) AS cap, {weight} AS w FROM leaves GROUP BY {keys}),
b{depth} AS (SELECT c{depth}.*, {budget} AS budget FROM c{depth} {f"JOIN n{depth - 1} USING ({parent})" if parent else ""}),
r{depth} AS (SELECT *, (budget - coalesce(CAST(sum(cap) OVER ({over}ORDER BY cap / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0))
  / CAST(sum(w) OVER ({over}ORDER BY cap / w, {keys} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rate FROM b{depth}),
f{depth} AS (SELECT *, first_value(CASE WHEN cap > rate * w THEN rate END IGNORE NULLS) OVER ({over}ORDER BY cap / w, {keys} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS fr FROM r{depth}),
n{depth} AS (SELECT {keys}, CASE WHEN cap <= rate * w THEN cap ELSE CAST(floor(fr * w) AS BIGINT) END AS budget FROM f{depth}),""")
    return f"""
WITH rows_ AS (SELECT doc_id, CASE WHEN {number} = '' THEN 'web' WHEN CAST({number} AS INT) % 3 = 1 THEN 'books' WHEN CAST({number} AS INT) % 3 = 2 THEN 'code' ELSE 'web' END AS domain,
  coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n_tokens FROM {docs}),
leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS n_tokens FROM rows_ GROUP BY ALL),{"".join(ctes)}
p AS (SELECT domain, lang, source, CASE WHEN n_tokens > 0 THEN budget // n_tokens ELSE 0 END AS epochs, CASE WHEN n_tokens > 0 THEN budget % n_tokens ELSE 0 END AS rest FROM leaves JOIN n3 USING (domain, lang, source)),
d AS (SELECT *, ('0x' || substr(md5('{seed}:' || epochs || ':' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h FROM rows_ JOIN p USING (domain, lang, source)),
l AS (SELECT *, CAST(greatest(0, least(n_tokens, rest - coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY h, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS BIGINT) AS last_tokens FROM d)
SELECT doc_id, domain, lang, source, n_tokens, epochs, last_tokens, epochs * n_tokens + last_tokens AS taken_tokens FROM l
"""


OP3_SQL = mixing_sql()
