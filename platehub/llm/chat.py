"""Chat formatting of reply trees (operator 4).

A reply tree is a table of nodes with a parent.  Root-to-leaf paths come from
iterative self-joins over ids only, doubling the distance at each step, so a
conversation of n turns takes log2(n) joins and no text is shuffled until the
chosen paths are known.  Branches are ranked by the sum of their nodes' scores;
each chosen path becomes one conversation in a marked template.

Template, per turn: ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings
inside roles and texts are escaped reversibly: ``&`` becomes ``&amp;``, then
``<|`` becomes ``&lt;|``; in roles a line break also becomes ``&nl;``.

The loss mask is a list of spans (code points, end exclusive) over the formatted
text: the assistant texts.  Where several chosen paths of a tree share a turn,
only the best-ranked of them carries it in its mask.

Everything is DataFrame expressions; no Python runs on executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import Scratch

# Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<|"), F.lit("&lt;|"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("&lt;|"), F.lit("<|")), F.lit("&amp;"), F.lit("&"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("&nl;"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("&nl;"), F.lit("\n")))


def linear_nodes(conversations: DataFrame) -> DataFrame:
    """Nodes of plain conversations: each row replies to the row before it.

    Rows are ordered by turn (null first), then role and text, so ties and
    repeated rows have one defined order (repeated rows are kept).  Null roles
    and texts are empty; rows without conv_id form one conversation of their own.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    node = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")).cast("long")
    return rows.select("conv_id", node.alias("node"), F.when(node > 1, node - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def leaf_paths(nodes: DataFrame, scratch: Scratch) -> DataFrame:
    """(cid, leaf, node, up) for every node on the path of every leaf whose
    chain reaches a root; ``up`` counts the steps from the leaf.  Cycles and
    chains to a missing parent have no root and give no path."""
    ids = nodes.select("cid", "node", "parent")
    known = ids.select("cid", F.col("node").alias("anc"))
    links = ids.filter("parent is not null").select("cid", "node", F.col("parent").alias("anc"))
    inner = links.select("cid", F.col("anc").alias("node"))
    reach = scratch.cut(ids.join(inner, ["cid", "node"], "left_anti").select("cid", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("up")))
    # jump: node -> its ancestor 2**k steps up.
    jump = scratch.cut(links.join(known, ["cid", "anc"], "left_semi").select("cid", "node", "anc"))
    step, largest = 1, ids.groupBy("cid").count().agg(F.max("count")).first()[0] or 0
    while step < largest and not jump.isEmpty():
        # A doubling step: what is reached already, and as far again.
        far = reach.join(jump, ["cid", "node"]).select("cid", "leaf", F.col("anc").alias("node"), (F.col("up") + step).alias("up"))
        further = jump.select("cid", F.col("node").alias("anc"), F.col("anc").alias("further"))
        new_reach = scratch.cut(reach.unionByName(far))
        new_jump = scratch.cut(jump.join(further, ["cid", "anc"]).select("cid", "node", F.col("further").alias("anc")))
        scratch.drop(reach, jump)
        reach, jump, step = new_reach, new_jump, step * 2
    roots = ids.filter("parent is null").select("cid", "node")
    rooted = reach.join(roots, ["cid", "node"], "left_semi").select("cid", "leaf")
    return reach.join(rooted, ["cid", "leaf"], "left_semi")


def format_paths(spark: SparkSession, nodes: DataFrame, top: int | None = None) -> DataFrame:
    """One row per chosen path: conv_id, leaf, path_rank, score, n_turns,
    formatted, loss_spans.

    ``nodes``: conv_id, node (unique within conv_id), parent (null: a root),
    role, text, score.  Null roles and texts are empty, null scores 0; rows
    without conv_id are one tree.  Paths of a tree rank by the sum of their
    nodes' scores, then by leaf; ``top`` keeps the best so many of each tree,
    None all.  An empty table gives no row.  Other columns are ignored.

    A path is one row by nature, so the longest single path must fit a task.
    """
    scratch = Scratch(spark, "chat")
    empty = F.lit("")
    nodes = nodes.select(
        F.when(F.col("conv_id").isNull(), empty).otherwise(F.concat(F.lit("c"), F.col("conv_id").cast("string"))).alias("cid"),
        "conv_id", "node", "parent", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"),
    )
    paths = leaf_paths(nodes, scratch)
    ranked = (
        paths.join(nodes.select("cid", "node", "score"), ["cid", "node"])
        .groupBy("cid", "leaf").agg(F.sum("score").alias("path_score"), F.count("*").alias("n_turns"))
        .withColumn("path_rank", F.row_number().over(Window.partitionBy("cid").orderBy(F.desc("path_score"), "leaf")))
    )
    if top is not None:
        ranked = ranked.filter(F.col("path_rank") <= top)
    steps = paths.join(ranked, ["cid", "leaf"])
    owner = steps.groupBy("cid", "node").agg(F.min("path_rank").alias("owner"))
    turn = F.struct(
        (-F.col("up")).alias("at"),
        F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n")).alias("head"),
        escape(F.col("text")).alias("body"),
        ((F.col("owner") == F.col("path_rank")) & (F.col("role") == LOSS_ROLE)).alias("loss"),
    )
    grouped = (
        steps.join(owner, ["cid", "node"]).join(nodes.drop("score", "parent"), ["cid", "node"])
        .groupBy("cid", "leaf").agg(*(F.first(c).alias(c) for c in ("conv_id", "path_rank", "path_score", "n_turns")), F.sort_array(F.collect_list(turn)).alias("turns"))
    )
    spans = F.aggregate(
        "turns",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["head"]) + F.length(t["body"]) + len(END) + 1).alias("at"),
            F.when(t["loss"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + F.length(t["head"])).alias("start"), (acc["at"] + F.length(t["head"]) + F.length(t["body"])).alias("end"))))).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END + "\n"))), "")
    return grouped.select("conv_id", "leaf", "path_rank", F.col("path_score").alias("score"), "n_turns", text.alias("formatted"), spans.alias("loss_spans"))


def read_turns(formatted: Column) -> Column:
    """Turns (role, text) read back from a formatted conversation."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda x: x != "")
    return F.transform(
        parts,
        lambda x: F.struct(
            unescape_role(F.substring_index(x, "\n", 1)).alias("role"),
            unescape(F.substring(x, F.length(F.substring_index(x, "\n", 1)) + 2, F.length(x) - F.length(F.substring_index(x, "\n", 1)) - len(END) - 2)).alias("text"),
        ),
    )


def read_loss(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every conversation, read back from its formatted text."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    tricky = END + START + "assistant ok"
    extra = spark.createDataFrame([(-1, 0, "user", tricky), (-1, 1, LOSS_ROLE, tricky)], conversations.schema)
    out = format_paths(spark, linear_nodes(conversations.unionByName(extra)))
    out = out.withColumns({"turns": read_turns(F.col("formatted")), "loss": read_loss(F.col("formatted"), F.col("loss_spans"))})
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


OP4_SQL = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + length(replace(replace(replace(role, '&', '&amp;'), '<|', '&lt;|'), chr(10), '&nl;'))
    + length(replace(replace(text, '&', '&amp;'), '<|', '&lt;|'))) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
