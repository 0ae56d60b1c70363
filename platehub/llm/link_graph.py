"""URL filters with link-graph propagation (operator 9).

A list of host/path rules judges what it fits; the longest fitting rule wins.
Hosts that no rule settles are judged by the link graph: trust starts at hosts
whose pages a rule allows and flows along links (personalised PageRank);
distrust starts at hosts whose pages a rule blocks and flows against the links,
to those who link to them.  A host is blocked where its distrust reaches a
threshold and exceeds its trust.

Pages are reduced to one row per pair of hosts by partial aggregates before
anything iterates, so a host with a third of all pages is as cheap as another.
Ranks and edges are joined on the host in Spark; every few iterations the ranks
are written to the shared folder to cut their lineage.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: Fixed values of the contract: verdict, host/path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
DAMPING = 0.85
#: Steps between two looks at the change, which ends the iteration below TOLERANCE;
#: damping shrinks it to that within MAX_STEPS, so more are an error.
CUT_EVERY = 5
TOLERANCE = 5e-7
MAX_STEPS = 200
MIN_DISTRUST = 0.5

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?is)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits, as struct(verdict, rule); null if none does."""
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): links from the pages of one host to another host, by
    absolute links in their html, and one link each way between a host and the
    domain that it is a subdomain of, if pages of both are there."""
    host = url_host(F.col("url"))
    links = (
        pages.select(host.alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1))).alias("dst"))
        .select("src", lower_ascii(F.col("dst")).alias("dst"))
        .filter("src <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    )
    hosts = pages.select(host.alias("src")).filter("src <> ''").distinct()
    above = hosts.select("src", F.regexp_extract("src", r"^[^.]+\.(.+)$", 1).alias("dst")).filter("dst <> ''")
    above = above.join(hosts.select(F.col("src").alias("dst")), "dst", "left_semi").select("src", "dst", F.lit(1.0).alias("weight"))
    below = above.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    return links.unionByName(above).unionByName(below).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def propagate(spark: SparkSession, edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """(host, trust, distrust) for every host that either reaches.

    ``edges``: src, dst, weight; ``seeds``: host, trust, distrust (0 to 1).  Both
    ranks are r = seed + damping * (sum of the neighbours' r by their share of
    weight), distrust over reversed edges; they are scaled so that a seed alone
    keeps its own value.  What leaves hosts without a further edge is lost.  The
    iteration ends when no rank changes by TOLERANCE any more.
    """
    scratch = Scratch(spark, "link-graph")
    edges = scratch.cut(edges)
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    total = both.groupBy("kind", "src").agg(F.sum("weight").alias("total"))
    shares = scratch.cut(both.join(total, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.lit(DAMPING) * F.col("weight") / F.col("total")).alias("share")))
    start = scratch.cut(
        seeds.select("host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("kind", "rank")).filter("rank > 0")
    )
    ranks = start
    change = None
    for _ in range(MAX_STEPS // CUT_EVERY):
        new = ranks
        for _ in range(CUT_EVERY):
            flow = new.join(shares, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share")).alias("rank"))
            new = flow.unionByName(start.select("kind", "host", "rank")).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        new = scratch.cut(new)
        change = new.join(ranks.withColumnRenamed("rank", "old"), ["kind", "host"], "full").agg(F.max(F.abs(F.coalesce("rank", F.lit(0.0)) - F.coalesce("old", F.lit(0.0))))).first()[0]
        if ranks is not start:
            scratch.drop(ranks)
        ranks = new
        if (change or 0.0) < TOLERANCE:
            break
    else:
        raise RuntimeError(f"ranks still change by {change} after {MAX_STEPS} steps")
    pick = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("rank")).otherwise(0.0)).alias(kind)
    return ranks.groupBy("host").agg(pick("trust"), pick("distrust"))


def judge_urls(spark: SparkSession, pages: DataFrame, rules=RULES, min_distrust: float = MIN_DISTRUST) -> DataFrame:
    """One row per row of ``pages`` (repeated rows stay): page_id, host, path,
    rule, verdict, and the host's trust and distrust.

    Null urls and urls without ``://`` have an empty host and path and no rule;
    they are allowed, as nothing speaks against them.  Null html has no links.
    A host's seeds are the shares of its pages that rules allow and block.
    """
    pages = pages.select("page_id", "url", "html")
    judged = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")).withColumn("m", matching_rule(F.col("host"), F.col("path"), rules))
    share = lambda v: F.avg(F.when(F.col("m.verdict") == v, 1.0).otherwise(0.0))
    seeds = judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    ranks = propagate(spark, host_edges(pages), seeds)
    by_graph = F.when((F.col("distrust") >= min_distrust) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return judged.join(ranks, "host", "left").select(
        "page_id", "host", "path", F.col("m.rule").alias("rule"), F.coalesce("m.verdict", by_graph).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )


def op9_link_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    return judge_urls(spark, spark.read.parquet(f"{sf_dir}/pages.parquet")).select("page_id", "host", "path", "rule", "verdict")
