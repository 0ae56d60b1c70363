"""Host-level quality rules (operator 6).

Each text is judged by rules; rule failures are counted by host; a host's
failure rates are shrunk towards an empirical beta prior, so that hosts with
few documents are not condemned by one of them; the host's verdict is joined
back to its documents.

Everything is DataFrame expressions.  A text is measured inside its own row,
host counts are partial aggregates, and only (doc_id, host, counts) meets the
host table, never a text: a host with a third of all rows is one row there, and
the join back is a plain equi-join whose large side adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exprs import let
from .scratch import Scratch

# Fixed values of the contract.
SPACE = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
MIN_ROWS_OF_PRIOR = 2.0

#: Rule name -> failure, over the measures; counted by host.
RULES = {
    "base": "base_failed",
    "symbols": "10 * n_symbols > n_words",
    "dup_lines": "10 * n_dup_lines > 3 * n_lines",
    "word_length": "n_words > 0 and (word_chars < 2 * n_words or word_chars > 15 * n_words)",
}
#: A host is blocked if one of its shrunk failure rates is above this.
MAX_RATE = 0.5


def words_of(text: Column) -> Column:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    return F.filter(F.split(F.translate(text, SPACE, " " * len(SPACE)), " "), lambda w: w != "")


def window_hashes(words: Column) -> Column:
    """A 64-bit hash of each window of three words."""
    return F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)),
    )


def repeated_words(windows: Column) -> Column:
    """Words in windows that are found twice or more, the first included.

    Sorting the hashes brings equal windows together; the starts of repeated
    windows, in order, cover three words each, less what they share.
    """
    def starts(keyed: Column) -> Column:
        again = F.transform(keyed, lambda x, k: F.when((F.get(keyed, k - 1)["h"] == x["h"]) | (F.get(keyed, k + 1)["h"] == x["h"]), x["i"]))
        return F.sort_array(F.filter(again, lambda i: i.isNotNull()))

    keyed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    n = F.aggregate(
        let(keyed, starts),
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda acc, i: F.struct((acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")),
        lambda acc: acc["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), n).otherwise(F.lit(0).cast("bigint"))


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """The measures of each text, in place of the text, beside the other columns.

    Null texts have no words and no lines.  Adds n_words, word_chars, n_symbols,
    n_dup_lines, n_repeat_words, n_lines (lines with a word) and base_failed.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda s: F.translate(s, SPACE, "") != "")
    by_word = let(words_of(whole), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), let(window_hashes(w), repeated_words).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return (
        docs.select(
            *(c for c in docs.columns if c != text), by_word.alias("__w"), by_line.alias("__l"),
            F.length(F.translate(whole, SPACE, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        )
        .select("*", "__w.*", "__l.*").drop("__w", "__l")
        .withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")))
    )


def host_verdicts(judged: DataFrame, host: str, rules: dict[str, str] = RULES, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: its documents, the shrunk failure rate of each rule
    (rate_<rule>) and ``host_kept``.

    The beta prior of a rule is fitted by moments over the hosts: with mean m and
    variance v of the hosts' rates, its weight is m(1-m)/v - 1, held to at least
    two documents (equal rates or a single host: as many as an average host has).
    Documents without a host share one.  No documents: no hosts.
    """
    counts = judged.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n_docs"), *(F.sum(F.expr(rule).cast("long")).alias(f"f_{name}") for name, rule in rules.items())
    )
    rate = {r: F.col(f"f_{r}") / F.col("n_docs") for r in rules}
    exact = lambda c: F.sum(F.round(c, 12).cast("decimal(30,12)")).cast("double")  # noqa: E731  no matter in which order
    all_hosts = counts.agg(
        F.count("*").alias("n_hosts"), F.sum("n_docs").alias("all_docs"),
        *(F.sum(f"f_{r}").alias(f"all_{r}") for r in rules), *(exact(rate[r] * rate[r]).alias(f"sq_{r}") for r in rules), *(exact(rate[r]).alias(f"sum_{r}") for r in rules),
    ).first()
    out = counts
    for r in rules:
        mean, weight = _prior(all_hosts, r)
        out = out.withColumn(f"rate_{r}", (F.col(f"f_{r}") + F.lit(mean * weight)) / (F.col("n_docs") + F.lit(weight)))
    kept = F.lit(True)
    for r in rules:
        kept = kept & (F.col(f"rate_{r}") <= max_rate)
    return out.select("host", "n_docs", *(f"rate_{r}" for r in rules), kept.alias("host_kept"))


def _prior(hosts, rule: str) -> tuple[float, float]:
    """Mean and weight (in documents) of a rule's beta prior, from one row of sums."""
    if not hosts["n_hosts"]:
        return 0.0, MIN_ROWS_OF_PRIOR
    mean = hosts[f"all_{rule}"] / hosts["all_docs"]
    spread = hosts[f"sq_{rule}"] / hosts["n_hosts"] - (hosts[f"sum_{rule}"] / hosts["n_hosts"]) ** 2
    weight = mean * (1 - mean) / spread - 1 if spread > 1e-9 else hosts["all_docs"] / hosts["n_hosts"]
    return mean, max(MIN_ROWS_OF_PRIOR, weight)


def judge(docs: DataFrame, host: str, text: str = "text", rules: dict[str, str] = RULES, max_rate: float = MAX_RATE) -> DataFrame:
    """One row per row of ``docs`` (repeated rows stay): its measures,
    ``base_failed``, ``host_kept`` and ``kept``; no text.

    A document is kept if it passes the base rules and its host is kept.
    """
    # The measures are written once: the texts are read once, not for the hosts' counts again.
    judged = Scratch(docs.sparkSession, "host-rules").cut(measure(docs.select("doc_id", F.col(host).alias("host"), F.col(text).alias("text"))))
    hosts = host_verdicts(judged, "host", rules, max_rate).select(F.col("host").alias("__host"), "host_kept")
    return (
        judged.join(hosts, judged["host"].eqNullSafe(hosts["__host"]), "left").drop("__host")
        .withColumn("kept", ~F.col("base_failed") & F.col("host_kept"))
    )


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures and verdict of every document; its host is its source."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judge(docs, host="source").select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_RATE = """(f_{r} + m_{r} * w_{r}) / (n_docs + w_{r})"""
_WEIGHT = """greatest(2.0, CASE WHEN v_{r} > 1e-9 THEN m_{r} * (1 - m_{r}) / v_{r} - 1 ELSE avg_docs END) AS w_{r}"""
_NAMES = list(RULES)
OP6_SQL = f"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS x FROM documents),
d AS (SELECT *, regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+') AS w,
  list_filter(string_split(x, chr(10)), lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS l FROM t),
win AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, sum(least(3, i - coalesce(p, i - 3))) AS n FROM (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p FROM rep) GROUP BY doc_id),
m AS (SELECT d.doc_id, source, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
  CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, len(l) AS n_lines,
  CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM d LEFT JOIN cov USING (doc_id)),
j AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*) AS n_docs, {", ".join(f"sum(CASE WHEN {rule} THEN 1 ELSE 0 END) AS f_{r}" for r, rule in RULES.items())} FROM j GROUP BY source),
p AS (SELECT sum(n_docs) / count(*) AS avg_docs, {", ".join(f"sum(f_{r}) / sum(n_docs) AS m_{r}, sum(CAST(round(f_{r} / n_docs * (f_{r} / n_docs), 12) AS DECIMAL(30,12)))::DOUBLE / count(*) - pow(sum(CAST(round(f_{r} / n_docs, 12) AS DECIMAL(30,12)))::DOUBLE / count(*), 2) AS v_{r}" for r in _NAMES)} FROM h),
s AS (SELECT *, {", ".join(_WEIGHT.format(r=r) for r in _NAMES)} FROM h, p),
k AS (SELECT source, {" AND ".join(_RATE.format(r=r) + f" <= {MAX_RATE}" for r in _NAMES)} AS host_kept FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND host_kept AS kept
FROM j JOIN k ON j.source IS NOT DISTINCT FROM k.source
"""
