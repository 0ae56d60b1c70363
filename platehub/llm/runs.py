"""Periodic runs of words, found by uniting suffixes (operator 11).

The suffixes of a text, as sequences of words, are sorted by prefix doubling and
neighbours get their longest common prefix (LCP).  Kruskal's algorithm takes
these neighbours as edges by descending LCP and unites the classes of their
suffixes; each class keeps the ordered set of its positions.  When two classes
meet at LCP l, positions i < j that become neighbours in the united set, with no
position of the class between them, have period j - i on [i, j + l).  If the word
before i breaks the period, this is a maximal run; its period is the smallest,
as a smaller one would have put a position between i and j.

A run of length L and period q starts as such a pair of LCP L - q, so edges of
an LCP below LEAST_LCP are not needed: most texts have none above it.  Texts are
independent rows: there is no shuffle, and a task holds one text at a time with
about 100 bytes for each of its words.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .exprs import let

#: Shortest run, in words and in periods.
MIN_WORDS = 6
MIN_PERIODS = 4
#: The least LCP of the pair that starts a run: max(MIN_WORDS - q, (MIN_PERIODS - 1) * q), for any q.
LEAST_LCP = min(max(MIN_WORDS - q, (MIN_PERIODS - 1) * q) for q in range(1, MIN_WORDS + 1))
#: Positions in one block of an ordered set.
BLOCK = 1024

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
SPACES = r"[\x20\x09-\x0D]+"
RUN = "struct<start:long,length:long,period:long>"


def ranks(ids: np.ndarray) -> list[np.ndarray]:
    """ranks[k][i]: the rank of the 2**k words from i among all, as long as any
    of them repeat; words beyond the end rank lowest."""
    level = np.append(np.unique(ids, return_inverse=True)[1] + 1, 0)
    out, width = [level], 1
    while width < len(ids):
        ahead = np.zeros_like(level)
        ahead[: len(level) - width] = level[width:]
        distinct, level = np.unique(level * np.int64(len(level)) + ahead, return_inverse=True)
        out.append(level)
        width *= 2
        if len(distinct) == len(level):
            break
    return out


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """LCP of the suffixes at a and b, position by position."""
    length = np.zeros(len(a), dtype=np.int64)
    last = len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        i, j = np.minimum(a + length, last), np.minimum(b + length, last)
        length += (levels[k][i] == levels[k][j]).astype(np.int64) << k
    return length


def edges(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with an LCP of LEAST_LCP or more, the greatest first."""
    none = np.zeros(0, dtype=np.int64)
    if len(ids) < MIN_WORDS:
        return none, none, none
    levels = ranks(ids)
    if 1 << (len(levels) - 1) < LEAST_LCP and len(np.unique(levels[-1])) == len(levels[-1]):
        return none, none, none  # no prefix of so many words occurs twice
    order = np.argsort(levels[-1], kind="stable")
    order = order[order < len(ids)]
    a, b = order[:-1], order[1:]
    lcp = common_prefixes(levels, a, b)
    wide = np.flatnonzero(lcp >= LEAST_LCP)
    wide = wide[np.argsort(-lcp[wide], kind="stable")]
    return a[wide], b[wide], lcp[wide]


def _first(block: list[int]) -> int:
    return block[0]


def _insert(blocks: list[list[int]], x: int) -> tuple[int, int]:
    """Put ``x`` into an ordered set of sorted blocks; its neighbours there, or -1."""
    k = max(0, bisect_right(blocks, x, key=_first) - 1) if len(blocks) > 1 else 0
    block = blocks[k]
    at = bisect_left(block, x)
    before = block[at - 1] if at else blocks[k - 1][-1] if k else -1
    after = block[at] if at < len(block) else blocks[k + 1][0] if k + 1 < len(blocks) else -1
    block.insert(at, x)
    if len(block) > BLOCK:
        blocks[k : k + 1] = [block[: BLOCK // 2], block[BLOCK // 2 :]]
    return before, after


def find(ids: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a sequence, by start, then period."""
    left, right, lcps = (x.tolist() for x in edges(ids))
    if not left:
        return []
    ids = ids.tolist()
    parent: dict[int, int] = {}
    sets: dict[int, list[list[int]]] = {}
    sizes: dict[int, int] = {}
    out: list[tuple[int, int, int]] = []

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while (up := parent.get(x, x)) != top:
            parent[x], x = top, up
        return top

    def seed(i: int, j: int, lcp: int) -> None:
        period = j - i
        length = period + lcp
        if length >= MIN_WORDS and length >= MIN_PERIODS * period and (i == 0 or ids[i - 1] != ids[j - 1]):
            out.append((i, length, period))

    for a, b, lcp in zip(left, right, lcps):
        a, b = root(a), root(b)
        if sizes.get(a, 1) < sizes.get(b, 1):
            a, b = b, a
        large = sets.setdefault(a, [[a]])
        small = [x for block in sets.pop(b, [[b]]) for x in block]
        parent[b] = a
        sizes[a] = sizes.get(a, 1) + sizes.pop(b, 1)
        previous = -1
        for k, x in enumerate(small):
            before, after = _insert(large, x)
            if before != -1 and before != previous:
                seed(before, x, lcp)
            if after != -1 and (k + 1 == len(small) or small[k + 1] > after):
                seed(x, after, lcp)
            previous = x
    return sorted(out, key=lambda run: (run[0], run[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words less those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        depth[start + period] += 1
        depth[start + length] -= 1
    return b" ".join([w for w, d in zip(words, np.cumsum(depth[:-1]).tolist()) if not d])


def text_runs(text: bytes) -> tuple[list[tuple[int, int, int]], bytes]:
    """Runs of a text and its collapsed form."""
    words = _WORD.findall(text)
    names: dict[bytes, int] = {}
    runs = find(np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64))
    return runs, collapse(words, runs)


def find_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, runs (start, length, period in words, by start, then period) and
    collapsed (the text's words without the repeats of any run, joined by one
    space) for each row of ``docs``.

    A run is a stretch of smallest period q of at least MIN_WORDS words and
    MIN_PERIODS periods that no neighbouring word extends; of each run the first
    q words are no repeats.  Words are split by white space and compared byte by
    byte.  Null and empty texts have no run and collapse to the empty text; rows
    without doc_id and repeated rows are treated as any other; other columns are
    ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            found = [text_runs(t.as_py() or b"") for t in batch.column(1)]
            runs = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r, _ in found], kind)
            texts = pa.array([c for _, c in found], pa.large_binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), runs, texts], ["doc_id", "runs", "collapsed"])

    rows = docs.select("doc_id", F.col(text).cast("binary").alias("text"))
    out = rows.mapInArrow(run, f"doc_id long, runs array<{RUN}>, collapsed binary")
    return out.withColumn("collapsed", F.col("collapsed").cast("string"))


def plant(text: Column, doc_id: Column) -> Column:
    """The text with its tail made periodic where crc32 of the decimal id is a
    multiple of ten and it has a word: with n words, g the tenth of that crc32,
    a = g mod n and p = 1 + floor((n - a) / (3 + g mod 8)), each word i >= a becomes
    word a + (i - a) mod p."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10).cast("long")

    def periodic(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long")
        return let(F.struct(a.alias("a"), p.alias("p"), n.alias("n")), lambda v: F.array_join(F.transform(words, lambda w, i: F.when(i < v["a"], w).otherwise(F.get(words, (v["a"] + F.pmod(i - v["a"], v["p"])).cast("int")))), " "))

    words = F.filter(F.split(text, SPACES), lambda w: w != "")
    return F.when(F.pmod(h, F.lit(10)) == 0, let(words, lambda w: F.when(F.size(w) > 0, periodic(w)).otherwise(text))).otherwise(text)


def longest(runs: Column) -> Column:
    """The longest run; of several the first to start, then the shortest period."""
    first = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    return F.struct((-first["start"]).alias("start"), first["length"].alias("length"), (-first["period"]).alias("period"))


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the runs of :func:`find_runs`."""
    best = found.withColumn("best", longest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, a tenth of them made periodic."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digest(find_runs(docs.select("doc_id", plant(F.col("text"), F.col("doc_id")).alias("text"))))
