"""Benchmark decontamination (operator 7): BM25 with block-max WAND.

The test items are the indexed side: an inverted index of their words with BM25
impacts, each divided by its item's score against itself, so that 1 means the
whole item.  Every passage of every text is a query.  Passages are windows of
twice the longest item, half a window apart, so that each stretch as long as an
item lies whole in some passage.

Items stand in blocks.  A passage's bound for a block is the sum over its words
of the block's largest impact of the word; a passage is scored only if the bound
of some block reaches the threshold, then over the postings of its words in all
blocks, and only items that reach the threshold are retrieved.  The bounds of
all passages of a text come from one running sum.  Retrieved items are verified:
the passage must hold enough of the word bigrams of the item's question and of
its answer.

Document frequencies and the mean length are taken over all items in Spark; the
index is sent out in parts of at most MAX_POSTINGS postings, each against all
texts.  Texts are read row by row and nothing of them is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch
from .tokens import _SPACE, PLAIN, Prefix, U, mix

K1, B = 1.2, 0.75
THRESHOLD = 0.5
MIN_OVERLAP = 0.6
#: Postings of one part of the index (24 bytes each), and the blocks of a part.
MAX_POSTINGS = 200_000
MAX_BLOCKS = 32
MIN_BLOCK = 8

#: Words are cut at white space and ASCII punctuation.
_CUT = _SPACE.copy()
_CUT[[b for b in range(33, 127) if not chr(b).isalnum()]] = True


def words(text: str) -> np.ndarray:
    """Hashes of the lower-cased words of a text."""
    raw = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    inside = np.zeros(len(raw) + 2, dtype=np.int8)
    inside[1:-1] = ~_CUT[raw]
    edges = np.flatnonzero(np.diff(inside))
    return Prefix(raw, PLAIN)(edges[::2], edges[1::2])


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the answer is the last line or, of a single line, the
    last sentence; a single sentence is all question."""
    head, mark, tail = text.strip().rpartition("\n")
    if not mark:
        parts = re.split(r"(?<=[.!?])\s+", text.strip())
        head, tail = " ".join(parts[:-1]), parts[-1]
    return (head, tail) if len(words(head)) else (tail, "")


def bigrams(w: np.ndarray) -> np.ndarray:
    """Distinct bigrams; of a single word, the word."""
    return np.unique(mix(w[:-1] * U(31) + w[1:])) if len(w) > 1 else w


class Index:
    """A part of the inverted index, in arrays that travel with the tasks."""

    def __init__(self, postings: list[tuple[int, int, float]], texts: dict[int, str], window: int):
        """``postings``: (item, word, impact); ``texts`` of the items."""
        items = sorted(texts)
        where = {i: k for k, i in enumerate(items)}
        word = np.array([w for _, w, _ in postings], dtype=np.int64).view(np.uint64)
        item = np.array([where[i] for i, _, _ in postings], dtype=np.int64)
        impact = np.array([x for _, _, x in postings], dtype=np.float64)
        order = np.lexsort((item, word))
        word, self.item, self.impact = word[order], item[order], impact[order]
        self.words, self.begin = np.unique(word, return_index=True)
        self.end = np.append(self.begin[1:], len(word))
        self.ids, self.window = np.array(items, dtype=np.int64), window
        self.block = max(MIN_BLOCK, -(-len(items) // MAX_BLOCKS))
        self.blocks = -(-len(items) // self.block)
        self.most = np.zeros((len(self.words), self.blocks), dtype=np.float32)
        np.maximum.at(self.most, (np.repeat(np.arange(len(self.words)), self.end - self.begin), self.item // self.block), self.impact.astype(np.float32))
        halves = [split_item(texts[i]) for i in items]
        self.question = [bigrams(words(q)) for q, _ in halves]
        self.answer = [bigrams(words(a)) for _, a in halves]

    def retrieve(self, query: np.ndarray, threshold: float) -> list[tuple[int, float]]:
        """Items that score at least the threshold against a passage's known
        words, block by block under the blocks' bounds."""
        terms = np.unique(query)
        most = self.most[terms]
        live = np.flatnonzero(most.sum(axis=0, dtype=np.float64) >= threshold - 1e-4)
        if not len(live):
            return []
        terms = terms[most[:, live].any(axis=1)]
        # The postings of all these words, one list after the other.
        size = self.end[terms] - self.begin[terms]
        at = np.arange(size.sum()) + np.repeat(self.begin[terms] - (np.cumsum(size) - size), size)
        score = np.bincount(self.item[at], weights=self.impact[at], minlength=len(self.ids))
        return [(int(k), float(score[k])) for k in np.flatnonzero(score >= threshold - 1e-9)]

    def search(self, text: str, threshold: float, min_overlap: float) -> list[tuple[int, float, float, float, int]]:
        """(item, best score, question overlap, answer overlap, passages) of the
        items found in a text."""
        w = words(text)
        if not len(w) or not len(self.words):
            return []
        at = np.searchsorted(self.words, w)
        at[at == len(self.words)] = 0
        place = np.flatnonzero(self.words[at] == w)
        if not len(place):
            return []
        known = at[place]
        step = max(1, self.window // 2)
        start = np.arange(0, max(1, len(w) - step), step)
        lo, hi = np.searchsorted(place, start), np.searchsorted(place, start + self.window)
        total = np.zeros((len(place) + 1, self.blocks))
        np.cumsum(self.most[known], axis=0, out=total[1:])
        reach = (total[hi] - total[lo]).max(axis=1) >= threshold - 1e-4
        best: dict[int, list] = {}
        for k in np.flatnonzero(reach):
            held = None
            for item, score in self.retrieve(known[lo[k] : hi[k]], threshold):
                if held is None:
                    passage = w[start[k] : start[k] + self.window]
                    held = np.union1d(bigrams(passage), passage)  # a part of one word is that word
                q, a = (_share(part[item], held) for part in (self.question, self.answer))
                if q >= min_overlap and a >= min_overlap:
                    was = best.setdefault(item, [0.0, 0.0, 0.0, 0])
                    best[item] = [max(was[0], score), max(was[1], q), max(was[2], a), was[3] + 1]
        return [(int(self.ids[i]), *v) for i, v in sorted(best.items())]


def _share(part: np.ndarray, held: np.ndarray) -> float:
    """Share of a part's bigrams that a passage holds; an empty part is held."""
    return float(np.isin(part, held, assume_unique=True).mean()) if len(part) else 1.0


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            w = words(text)
            term, tf = np.unique(w, return_counts=True)
            out += [(item, int(t), int(n), len(w)) for t, n in zip(term.view(np.int64), tf)]
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item_id", "word", "tf", "len"])


def postings(benchmark: DataFrame) -> DataFrame:
    """(item_id, word, impact): BM25 impacts over the item's score against itself."""
    words_of = benchmark.select("item_id", "text").mapInArrow(_item_words, "item_id long, word long, tf long, len long")
    lens = words_of.groupBy("item_id").agg(F.first("len").alias("l")).agg(F.count("*").alias("n"), F.avg("l").alias("mean")).first()
    df = words_of.groupBy("word").agg(F.count("*").alias("df"))
    n, mean = float(lens["n"]), float(lens["mean"] or 1.0)
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / mean))
    raw = words_of.join(df, "word").select("item_id", "word", impact.alias("raw"))
    own = raw.groupBy("item_id").agg(F.sum("raw").alias("own"))
    return raw.join(own, "item_id").select("item_id", "word", (F.col("raw") / F.col("own")).alias("impact"))


def find_leaks(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, min_overlap: float = MIN_OVERLAP
) -> DataFrame:
    """One row per document and item found in it: doc_id, item_id, score (best
    passage, 1: the whole item), question_overlap, answer_overlap, n_passages.

    Null and empty texts and items match nothing; items without an id are left
    out, and of an id on several rows the first text in order counts.  Repeated
    documents give a row each.  Other columns are ignored.  The benchmark is
    read in parts of a bounded size, so it may be large.
    """
    scratch = Scratch(spark, "decontaminate")
    items = scratch.cut(benchmark.filter("item_id is not null and text is not null").groupBy("item_id").agg(F.min("text").alias("text")))
    all_postings = scratch.cut(postings(items))
    longest = items.mapInArrow(_lengths, "n long").agg(F.max("n")).first()[0] or 0
    parts = max(1, -(-all_postings.count() // MAX_POSTINGS))
    out = None
    for k in range(parts):
        mine = F.pmod(F.xxhash64("item_id"), F.lit(parts)) == k
        texts = {r["item_id"]: r["text"] for r in items.filter(mine).collect()}
        index = spark.sparkContext.broadcast(Index([tuple(r) for r in all_postings.filter(mine).collect()], texts, 2 * longest))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, found = [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    hits = index.value.search(text.as_py() or "", threshold, min_overlap)
                    ids += [doc] * len(hits)
                    found += hits
                cols = list(zip(*found)) if found else [[]] * 5
                kinds = (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), *(pa.array(c, t) for c, t in zip(cols, kinds))], ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "n_passages"])

        part = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, n_passages long")
        out = part if out is None else out.unionByName(part)
    return out


def _lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([len(words(t)) for t in batch.column(1).to_pylist()], pa.int64())], ["n"])


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items found in every whole text of ``documents``."""
    return find_leaks(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
