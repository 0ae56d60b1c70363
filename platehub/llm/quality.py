"""Compression classifier of text quality (operator 1).

Two zstandard dictionaries are trained, one on good and one on bad labelled
text.  A text is compressed with both, piece by piece, and the difference of the
two sizes over their sum says which of them it resembles.  Text that repeats
itself shrinks to nothing under either, and leaves no difference to speak of, so
the smaller size over the text's own size stands beside it.  A logistic curve,
fitted on labelled texts that the dictionaries have not seen, turns the two into
a probability.

Only the labelled sample is gathered (at most MAX_DOCS whole texts and MAX_BYTES
bytes per class); the curve weighs its texts by their class' share of all labelled
texts, so the sample's bounds do not move the scores.  Scoring is one pass over the
table without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bounds of the labelled sample, for each class.
MAX_DOCS = 4000
MAX_BYTES = 12_000_000
DICT_BYTES = 64 * 1024
PIECE = 2048
LEVEL = 3
CUT = 0.3
FOLDS = 5
FEATURES = 3


@dataclass
class Model:
    """Dictionaries and the logistic curve over the standardised features."""

    good: bytes
    bad: bytes
    mean: np.ndarray
    weight: np.ndarray
    bias: float

    def curve(self, x: np.ndarray) -> np.ndarray:
        z = np.where(np.isnan(x), 0.0, x - self.mean) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def fold(doc_id: str) -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS))


def pieces(text: str) -> list[bytes]:
    """The whole text in pieces, so that the dictionary helps all along it."""
    raw = text.encode("utf-8", "surrogatepass")
    return [raw[i : i + PIECE] for i in range(0, len(raw), PIECE)]


def _dictionary(texts: list[str]) -> bytes:
    """A trained dictionary; where there is too little text to train one, the text itself."""
    samples = [p for t in texts for p in pieces(t) if len(p) >= 16]
    try:
        return zstandard.train_dictionary(DICT_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICT_BYTES:]


class Sizer:
    """Features of a text from its compressed sizes under the two dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        self._by = []
        for raw in (good, bad):
            d = zstandard.ZstdCompressionDict(raw) if raw else None
            if d is not None:
                d.precompute_compress(LEVEL)
            self._by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False))

    def __call__(self, text: str | None) -> tuple[float, ...]:
        """Normalised difference (above 0: nearer to good), size over the text's
        own and its square; nan for null and empty texts."""
        cut = pieces(text or "")
        if not cut:
            return (math.nan,) * FEATURES
        good, bad = (sum(len(c.compress(p)) for p in cut) for c in self._by)
        size = min(good, bad) / sum(map(len, cut))
        return (bad - good) / (bad + good), size, size * size


def logistic(x: np.ndarray, y: np.ndarray, share: np.ndarray, ridge: float = 0.01) -> tuple[np.ndarray, np.ndarray, float]:
    """Means, weights and bias by Newton's method, with a light ridge on the
    standardised weights; ``share`` is how much each row counts."""
    share = share / share.mean()
    known = ~np.isnan(x)
    mean = (np.where(known, x, 0.0) * share[:, None]).sum(axis=0) / (known * share[:, None]).sum(axis=0)
    x = np.where(known, x, mean)
    scale = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=share))
    scale[scale == 0] = 1.0
    z = np.column_stack([(x - mean) / scale, np.ones(len(x))])
    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (share * (p - y)) + ridge * w
        h = (z * (share * p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 3.0 / np.abs(step).max())
        if np.abs(step).max() < 1e-9:
            break
    return mean, w[:-1] / scale, float(w[-1])


def settled(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) of the ids with one label of 0 or 1."""
    return labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("__hi")).filter("y = __hi").select("doc_id", "y")


def class_counts(docs: DataFrame, labels: DataFrame, label: str) -> dict[int, int]:
    """How many labelled ids of each class have a text in ``docs``."""
    found = settled(labels, label).join(docs.select("doc_id"), "doc_id", "left_semi").groupBy("y").count()
    return {0: 0, 1: 0} | {int(r["y"]): r["count"] for r in found.collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """At most MAX_DOCS texts a class, in hash order, up to MAX_BYTES in all.

    Rows without an id or a label of 0 or 1 and ids with both labels are left out.
    """
    one = settled(labels, label)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = one.filter("y = 0").orderBy(*order).limit(MAX_DOCS).unionByName(one.filter("y = 1").orderBy(*order).limit(MAX_DOCS))
    texts = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min("y").alias("y"), F.min("text").alias("text"))
    sized = texts.select("y", F.xxhash64("doc_id").alias("h"), "doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).alias("n"))
    sizes = sized.select("y", "h", "doc_id", "n").collect()  # at most 2 * MAX_DOCS rows of numbers
    kept, used = [], {0: 0, 1: 0}
    for r in sorted(sizes, key=lambda r: (r["h"], r["doc_id"])):
        if used[r["y"]] + r["n"] <= MAX_BYTES:
            used[r["y"]] += r["n"]
            kept.append(r["doc_id"])
    return sized.filter(F.col("doc_id").isin(kept))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality") -> Model:
    """Train on ``labels`` (doc_id, label 0 or 1) and the texts of ``docs``.

    Of each class every other text of the sample trains its dictionary and the
    rest the curve, where a class counts by all its labelled texts.  Where a
    class has no text the curve is the smoothed share of label 1.
    """
    rows = sorted(labelled_sample(docs, labels, label).collect(), key=lambda r: (r["h"], r["doc_id"]))
    by = {y: [r["text"] or "" for r in rows if r["y"] == y] for y in (0, 1)}
    n = class_counts(docs, labels, label)
    prior = (n[1] + 1) / (n[0] + n[1] + 2)
    if min(len(by[0]), len(by[1])) < 2:
        return Model(b"", b"", np.zeros(FEATURES), np.zeros(FEATURES), math.log(prior / (1 - prior)))
    good, bad = _dictionary(by[1][::2]), _dictionary(by[0][::2])
    size = Sizer(good, bad)
    x = np.array([size(t) for y in (0, 1) for t in by[y][1::2]])
    y = np.array([float(y) for y in (0, 1) for _ in by[y][1::2]])
    share = np.array([n[y] / len(by[y]) for y in (0, 1) for _ in by[y][1::2]])
    return Model(good, bad, *logistic(x, y, share))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """(doc_id, score) for each row; the whole text counts, however long.

    Null and empty texts get the curve's value at the mean text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.good, model.bad)
        for batch in batches:
            x = np.array([size(t.as_py()) for t in batch.column(1)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.curve(x), pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The rows of ``docs``, all their columns, that score at least ``cut``; one
    pass, as the texts pass the scorer anyway."""
    model = fit(docs, labels.filter(fold("doc_id") != 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = Sizer(model.good, model.bad)
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            x = np.array([size(t.as_py()) for t in text]).reshape(-1, FEATURES)
            yield batch.filter(pa.array(model.curve(x) >= cut))

    return docs.mapInArrow(run, docs.schema)


def classify(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``.

    Fold 0 is held out from learning.  Rows without doc_id are scored, and not
    held out.  Repeated rows get the same score.  Without labels every score is
    one half.
    """
    model = fit(docs, labels.filter(fold("doc_id") != 0))
    return score(docs, model).select(
        "doc_id", F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out"), "score", F.when(F.col("score") >= cut, 1).otherwise(0).alias("predicted")
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
