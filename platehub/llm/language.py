"""Language identification by error-correcting output codes (operator 12).

Every language has a codeword of +1 and -1.  For each bit a binary classifier over
byte n-grams (log ratio of the n-gram's mean share in the languages of +1 to that
in the languages of -1, averaged over a text) predicts its sign.  A text gets the
language of the nearest codeword under loss-weighted decoding: the losses of the
bits are summed with weights that say how often a bit is right on texts of that
language.  Texts for which another codeword is nearly as near are flagged.

The classifiers count n-grams of one half of a sample and take margins, weights and
accuracies from the other half.  Of each language the sample holds about
2 * MAX_DOCS whole texts, chosen by hash, or all it has; only n-gram counts and
margins of the sample reach the driver: BUCKETS numbers a language and partition of
the sample, and one number a bit and text.  Prediction is one pass over the table
without a shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import Scratch

#: Texts of a language in each half of the sample, about.
MAX_DOCS = 2000
#: Partitions in which the sample is read.
PARTS = 8
ORDERS = (2, 3, 4)
BUCKETS = 1 << 16
#: Added to each count.
SMOOTH = 0.1
#: How steeply the loss of a bit grows with its margin.
SHARP = 8.0
#: Losses nearer than this to the best are ambiguous.
MARGIN = 1.0
#: Up to so many languages the code has a bit for each way to part them.
EXHAUSTIVE = 6
#: Bits beyond that, for each doubling of the languages, and draws to choose from.
DENSITY, DRAWS = 12, 64
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: N-grams looked up at a time.
PIECE = 1 << 20

_CLEAN = np.arange(256, dtype=np.uint8)
_CLEAN[:128] = 32
_CLEAN[97:123] = np.arange(97, 123)
_CLEAN[65:91] = np.arange(97, 123)


def codewords(k: int) -> np.ndarray:
    """k distinct rows of +1 and -1, no column constant.

    Up to EXHAUSTIVE languages, all ways to part them in two; else, of DRAWS random
    codes, the one with the greatest least distance of two rows.
    """
    if k < 2:
        return np.ones((k, 0), dtype=np.int8)
    if k <= EXHAUSTIVE:
        bits = np.arange(1, 2 ** (k - 1))[None, :] >> np.arange(k)[:, None] & 1
        return (1 - 2 * bits).astype(np.int8)
    rng = np.random.default_rng(k)
    best, apart = None, -1
    for _ in range(DRAWS):
        code = rng.choice(np.array([-1, 1], dtype=np.int8), (k, DENSITY * math.ceil(math.log2(k))))
        code = code[:, np.abs(code.sum(axis=0, dtype=np.int64)) < k]
        agree = code.astype(np.int64) @ code.T.astype(np.int64)
        np.fill_diagonal(agree, -code.shape[1])
        least = int((code.shape[1] - agree.max()) // 2)
        if least > apart:
            best, apart = code, least
    return best


def cleaned(text: str | None) -> np.ndarray:
    """The bytes of the lower-cased text, other ASCII than letters as one space; empty
    if there is no letter."""
    raw = np.frombuffer((text or "").lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = _CLEAN[raw]
    if not ((out >= 97) & (out < 123)).any() and not any(c.isalpha() for c in text or ""):
        return out[:0]
    gap = out == 32
    gap[1:] &= gap[:-1]
    gap[:1] = False
    return out[~gap]


def grams(clean: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the n-grams of a text with a space at either end, piece by piece."""
    padded = np.concatenate(([32], clean, [32])).astype(np.uint32)
    for at in range(0, len(padded), PIECE):
        part = padded[at : at + PIECE + max(ORDERS) - 1]
        for n in ORDERS:
            end = min(PIECE, len(part) - n + 1)
            if end > 0:
                key = part[:end].copy()
                for i in range(1, n):
                    key = key << np.uint32(8) | part[i : i + end]
                key = (key ^ (key >> np.uint32(15))) * np.uint32(2654435761) + np.uint32(n * 40503)
                yield (key ^ (key >> np.uint32(13))) * np.uint32(2246822519) >> np.uint32(16)


@dataclass
class Model:
    """Codewords, the classifiers' weights and the weights of their losses."""

    languages: list[str]
    code: np.ndarray
    weight: np.ndarray  # BUCKETS x bits
    middle: np.ndarray
    half: np.ndarray
    trust: np.ndarray  # languages x bits, rows add up to 1


def margins(text: str | None, weight: np.ndarray) -> np.ndarray | None:
    """Mean weight of the text's n-grams for each bit; None without a letter."""
    clean = cleaned(text)
    if not len(clean):
        return None
    total, n = np.zeros(weight.shape[1]), 0
    for g in grams(clean):
        total += weight.take(g, axis=0).sum(axis=0, dtype=np.float64)
        n += len(g)
    return total / n


def fold(doc_id: str) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(FOLDS))


def labelled_sample(docs: DataFrame, lang: str = "lang") -> DataFrame:
    """(lang, half, text) of about 2 * MAX_DOCS documents of each language, chosen by
    hash of the id; rows without lang or doc_id are left out."""
    known = docs.filter(F.col(lang).isNotNull() & F.col("doc_id").isNotNull()).select(F.col(lang).alias("lang"), F.xxhash64("doc_id").alias("h"), "text")
    # One row for each language; the model has far more of each, so this can be broadcast.
    rates = [(r["lang"], min(1 << 20, -(-((2 * MAX_DOCS) << 20) // r["count"]))) for r in known.groupBy("lang").count().collect()]
    rate = docs.sparkSession.createDataFrame(rates, "lang string, rate long")
    chosen = known.join(F.broadcast(rate), "lang").filter(F.pmod("h", F.lit(1 << 20)) < F.col("rate"))
    return chosen.select("lang", F.pmod(F.shiftright("h", 20), F.lit(2)).cast("int").alias("half"), "text")


def count_grams(sample: DataFrame) -> dict[str, np.ndarray]:
    """N-gram counts of each language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = counts.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                clean = cleaned(text.as_py())
                for g in grams(clean) if len(clean) else ():
                    held += np.bincount(g, minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array([c.tobytes() for c in counts.values()], pa.binary())], ["lang", "counts"])

    out: dict[str, np.ndarray] = {}
    for r in sample.select("lang", "text").coalesce(PARTS).mapInArrow(run, "lang string, counts binary").collect():
        out[r["lang"]] = out.get(r["lang"], 0) + np.frombuffer(r["counts"], dtype=np.int64)
    return out


def margins_of(sample: DataFrame, weight: np.ndarray) -> list[tuple[str, np.ndarray]]:
    """(lang, margins) of the texts that have a letter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(lang, margins(text.as_py(), weight)) for lang, text in zip(batch.column(0).to_pylist(), batch.column(1))]
            found = [(lang, m) for lang, m in found if m is not None]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.string()), pa.array([x[1].tolist() for x in found], pa.list_(pa.float64()))], ["lang", "margins"])

    rows = sample.select("lang", "text").coalesce(PARTS).mapInArrow(run, "lang string, margins array<double>").collect()
    return [(r["lang"], np.array(r["margins"])) for r in rows]


def train(counts: dict[str, np.ndarray], code: np.ndarray) -> np.ndarray:
    """Weights of the classifiers, BUCKETS x bits; each language counts alike."""
    share = np.stack([(counts[k] + SMOOTH) / (counts[k].sum() + SMOOTH * BUCKETS) for k in sorted(counts)])
    one = code.T == 1
    high = one @ share / one.sum(axis=1, keepdims=True)
    low = ~one @ share / (~one).sum(axis=1, keepdims=True)
    return np.ascontiguousarray(np.log(high / low).T.astype(np.float32))


def fit(docs: DataFrame, lang: str = "lang") -> Model:
    """Train on text and ``lang`` of ``docs``.  Without a language every text is
    unknown; with one, all with a letter have it."""
    scratch = Scratch(docs.sparkSession, "language")
    sample = scratch.cut(labelled_sample(docs, lang))
    counts = count_grams(sample.filter("half = 0"))
    for r in sample.select("lang").distinct().collect():
        counts.setdefault(r["lang"], np.zeros(BUCKETS, dtype=np.int64))
    languages = sorted(counts)
    code = codewords(len(languages))
    weight = train(counts, code) if len(languages) > 1 else np.zeros((BUCKETS, 0), dtype=np.float32)
    seen = margins_of(sample.filter("half = 1"), weight) if len(languages) > 1 else []
    scratch.drop(sample)
    return Model(languages, code, weight, *calibrate(languages, code, seen))


def calibrate(languages: list[str], code: np.ndarray, seen: list[tuple[str, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Middle and half distance of the margins' class means, and each bit's
    smoothed accuracy on each language, rows adding up to 1."""
    bits = code.shape[1]
    if not bits:
        return np.zeros(0), np.ones(0), code.astype(float)
    rows = {k: np.array([m for lang, m in seen if lang == k]).reshape(-1, bits) for k in languages}
    mean = np.array([rows[k].mean(axis=0) if len(rows[k]) else np.full(bits, np.nan) for k in languages]).reshape(len(languages), bits)
    middle, half = np.zeros(bits), np.ones(bits)
    for b in range(bits):
        high, low = mean[code[:, b] == 1, b], mean[code[:, b] == -1, b]
        if not np.isnan(high).all() and not np.isnan(low).all():
            high, low = np.nanmean(high), np.nanmean(low)
            if high > low:
                middle[b], half[b] = (high + low) / 2, (high - low) / 2
    trust = np.array([((np.sign(rows[k] - middle) == c).sum(axis=0) + 1) / (len(rows[k]) + 2) for k, c in zip(languages, code)]).reshape(len(languages), bits)
    return middle, half, trust / np.maximum(trust.sum(axis=1, keepdims=True), 1e-12)


def decode(model: Model, text: str | None) -> tuple[str, float, str | None, bool]:
    """Language, score, the next best language, and whether that is nearly as near."""
    m = margins(text, model.weight) if model.languages else None
    if m is None:
        return UNKNOWN, 0.0, None, False
    if len(model.languages) == 1:
        return model.languages[0], 1.0, None, False
    z = (m - model.middle) / model.half
    loss = (model.trust * np.logaddexp(0.0, -SHARP * model.code * z)).sum(axis=1)
    order = np.argsort(loss, kind="stable")
    score = 1 / np.exp(loss[order[0]] - loss).sum()
    return model.languages[order[0]], float(score), model.languages[order[1]], bool(loss[order[1]] - loss[order[0]] < MARGIN)


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, runner_up, ambiguous for each row of ``docs``; the
    whole text counts.

    Null texts and texts without a letter are UNKNOWN with score 0; equally near
    languages go by name.  Repeated rows get the same result, and rows without
    doc_id one of their own; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [decode(model, t.as_py()) for t in batch.column(1)]
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "lang_pred", "score", "runner_up", "ambiguous"])

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(run, "doc_id long, lang_pred string, score double, runner_up string, ambiguous boolean")


def detect(docs: DataFrame) -> DataFrame:
    """:func:`identify` with a model of the documents outside the held-out fold, and
    held_out; rows without doc_id are neither learned from nor held out."""
    model = fit(docs.filter(fold("doc_id") != HELD_OUT))
    return identify(docs, model).withColumn("held_out", F.coalesce(fold("doc_id") == HELD_OUT, F.lit(False))).select("doc_id", "held_out", "lang_pred", "score", "runner_up", "ambiguous")


def op12_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document."""
    return detect(spark.read.parquet(f"{sf_dir}/documents.parquet"))
