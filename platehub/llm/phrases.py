r"""Phrase collocations by Toivonen's sampling (operator 13).

All words and phrases of up to four words that a language holds at least LEAST times
are counted exactly.

1. A sample of the documents (one in SAMPLE, by hash of the id) proposes the phrases
   it holds SAMPLE_LEAST times or more.
2. A pass over all documents counts the proposed phrases and their negative border:
   phrases whose parts without the last and without the first word are both proposed.
3. Where a border phrase is frequent, the proposal failed: frequent phrases join it,
   and further passes count the phrases that the new border adds, until a pass finds
   no frequent one.  Each such pass reaches one word further, so there are few.

Up to here phrases are 64-bit hashes, dealt to buckets by their high bits; a proposal
is a bit for each hash prefix, 2**MOST bits at most (256 MB), as many as a quarter of
the text's bytes where that is less, so what is broadcast is bounded; the driver holds
SLICE bytes of it at a time.  Hashes that share a bit only add phrases to be counted.  The last pass counts the phrases that
remain by their words and not by hashes, and drops what is too rare, so counts are exact.

Bounds: a map task holds FLUSH words at a time (a longer text as a whole, about 100 bytes
a word); a bucket receives about BUCKET_BYTES times a small factor, as their number grows
with the text.  Scores are joins and groupings of the counted phrases; words, which
may be part of most phrases, are salted.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .packed import planes, unplanes
from .scratch import Scratch
from .tokens import PLAIN, Prefix, U, byte_views, mix

#: Words of the longest phrase, and its least count.
WORDS = 4
LEAST = 30
#: One document in so many is in the sample, and a phrase's least count there: of
#: phrases counted LEAST times, 99.5 % reach it.
SAMPLE = 4
SAMPLE_LEAST = 2
#: A phrase goes if a longer one around it has this share of its count, in hundredths.
COVERED = 80
TOP = 2000
SCALE = 2_000_000
#: Bits of a proposal: 2**FEWEST to 2**MOST.
FEWEST, MOST = 20, 31
#: Bytes of a proposal that the driver holds and sends at a time.
SLICE = 32 << 20
#: Bytes of text for each bucket of hashes.
BUCKET_BYTES = 4 << 20
#: Words counted at a time, by hashes and as themselves, and bytes hashed at a time.
FLUSH = 1_000_000
NAMED = 250_000
CHUNK = 1 << 20
#: Shares into which a word's joins, and a language's ranking, are dealt.
SALTS = 16
UNKNOWN = "und"

_STEP = U(0xD6E8FEB86659FD93)
_LOWER = PLAIN.copy()
_LOWER[65:91] = PLAIN[97:123]
_WORD = np.ones(256, dtype=bool)
_WORD[list(b" \t.,;:!?\n\x0b\x0c\r")] = False
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(b".,;:!?\n\x0b\x0c\r")] = True
_WORDS = re.compile(rb"[^\x20\x09.,;:!?\x0A-\x0D]+")
_END = np.frombuffer(b"\n", dtype=np.uint8)


def chunks(texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The texts, a break behind each, in chunks of about CHUNK bytes that end
    between words."""
    held: list[np.ndarray] = []
    size = 0
    for text in texts:
        while len(text) > CHUNK:
            inside = _WORD[text[CHUNK:]]
            stop = CHUNK + int(inside.argmin()) if not inside.all() else len(text)
            yield np.concatenate([*held, text[:stop]])
            held, size, text = [], 0, text[stop:]
        held += [text, _END]
        size += len(text) + 1
        if size > CHUNK:
            yield np.concatenate(held)
            held, size = [], 0
    if held:
        yield np.concatenate(held)


def hashed_words(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and number of the piece of each word."""
    hashes, pieces, breaks = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)], 0
    for text in chunks(texts):
        inside = np.zeros(len(text) + 2, dtype=np.int8)
        inside[1:-1] = _WORD[text]
        edges = np.flatnonzero(np.diff(inside))
        hashes.append(Prefix(text, _LOWER)(edges[::2], edges[1::2]))
        passed = np.cumsum(_BREAK[text])
        pieces.append(passed[edges[::2]] + breaks)
        breaks += int(passed[-1])
    return np.concatenate(hashes), np.concatenate(pieces)


def keys_of(words: np.ndarray, pieces: np.ndarray, lang: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For phrases of 1 to WORDS words from each word on: their keys, and whether
    they stay within a piece."""
    seed = U(int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little"))
    state = words + seed
    for k in range(1, WORDS + 1):
        if k > 1:
            state = mix(state[:-1]) * _STEP + words[k - 1 :]
        yield mix(state + U(k)), pieces[: len(state)] == pieces[k - 1 :]


def proposed(bits: np.ndarray | list[np.ndarray], keys: np.ndarray) -> np.ndarray:
    """Whether the bits, whole or in slices, hold each key."""
    parts = bits if isinstance(bits, list) else [bits]
    each = len(parts[0]).bit_length() + 2
    at = keys >> U(64 - (each + len(parts).bit_length() - 1))
    if len(parts) == 1:
        return _held(parts[0], at)
    out, part, at = np.zeros(len(keys), dtype=bool), at >> U(each), at & U((1 << each) - 1)
    for k, held in enumerate(parts):
        some = np.flatnonzero(part == k)
        out[some] = _held(held, at[some])
    return out


def _held(bits: np.ndarray, at: np.ndarray) -> np.ndarray:
    return (bits[at >> U(3)] >> (at & U(7)).astype(np.uint8) & 1).astype(bool)


def with_border(keys: list[tuple[np.ndarray, np.ndarray]], bits: np.ndarray | list[np.ndarray]) -> list[np.ndarray]:
    """For each length, whether a phrase is proposed or of the negative border."""
    out, below = [], None
    for key, whole in keys:
        counted = whole if below is None else whole & below[:-1] & below[1:]
        out.append(counted)
        below = np.zeros(len(key), dtype=bool)
        below[counted] = proposed(bits, key[counted])
    return out


def by_language(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[tuple[str, list[np.ndarray]]]:
    """Texts of a language, about ``flush`` words (by their bytes) at a time."""
    held: dict[str, list[np.ndarray]] = {}
    size: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), byte_views(batch.column(1))):
            held.setdefault(lang, []).append(text.copy())
            size[lang] = size.get(lang, 0) + len(text)
            if size[lang] > 6 * flush:
                yield lang, held.pop(lang)
                size[lang] = 0
    yield from held.items()


class Counter:
    """Counting passes over the documents, by hashed phrases.

    Bits are tables, a row for each bucket that has any; a proposal is the union of
    some.  The driver reads and sends them a slice at a time and keeps none.
    """

    def __init__(self, docs: DataFrame, buckets: int, bits: int, scratch: Scratch):
        self.docs, self.buckets, self.bits, self.scratch = docs, buckets, bits, scratch
        self.slices = min(buckets, max(1, (1 << bits) // 8 // SLICE))

    def read(self, tables: list[DataFrame]) -> Iterator[np.ndarray]:
        """The slices of the tables' union."""
        each = (1 << self.bits) // 8 // self.buckets
        for k in range(self.slices):
            out = np.zeros((1 << self.bits) // 8 // self.slices, dtype=np.uint8)
            for table in tables:
                rows = table.filter(F.col("slice") == k).select("bucket", "bits").toArrow()  # SLICE bytes
                for bucket, bits in zip(rows.column("bucket").to_pylist(), rows.column("bits")):
                    at = bucket % (self.buckets // self.slices) * each
                    out[at : at + each] |= np.frombuffer(bits.as_buffer(), dtype=np.uint8)
            yield out

    def send(self, tables: list[DataFrame]) -> list:
        sc = self.docs.sparkSession.sparkContext
        return [sc.broadcast(part.tobytes()) for part in self.read(tables)]

    def beyond(self, table: DataFrame, known: list[DataFrame]) -> bool:
        """Whether the table has bits that the known ones have not."""
        return any((a & ~b).any() for a, b in zip(self.read([table]), self.read(known)))

    def frequent(self, docs: DataFrame, least: int, known: list | None = None, done: list | None = None) -> DataFrame:
        """Bits of the phrases of ``docs`` that occur ``least`` times, among all, or
        among those that ``known``, as sent, proposes or borders on and ``done`` does not."""
        shared = known, done
        shift, wide, together = (self.buckets - 1).bit_length(), self.bits, self.buckets // self.slices

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            new, old = ([np.frombuffer(b.value, dtype=np.uint8) for b in parts] if parts is not None else None for parts in shared)
            for lang, texts in by_language(batches, FLUSH):
                keys = list(keys_of(*hashed_words(texts), lang))
                counted = [whole for _, whole in keys] if new is None else with_border(keys, new)
                if old is not None:
                    counted = [a & ~b for a, b in zip(counted, with_border(keys, old))]
                key, n = np.unique(np.concatenate([k[c] for (k, _), c in zip(keys, counted)]), return_counts=True)
                if not len(key):
                    continue
                bucket = (key >> U(64 - shift)).astype(np.int32) if shift else np.zeros(len(key), dtype=np.int32)
                rest = key << U(shift) >> U(16)
                cut = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                ends = np.append(cut[1:], len(key))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cut], pa.int32()), pa.array([planes(rest[a:b], 6) for a, b in zip(cut, ends)], pa.binary()), pa.array([planes(n[a:b], 4) for a, b in zip(cut, ends)], pa.binary())],
                    ["bucket", "keys", "counts"],
                )

        def settle(table: pa.Table) -> pa.Table:
            key = np.concatenate([unplanes(x.as_py(), 6) for x in table.column("keys")])
            n = np.concatenate([unplanes(x.as_py(), 4) for x in table.column("counts")])
            order = np.argsort(key)
            key, n = key[order], n[order]
            begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            found = key[begin[np.add.reduceat(n, begin) >= least]]
            held = np.zeros(1 << (wide - shift), dtype=np.uint8)
            held[(found >> U(48 - (wide - shift))).astype(np.int64)] = 1
            bucket = table.column("bucket")[0].as_py()
            return pa.table({"bucket": pa.array([bucket], pa.int32()), "bits": pa.array([np.packbits(held, bitorder="little").tobytes()], pa.binary()), "slice": pa.array([bucket // together], pa.int32())})

        rows = docs.mapInArrow(count, "bucket int, keys binary, counts binary").groupBy("bucket").applyInArrow(settle, "bucket int, bits binary, slice int")
        return self.scratch.cut(rows, partition_by="slice")

    def by_words(self, tables: list[DataFrame], least: int) -> DataFrame:
        """(lang, k, phrase, a) of the phrases that the tables' bits hold and that occur
        ``least`` times, and of all words of a language as the phrase of no word."""
        shared = self.send(tables)

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = [np.frombuffer(b.value, dtype=np.uint8) for b in shared]
            for lang, texts in by_language(batches, NAMED):
                keys = list(keys_of(*hashed_words(texts), lang))
                words = _WORDS.findall(b"\n".join(t.tobytes() for t in texts).lower())
                names: dict[bytes, int] = {}
                ids = np.array([names.setdefault(w, len(names)) for w in words], dtype=np.int64)
                out, name = [(0, b"", len(words))] if words else [], ids
                below = None
                for k, (key, whole) in enumerate(keys, 1):
                    here = np.flatnonzero(whole if below is None else whole & below[:-1] & below[1:])
                    here = here[proposed(held, key[here])]
                    # A phrase's name: that of its first words, and its last word.
                    value = name[here] * len(ids) + ids[here + k - 1] if k > 1 else ids[here]
                    _, first, inverse, n = np.unique(value, return_index=True, return_inverse=True, return_counts=True)
                    out += [(k, b" ".join(words[i : i + k]), c) for i, c in zip(here[first].tolist(), n.tolist())]
                    name, below = np.full(len(key), -1, dtype=np.int64), np.zeros(len(key), dtype=bool)
                    name[here], below[here] = inverse, True
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(out), pa.string()), pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary()), pa.array([x[2] for x in out], pa.int64())],
                    ["lang", "k", "phrase", "n"],
                )

        rows = self.docs.mapInArrow(count, "lang string, k int, phrase binary, n long")
        counts = rows.groupBy("lang", "k", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("a"))
        out = self.scratch.cut(counts.filter((F.col("a") >= least) | (F.col("k") == 0)))
        _forget(shared)
        return out


def _forget(sent: list | None) -> None:
    for part in sent or []:
        part.destroy()


def mine(docs: DataFrame, scratch: Scratch, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """(lang, k, phrase, a): every phrase of 1 to WORDS words that the texts of a
    language hold ``least`` times or more, overlaps included, with its count; and for
    each language with a word the phrase of no word (k = 0) with the count of all words.

    A to Z count as a to z; phrases stay within pieces, which end at any of
    ``.,;:!?`` and line breaks.  Null lang is UNKNOWN; null and empty texts hold no
    word; repeated rows count each time, with or without doc_id; other columns are
    ignored.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("binary").alias("text"), F.pmod(F.xxhash64("doc_id"), F.lit(SAMPLE)).alias("part"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = 1 << max(0, (size // BUCKET_BYTES).bit_length())
    counter = Counter(rows.select("lang", "text"), buckets, max(FEWEST, min(MOST, (size // 4).bit_length())), scratch)
    known = [counter.frequent(rows.filter("part = 0").select("lang", "text"), SAMPLE_LEAST)]
    new, old = counter.send(known), None
    every = [counter.frequent(counter.docs, least, new)]
    while counter.beyond(every[-1], known):  # the border failed
        known.append(every[-1])
        _forget(old)
        new, old = counter.send(known), new
        every.append(counter.frequent(counter.docs, least, new, old))
    _forget(new)
    _forget(old)
    out = counter.by_words(every, least)
    scratch.drop(known[0], *every)
    return out


def _salt(phrase: str) -> Column:
    return F.pmod(F.xxhash64(phrase), F.lit(SALTS)).cast("int")


def collocations(counts: DataFrame, top: int = TOP) -> DataFrame:
    """Each language's first ``top`` phrases of :func:`mine` by score: lang, rank,
    phrase, a, l, r, n, score.

    A phrase of two words or more with count a, cut into parts with counts l and r, has
    the score floor(SCALE * a / (l + r)) of its lowest cut, the first of equal ones.
    Phrases inside a longer one with COVERED hundredths of their count are left out.
    Order: score, then a, descending, then the phrase by its bytes.
    """
    phrases = counts.filter("k >= 2")
    # Words are parts of most phrases: their joins are dealt to SALTS shares.
    shares = F.when(F.col("k") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    parts = counts.filter(F.col("k").between(1, WORDS - 1)).select(F.col("lang"), F.col("phrase").alias("part"), F.col("a").alias("f"), F.explode(shares).alias("salt"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut")).withColumn("first", F.expr("substring_index(phrase, ' ', cut)"))
    cuts = cuts.withColumn("rest", F.expr("substring(phrase, length(first) + 2)"))
    cuts = cuts.withColumn("salt", F.when(F.col("cut") == 1, _salt("phrase")).otherwise(0)).join(parts.select("lang", F.col("part").alias("first"), F.col("f").alias("l"), "salt"), ["lang", "first", "salt"])
    cuts = cuts.withColumn("salt", F.when(F.col("cut") == F.col("k") - 1, _salt("phrase")).otherwise(0)).join(parts.select("lang", F.col("part").alias("rest"), F.col("f").alias("r"), "salt"), ["lang", "rest", "salt"])
    score = F.expr(f"cast(a as decimal(20, 0)) * cast({SCALE} as decimal(7, 0)) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    lowest = cuts.groupBy("lang", "k", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low"))
    words = F.split("phrase", " ")
    inner = [F.array_join(F.slice(words, i + 1, m), " ") for m in range(2, WORDS) for i in range(WORDS - m + 1)]
    sizes = [(m, i + m) for m in range(2, WORDS) for i in range(WORDS - m + 1)]
    inside = F.array(*[F.when((F.col("k") > m) & (F.col("k") >= end), sub) for (m, end), sub in zip(sizes, inner)])
    around = phrases.filter("k > 2").select("lang", "a", F.explode(inside).alias("phrase")).filter("phrase is not null").groupBy("lang", "phrase").agg(F.max("a").alias("around"))
    covered = F.col("around").cast("decimal(20, 0)") * 100 >= F.col("a").cast("decimal(20, 0)") * COVERED
    kept = lowest.join(around, ["lang", "phrase"], "left").filter(F.coalesce(~covered, F.lit(True))).select("lang", "phrase", "a", "low.score", "low.l", "low.r")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    first = kept.withColumn("salt", _salt("phrase")).withColumn("rank", F.row_number().over(W.partitionBy("lang", "salt").orderBy(*order))).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(*order))).filter(F.col("rank") <= top)
    totals = counts.filter("k = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best collocations of each language of the documents."""
    scratch = Scratch(spark, "phrases")
    return collocations(mine(spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch))


OP13_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, '{UNKNOWN}') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
lists AS (SELECT lang, row_number() OVER () AS piece, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces),
words AS (SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM lists),
runs AS (
  SELECT lang, w, lead(w, 1) OVER following AS w2, lead(w, 2) OVER following AS w3, lead(w, 3) OVER following AS w4
  FROM words WINDOW following AS (PARTITION BY piece ORDER BY i)
),
grams AS (
  SELECT lang, 1 AS k, w AS phrase FROM runs
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM runs WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM runs WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM runs WHERE w4 IS NOT NULL
),
totals AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
f AS (SELECT lang, k, phrase, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= {LEAST}),
parted AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2),
cuts AS (
  SELECT p.lang, p.phrase, p.a, c.cut, x.a AS l, y.a AS r, CAST({SCALE} * p.a::HUGEINT // (x.a + y.a) AS BIGINT) AS score
  FROM parted p JOIN (SELECT unnest([1, 2, 3]) AS cut) c ON c.cut < p.k
  JOIN f x ON x.lang = p.lang AND x.phrase = array_to_string(p.ws[1:c.cut], ' ')
  JOIN f y ON y.lang = p.lang AND y.phrase = array_to_string(p.ws[c.cut + 1:p.k], ' ')
),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_parts AS (
  SELECT p.lang, array_to_string(p.ws[s.i:s.i + m.m - 1], ' ') AS phrase, max(p.a) AS around
  FROM parted p, (SELECT unnest([2, 3]) AS m) m, (SELECT unnest([1, 2, 3]) AS i) s
  WHERE m.m < p.k AND s.i + m.m - 1 <= p.k GROUP BY ALL
),
ranked AS (
  SELECT c.*, row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, c.phrase) AS rank
  FROM lowest c LEFT JOIN inner_parts i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE i.around IS NULL OR 100 * i.around < {COVERED} * c.a
)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, t.n, r.score FROM ranked r JOIN totals t ON t.lang = r.lang WHERE r.rank <= {TOP}
"""
