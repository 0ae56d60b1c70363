"""Removal of repeated byte strings (operator 10).

Every byte that is covered by a string of LENGTH bytes which also starts earlier
goes.  Suffixes are compared by their first LENGTH bytes only, so their order is
needed no deeper than that:

1. Sample: of each stretch of LENGTH bytes the GRAM bytes with the smallest hash
   are its sample.  Equal stretches have their sample at the same offset, which
   is what a difference cover gives; samples are sorted, and those that occur
   once are dropped: no suffix that leans on them has an equal.
2. Names: a suffix of the rest is named by its LENGTH bytes.
3. Merge: suffixes meet by their sample, are sorted by name and position, and
   each is compared with its neighbour: one that equals an earlier one is
   repeated.

The README says where this leaves the difference-cover recursion, and why.

Samples and names travel packed, a task sends only the first of what it holds
twice, and a sample that very many suffixes share is dealt out further by their
names.  What comes back is stretches of positions; the texts are joined with them
once, to be cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packed import BUCKET, planes, unplanes
from .scratch import Scratch
from .tokens import PLAIN, Prefix, U, byte_views, mix

LENGTH = 100
GRAM = 36
#: Suffixes that a map task sorts at a time.
FLUSH = 2_000_000
#: Samples that a map task sorts at a time.
SAMPLES = 1_000_000
#: Repeated samples that may be broadcast (8 bytes each).
BROADCAST = 4_000_000
#: Suffixes of one sample that stay together; more are dealt out by name.
TOGETHER = 65_536


def smallest(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    have = 1
    while 2 * have <= width:
        h = np.minimum(h[:-have], h[have:])
        have *= 2
    return np.minimum(h[: len(h) - (width - have)], h[width - have :]) if have < width else h


class Text:
    """A text's sample: ``least[i]`` is the hash that the suffix at i leans on."""

    def __init__(self, raw: np.ndarray, length: int, gram: int):
        self.hash = Prefix(raw, PLAIN)
        at = np.arange(len(raw) - gram + 1)
        self.grams = self.hash(at, at + gram)
        self.width = length - gram + 1
        self.least = smallest(self.grams, self.width)
        self.runs = np.flatnonzero(np.concatenate(([True], self.least[1:] != self.least[:-1])))

    def samples(self) -> np.ndarray:
        """Hashes at the sampled positions."""
        pad = np.zeros(self.width - 1, dtype=np.uint64)
        # A position is sampled if it is the smallest of some stretch around it.
        most = ~smallest(~np.concatenate([pad, self.least, pad]), self.width)
        return self.grams[most == self.grams]


def _buckets(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((key >> U(32)) % U(buckets)).astype(np.int64)


def _cuts(x: np.ndarray) -> list[tuple[int, int]]:
    cut = np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, dtype=np.int64)
    return list(zip(cut, np.append(cut[1:], len(x))))


def _sample(buckets: int, length: int, gram: int):
    """(doc_id, text) -> packed samples with their counts."""

    def flush(held: list) -> pa.RecordBatch:
        value, count = np.unique(np.concatenate(held) if held else np.zeros(0, dtype=np.uint64), return_counts=True)
        b = _buckets(value, buckets)
        order = np.argsort(b, kind="stable")
        value, count, b = value[order], count[order].astype(np.uint64), b[order]
        cuts = _cuts(b)
        return pa.RecordBatch.from_arrays(
            [pa.array([int(b[i]) for i, _ in cuts], pa.int32()), pa.array([planes(value[i:j], 8) for i, j in cuts], pa.binary()), pa.array([planes(count[i:j], 8) for i, j in cuts], pa.binary())],
            ["bucket", "grams", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for raw in byte_views(batch.column(1)):
                if len(raw) >= length:
                    held.append(Text(raw, length, gram).samples())
                    n += len(held[-1])
                if n >= SAMPLES:
                    yield flush(held)
                    held, n = [], 0
        yield flush(held)

    return run


def _repeated(table: pa.Table) -> pa.Table:
    """A bucket's samples that occur twice or more, with their counts."""
    value, count = (np.concatenate([unplanes(x.as_py(), 8) for x in table.column(c)]) for c in ("grams", "counts"))
    value, at = np.unique(value, return_inverse=True)
    total = np.bincount(at, weights=count.astype(np.float64), minlength=len(value))
    twice = total >= 2
    return pa.table({"gram": pa.array(value[twice].view(np.int64)), "n": pa.array(total[twice].astype(np.int64))})


_SENT = "bucket int, names binary, leans binary, docs binary, starts binary, lengths binary"
_LOCAL = -1


def _stretches(doc: np.ndarray, start: np.ndarray, apart: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Where positions, in order, stop following each other, and the lengths."""
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    if apart is not None:
        new[1:] |= apart[1:] != apart[:-1]
    begin = np.flatnonzero(new)
    return begin, np.diff(np.append(begin, len(doc)))


def _suffixes(buckets: int, length: int, gram: int, repeated):
    """(doc_id, text[, grams, counts]) -> packed suffixes that lean on repeated
    samples; those that equal an earlier one of the same flush come back as
    stretches in buckets below 0."""

    def flush(held: list) -> pa.RecordBatch:
        name, lean, deal, doc, start = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((start, doc, name))
        first = np.concatenate(([True], name[order][1:] != name[order][:-1]))
        origin = order[first][np.cumsum(first) - 1]
        again = (doc[order] != doc[origin]) | (start[order] != start[origin])
        out = []
        # Repeated already: stretches only.
        mine = np.sort(order[again])
        mine = mine[np.lexsort((start[mine], doc[mine]))]
        begin, size = _stretches(doc[mine], start[mine])
        if len(begin):
            out.append((_LOCAL - int(doc[mine[0]]) % buckets, b"", b"", doc[mine][begin], start[mine][begin], size))
        send = order[first]
        bucket = _buckets(deal[send], buckets)
        send = send[np.lexsort((start[send], doc[send], bucket))]
        bucket = _buckets(deal[send], buckets)
        for i, j in _cuts(bucket):
            part = send[i:j]
            begin, size = _stretches(doc[part], start[part], lean[part])
            out.append((int(bucket[i]), planes(name[part], 5), planes(lean[part][begin], 4), doc[part][begin], start[part][begin], size))
        cols = list(zip(*out))
        pack = lambda xs: pa.array([planes(x.astype(np.int64).view(np.uint64), 8) for x in xs], pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary()), *map(pack, cols[3:])], ["bucket", "names", "leans", "docs", "starts", "lengths"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for k, (d, raw) in enumerate(zip(ids, byte_views(batch.column(1)))):
                if len(raw) < length:
                    continue
                if repeated is None:
                    known, counts = (np.array(batch.column(c)[k].as_py(), dtype=np.int64) for c in (2, 3))
                    order = np.argsort(known.view(np.uint64))
                    known, counts = known.view(np.uint64)[order], counts[order]
                    hot, hot_counts = known, counts
                else:
                    known, hot, hot_counts = repeated.value
                if not len(known):
                    continue
                text = Text(raw, length, gram)
                value = text.least[text.runs]
                at = np.searchsorted(known, value)
                at[at == len(known)] = 0
                hit = known[at] == value
                if not hit.any():
                    continue
                size = np.diff(np.append(text.runs, len(text.least)))
                start = np.flatnonzero(np.repeat(hit, size))
                name = text.hash(start, start + length)
                spot = np.minimum(np.searchsorted(hot, value[hit]), max(0, len(hot) - 1))
                count = np.where(hot[spot] == value[hit], hot_counts[spot], 0) if len(hot) else np.zeros(len(spot), dtype=np.int64)
                lean, many = np.repeat(value[hit], size[hit]), np.repeat(count, size[hit])
                split = (many * (length - gram) // TOGETHER).astype(np.uint64) + U(1)
                deal = mix(lean + (name % split) * U(0x9E3779B97F4A7C15))
                held.append((name, lean, deal, np.full(len(start), d, dtype=np.int64), start))
                n += len(start)
                if n >= FLUSH:
                    yield flush(held)
                    held, n = [], 0
        if held:
            yield flush(held)

    return run


def _compare(table: pa.Table) -> pa.Table:
    """A bucket's suffixes in order: stretches of those that equal an earlier one."""
    doc, start, size = (np.concatenate([unplanes(x.as_py(), 8).view(np.int64) for x in table.column(c)]) for c in ("docs", "starts", "lengths"))
    if table.column("bucket")[0].as_py() >= 0:
        # A stretch has one sample: 32 bits of it and 40 of each name make the key.
        lean, name = (np.concatenate([unplanes(x.as_py(), w) for x in table.column(c)]) for c, w in (("leans", 4), ("names", 5)))
        name = name ^ (np.repeat(lean, size) << U(32))
        inside = np.arange(len(name)) - np.repeat(np.cumsum(size) - size, size)
        doc, start = np.repeat(doc, size), np.repeat(start, size) + inside
        order = np.lexsort((start, doc, name))
        first = np.concatenate(([True], name[order][1:] != name[order][:-1]))
        origin = order[first][np.cumsum(first) - 1]
        again = order[(doc[order] != doc[origin]) | (start[order] != start[origin])]
        again = again[np.lexsort((start[again], doc[again]))]
        doc, start = doc[again], start[again]
        begin, size = _stretches(doc, start)
        doc, start = doc[begin], start[begin]
    return pa.table({"doc_id": pa.array(doc), "first": pa.array(start), "last": pa.array(start + size - 1)})


def repeated_spans(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc_id, spans): for each document with repeated strings, its removed runs
    as (begin, end) in bytes, in order and apart."""
    scratch = Scratch(spark, "suffixes")
    texts = docs.filter("doc_id is not null and text is not null").select("doc_id", "text")
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    # Two samples in each stretch of bytes that one sample serves, about.
    buckets = max(1, -(-2 * size // (length - gram + 1) // BUCKET))
    sampled = texts.mapInArrow(_sample(buckets, length, gram), "bucket int, grams binary, counts binary")
    grams = scratch.cut(sampled.groupBy("bucket").applyInArrow(_repeated, "gram long, n long"))
    number, total = grams.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, -(-total * (length - gram) // 2 // BUCKET))
    if number <= BROADCAST:
        # 8 bytes each by Arrow; counts go out only where a sample's suffixes are dealt out.
        value = np.sort(grams.select("gram").toArrow().column(0).to_numpy().view(np.uint64))
        many = grams.filter(F.col("n") * (length - gram) >= TOGETHER).orderBy("gram").toArrow()
        many = many.column("gram").to_numpy().view(np.uint64), many.column("n").to_numpy()
        order = np.argsort(many[0])
        known = spark.sparkContext.broadcast((value, many[0][order], many[1][order]))
        sent = texts.mapInArrow(_suffixes(buckets, length, gram, known), _SENT)
    else:
        own = texts.mapInArrow(_own_samples(length, gram), "doc_id long, gram long").join(grams, "gram")
        own = own.groupBy("doc_id").agg(F.collect_list(F.struct("gram", "n")).alias("g"))
        own = texts.join(own, "doc_id").select("doc_id", "text", F.col("g.gram").alias("grams"), F.col("g.n").alias("counts"))
        sent = own.mapInArrow(_suffixes(buckets, length, gram, None), _SENT)
    found = scratch.cut(sent.groupBy("bucket").applyInArrow(_compare, "doc_id long, first long, last long"))
    ordered = F.sort_array(F.collect_list(F.struct(F.col("first").alias("begin"), (F.col("last") + length).alias("end"))))
    return found.groupBy("doc_id").agg(ordered.alias("spans"))


def _own_samples(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
            for d, raw in zip(batch.column(0).to_numpy(zero_copy_only=False), byte_views(batch.column(1))):
                if len(raw) >= length:
                    values.append(np.unique(Text(raw, length, gram).samples()))
                    ids.append(np.full(len(values[-1]), d, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(values).view(np.int64))], ["doc_id", "gram"])

    return run


def _merged(spans: list, n: int) -> list[tuple[int, int]]:
    """Spans, in order, that touch or overlap become one; cut at the text's end."""
    out: list[list[int]] = []
    for s in spans or ():
        begin, end = min(s["begin"], n), min(s["end"], n)
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        elif begin < end:
            out.append([begin, end])
    return [tuple(x) for x in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept, spans = [], []
        for text, found in zip(batch.column(1), batch.column(2)):
            raw = (text.as_py() or "").encode("utf-8")
            runs = _merged(found.as_py(), len(raw))
            at, parts = 0, []
            for begin, end in runs:
                parts.append(raw[at:begin])
                at = end
            kept.append(b"".join(parts) + raw[at:])
            spans.append([{"begin": b, "end": e} for b, e in runs])
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len((t.as_py() or "").encode("utf-8")) for t in batch.column(1)], pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])


def remove_repeats(spark: SparkSession, docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, spans (removed runs) and kept
    (the remaining bytes; a cut may fall inside a character).

    Null texts are empty.  Rows without doc_id keep all they have, and nothing is
    measured against them.  A doc_id on several rows is one document: the same
    start in it is one place.  Other columns are ignored.
    """
    spans = repeated_spans(spark, docs, length, gram)
    return docs.select("doc_id", "text").join(spans, "doc_id", "left").select("doc_id", "text", "spans").mapInArrow(
        _cut, "doc_id long, n_bytes long, spans array<struct<begin:long,end:long>>, kept binary"
    )


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without its repeated 100-byte strings."""
    out = remove_repeats(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

