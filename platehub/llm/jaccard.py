"""N-gram Jaccard join (operator 5): universe-partition pigeonhole.

Two texts link when the Jaccard similarity of their sets of distinct n-word
shingles is at least a threshold.  Sets are put into size bands so that linked
sets lie in one band or in neighbouring ones.  In each band the universe of
shingles is cut into segments by hash.  A set of size s and one no larger, if
linked, differ in at most h = floor((1-t)/(1+t) 2s) shingles, so over any choice
of segments and allowances a (-1: skip, 0: equal, 1: at most one deletion apart)
with sum(a + 1) >= h + 1, some segment is within its allowance.

Each set is indexed in its own band and the next: its segments, and the
one-deletion neighbourhoods of a share of them.  The larger set probes, and
allocates its allowances by cost: segments with few shingles match by chance, so
the cheapest increments are segments with many.  Sets of at most SINGLETONS
shingles use the finest partition, one shingle to a segment.  The few sets whose
segments cannot add up to h + 1 are looked up by single shingles over all texts:
of any floor((1-t) s) + 1 shingles of a set, a linked one shares one.

Signatures travel as packed arrays, one row for each map batch and bucket of
keys; a bucket is sorted in numpy and yields candidate links to the smallest
document of each group of equal signatures.  Copies are one set throughout.
Candidates are verified exactly on the whole texts; groups whose members are not
yet in one component after that are compared block by block, where a link that
joins what is joined already is neither verified nor given: a group yields fewer
links than it has members, and connects all that links connect.

Before texts are compared, candidates pass a bound: each set has a sketch of the
parities of its shingles in about two bits a shingle; where two sets differ in d
shingles, at most d parities differ.  Groups that share a signature by chance, or
a passage, are mostly settled by these bounds alone; the texts of the members
that are not come to the blocks' tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .packed import INDEX, PROBE, SCHEMA, Groups, Packer, buckets_for, rows, tagged
from .scratch import Scratch
from .tokens import U, byte_views, mix, shingles, word_hashes

WORDS = 5
THRESHOLD = Fraction(3, 4)
SINGLETONS = 16
#: Identifiers or shingles that may be broadcast (8 bytes each).
BROADCAST = 2_000_000
#: Rounds of star-shaped follow-up before groups are settled in blocks.
STAR_ROUNDS = 1
#: Members of a group that are compared at a time with as many others, and the
#: shingles they may have together, about.
BLOCK = 2048
SHINGLES = 4_000_000


class Plan:
    """Bands, segments and allowances for a threshold."""

    def __init__(self, threshold: Fraction = THRESHOLD):
        t = Fraction(threshold)
        self.t, self.apart, self.missing = t, (1 - t) / (1 + t), 1 - t
        bounds = [1]
        while bounds[-1] < 1 << 40:
            bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * t.denominator // t.numerator)))
        self.bounds = np.array(bounds)

    def band(self, n: int) -> int:
        return int(np.searchsorted(self.bounds, n, side="right")) - 1

    def segments(self, band: int) -> tuple[int, int, int]:
        """Number of segments, every how many-th has deletions indexed, and the
        least shingles of an indexed segment."""
        top = int(self.bounds[band + 1]) - 1
        return max(1, -(-top // 3)), 1 if top <= 256 else 2 if top <= 1500 else 4, 1 if top <= 64 else 2

    def needed(self, n: int) -> int:
        return int(self.apart * 2 * n) + 1

    def lookups(self, n: int) -> int:
        return int(self.missing * n) + 1


def signatures(sets: np.ndarray, plan: Plan) -> tuple[list[tuple[np.ndarray, int]], bool]:
    """Keys with their roles for one set, and whether it must be looked up by
    single shingles instead of probing."""
    n = len(sets)
    home = plan.band(n)
    out: list[tuple[np.ndarray, int]] = []
    short = False
    for band in (home, home + 1):
        probing = band == home
        top = int(plan.bounds[band + 1]) - 1
        salt = mix(np.array([band], dtype=np.uint64) + U(0x51ED270B))[0]
        if top <= SINGLETONS:
            keys = mix(sets ^ salt)
            k = plan.lookups(n) if probing else 0
            out += [(keys[:k], INDEX | PROBE), (keys[k:], INDEX)]
            continue
        m, every, least = plan.segments(band)
        # Sorted by hash, so shingles of a segment stand together.
        segment = (((sets >> U(32)) * U(m)) >> U(32)).astype(np.int64)
        count = np.bincount(segment, minlength=m)
        used = np.flatnonzero(count)
        inner = mix(sets + salt)
        sums = np.add.reduceat(inner, np.concatenate(([0], np.cumsum(count[used])[:-1])))
        total = np.zeros(m, dtype=np.uint64)
        total[used] = sums

        def key(value, seg, size, space):
            return mix(value + seg.astype(np.uint64) * U(0xC2B2AE3D27D4EB4F) + size.astype(np.uint64) * U(0x9FB21C651E98DF25) + salt + U(space))

        exact = np.flatnonzero(count >= least)
        own = key(total[exact], exact, count[exact], 0)
        marked = np.arange(m) % every == 0
        of_shingle = count[segment]
        gone = (of_shingle > least) & marked[segment]
        without = total[segment[gone]] - inner[gone]
        out.append((key(without, segment[gone], of_shingle[gone] - 1, 1), INDEX))
        if not probing:
            out.append((own, INDEX))
            continue
        # Increments in order of cost: an equal segment of c shingles costs as
        # much as one of c + 1 within one deletion.
        soft = np.flatnonzero(marked & (count > least - 1) & (count > 1))
        cost = np.concatenate([count[exact], count[soft] - 1])
        pick = np.argsort(-cost, kind="stable")
        need = plan.needed(n)
        if len(pick) < need:
            short = True
            out.append((own, INDEX))
            continue
        pick = pick[:need]
        probe = np.zeros(len(exact), dtype=bool)
        probe[pick[pick < len(exact)]] = True
        out += [(own[probe], INDEX | PROBE), (own[~probe], INDEX)]
        near = np.zeros(m, dtype=bool)
        near[soft[pick[pick >= len(exact)] - len(exact)]] = True
        at = np.flatnonzero(near)
        out.append((key(total[at], at, count[at], 1), PROBE))
        drop = near[segment]
        out.append((key(total[segment[drop]] - inner[drop], segment[drop], of_shingle[drop] - 1, 0), PROBE))
    return out, short


_SHORT = -1


def _pack(buckets: int, words: int, plan: Plan):
    """(doc_id, text) -> packed signatures; sets seen before in the task are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        packer, short = Packer(buckets), []
        for batch in batches:
            doc = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            for d, text in zip(doc, byte_views(batch.column(1))):
                s = shingles(word_hashes(text), words)
                mark = _fingerprint(s)
                if not len(s) or mark in seen:
                    continue
                seen.add(mark)
                found, late = signatures(s, plan)
                if late:
                    short.append(d)
                for keys, role in found:
                    packer.add(keys, tagged(np.full(len(keys), d), role))
                if packer.full():
                    yield packer.take()
        yield packer.take()
        if short:
            yield rows([_SHORT], [b""], [np.array(short, dtype="<i8").tobytes()])

    return run


def _fingerprint(s: np.ndarray) -> bytes:
    """128 bits of a set."""
    return np.array([mix(s).sum(dtype=np.uint64), (mix(s ^ U(0xA5A5A5A5A5A5A5A5)) * U(3)).sum(dtype=np.uint64)]).tobytes()


_FOUND = "kind int, a long, b long"
PAIR, GROUP, LATE = 0, 1, 2


def _meet(table: pa.Table) -> pa.Table:
    """One bucket of packed signatures -> links to the smallest document of each
    group of equal keys, and the members of groups of three or more."""
    if table.num_rows and table.column("bucket")[0].as_py() == _SHORT:
        late = np.concatenate([np.frombuffer(x.as_py(), dtype="<i8") for x in table.column("ids")])
        return _found([(LATE, late, late)])
    groups = Groups(table)
    pairs, (name, member) = groups.star(), groups.members(3)
    return _found([(PAIR, pairs[:, 0], pairs[:, 1]), (GROUP, name, member)])


def _found(parts: list) -> pa.Table:
    parts = [(k, np.asarray(a, dtype=np.int64), np.asarray(b, dtype=np.int64)) for k, a, b in parts]
    cat = lambda xs, t: pa.array(np.concatenate(xs) if xs else np.zeros(0, dtype=np.int64), t)
    return pa.table({"kind": cat([np.full(len(a), k) for k, a, _ in parts], pa.int32()), "a": cat([a for _, a, _ in parts], pa.int64()), "b": cat([b for _, _, b in parts], pa.int64())})


def sketch(s: np.ndarray) -> bytes:
    """Parities of a set's shingles in a power of two of bits, at least twice as many."""
    bits = max(64, 2 << int(len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & U(bits - 1)).astype(np.int64), minlength=bits).astype(np.uint8) & 1, bitorder="little").tobytes()


def folded(raw: bytes, size: int) -> np.ndarray:
    """A sketch brought down to ``size`` bytes: parities of halves add up."""
    x = np.frombuffer(raw, dtype=np.uint8)
    return np.bitwise_xor.reduce(x.reshape(-1, size), axis=0)


def shingle_counts(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, mark, sketch) for each row; equal sets have equal
    marks, and texts without words a null one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, marks, sketches = [], [], []
            for text in byte_views(batch.column(1)):
                s = shingles(word_hashes(text), words)
                n.append(len(s))
                marks.append(_fingerprint(s) if len(s) else None)
                sketches.append(sketch(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(marks, pa.binary()), pa.array(sketches, pa.binary())], ["doc_id", "n_shingles", "mark", "sketch"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, mark binary, sketch binary")


def _possible(plan: Plan):
    """(a, b, na, nb, x, y): pairs whose sketches x and y allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb = (batch.column(k).to_numpy(zero_copy_only=False) for k in (2, 3))
            ok = np.zeros(batch.num_rows, dtype=bool)
            for k, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist())):
                size = min(len(x), len(y))
                ok[k] = np.bitwise_count(folded(x, size) ^ folded(y, size)).sum() <= int(plan.apart * int(na[k] + nb[k]))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(ok)), batch.column(1).filter(pa.array(ok))], ["a", "b"])

    return run


def _near(plan: Plan, bits: np.ndarray, n: np.ndarray, i: int, others: np.ndarray) -> np.ndarray:
    """Those of ``others`` that sizes and sketches allow a link with ``i``."""
    differ = np.bitwise_count(bits[others] ^ bits[i]).sum(axis=1, dtype=np.int64)
    most = (n[others] + n[i]) * plan.apart.numerator // plan.apart.denominator
    sizes = np.minimum(n[others], n[i]) * plan.t.denominator >= np.maximum(n[others], n[i]) * plan.t.numerator
    return others[sizes & (differ <= most)]


def _opposite(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a pair of blocks: those of the first, and those of the second."""
    block = table.column("block").to_numpy()
    return tuple(np.flatnonzero(block == table.column(c)[0].as_py()) for c in ("p", "q"))


def _across(plan: Plan):
    """Two blocks of a group -> the members that sketches allow a link with one
    of another component."""

    def run(table: pa.Table) -> pa.Table:
        comp, n = (table.column(c).to_numpy() for c in ("c", "n"))
        raw = table.column("sketch").to_pylist()
        size = min(map(len, raw))
        bits = np.stack([folded(x, size) for x in raw])
        p, q = _opposite(table)
        live = np.zeros(len(n), dtype=bool)
        for i in p:
            near = _near(plan, bits, n, i, q[comp[q] != comp[i]])
            live[near] = True
            live[i] |= len(near) > 0
        return table.select(["g", "p", "q", "id", "c", "block"]).filter(pa.array(live))

    return run


def _forest(words: int, plan: Plan):
    """Two blocks of a group with their texts -> verified links that connect what
    links between the blocks connect: at most one for each component but one."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp = table.column("id").to_numpy(), table.column("c").to_numpy()
        sets = [shingles(word_hashes(x), words) for chunk in table.column("text").chunks for x in byte_views(chunk)]
        n = np.array([len(x) for x in sets], dtype=np.int64)
        sketches = [sketch(x) if len(x) else b"\0" * 8 for x in sets]
        size = min(map(len, sketches))
        bits = np.stack([folded(x, size) for x in sketches])
        p, q = (rows_[n[rows_] > 0] for rows_ in _opposite(table))
        # Each row's tree, renamed when two of them meet.
        tree, out = comp.copy(), []
        for i in p:
            for j in _near(plan, bits, n, i, q[tree[q] != tree[i]]):
                if tree[i] == tree[j]:
                    continue
                common = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                if common and common * plan.t.denominator >= (n[i] + n[j] - common) * plan.t.numerator:
                    out.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    tree[tree == tree[j]] = tree[i]
        a, b = (np.array([x[k] for x in out], dtype=np.int64) for k in (0, 1))
        return pa.table({"a": pa.array(a), "b": pa.array(b)})

    return run


def _verifier(words: int, t: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            a, b = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            ok = np.zeros(len(a), dtype=bool)
            for k, (x, y) in enumerate(zip(byte_views(batch.column(2)), byte_views(batch.column(3)))):
                if last is None or len(last) != len(x) or not np.array_equal(last, x):  # rows of one document often follow each other
                    last, held = x.copy(), shingles(word_hashes(x), words)
                s = shingles(word_hashes(y), words)
                common = len(np.intersect1d(held, s, assume_unique=True))
                ok[k] = common > 0 and common * t.denominator >= (len(held) + len(s) - common) * t.numerator
            yield pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], ["a", "b"])

    return run


def _only(df: DataFrame, ids: DataFrame, n: int) -> DataFrame:
    """Rows of ``df`` whose doc_id is in ``ids``; broadcast only if ``n`` ids are few."""
    return df.join(F.broadcast(ids) if n <= BROADCAST else ids, "doc_id", "left_semi")


def _late_pairs(docs: DataFrame, late: DataFrame, words: int, plan: Plan, scratch: Scratch) -> DataFrame:
    """Candidates of sets that could not probe by segments, by single shingles."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tokens = [], []
            for d, text in zip(batch.column(0).to_numpy(zero_copy_only=False), byte_views(batch.column(1))):
                s = shingles(word_hashes(text), words)
                k = plan.lookups(len(s))
                tokens.append(s[:k].view(np.int64))
                ids.append(np.full(len(tokens[-1]), d, dtype=np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(tokens))], ["a", "token"]) if ids else pa.RecordBatch.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64())], ["a", "token"])

    def holders(tokens):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = tokens.value
            for batch in batches:
                ids, hits = [], []
                for d, text in zip(batch.column(0).to_numpy(zero_copy_only=False), byte_views(batch.column(1))):
                    s = shingles(word_hashes(text), words).view(np.int64)
                    at = np.searchsorted(known, s)
                    at[at == len(known)] = 0
                    hit = s[known[at] == s] if len(known) else s[:0]
                    if len(hit):
                        ids.append(np.full(len(hit), d, dtype=np.int64))
                        hits.append(hit)
                if ids:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(ids)), pa.array(np.concatenate(hits))], ["b", "token"])

        return run

    spark = docs.sparkSession
    n = late.count()
    probes = scratch.cut(_only(docs, late, n).select("doc_id", "text").mapInArrow(wanted, "a long, token long"))
    out = None
    # The shingles go out in blocks of a bounded size, each against all texts.
    blocks = -(-probes.count() // BROADCAST) or 1
    for k in range(blocks):
        mine = probes.filter(F.pmod(F.xxhash64("token"), F.lit(blocks)) == k)
        known = spark.sparkContext.broadcast(np.sort(np.array([r[0] for r in mine.select("token").distinct().toLocalIterator()], dtype=np.int64)))
        holding = docs.select("doc_id", "text").mapInArrow(holders(known), "b long, token long")
        part = scratch.cut(holding.join(mine, "token").filter("a <> b").select("a", "b").distinct())
        out = part if out is None else out.unionByName(part)
    return out


def join_components(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: Fraction = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, n_links.

    ``component_id`` is the smallest doc_id reachable by links.  ``n_links``
    counts the verified links of the document's distinct set that the join
    tested (a group's links to its smallest document, and those across
    components).  Null and empty texts have no shingles and link with nothing;
    a row without doc_id links with nothing.  A doc_id on several rows is one
    document, linked if any of its texts is.  Other columns are ignored.
    """
    plan, scratch = Plan(threshold), Scratch(spark, "jaccard")
    docs = docs.select("doc_id", "text")
    sets = scratch.cut(shingle_counts(docs, words))
    usable = sets.filter("mark is not null and doc_id is not null")
    classes = scratch.cut(usable.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("sketch").alias("sketch")))
    total = classes.agg(F.sum("n")).first()[0] or 0
    buckets = buckets_for(total * 5 // 4)
    packed = docs.filter("doc_id is not null").mapInArrow(_pack(buckets, words, plan), SCHEMA)
    found = scratch.cut(packed.groupBy("bucket").applyInArrow(_meet, _FOUND))
    member = scratch.cut(usable.join(classes, "mark").select("doc_id", "rep", "n_shingles"))
    rep = member.select("doc_id", "rep")
    known, sketches = classes.select("rep", "n"), classes.select("rep", "sketch")

    def as_reps(pairs: DataFrame) -> DataFrame:
        """Candidate pairs by their sets' smallest documents."""
        both = pairs.join(rep.toDF("a", "ra"), "a").join(rep.toDF("b", "rb"), "b")
        return both.filter(F.col("ra") != F.col("rb")).select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct()

    def possible(pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow a link."""
        t = Fraction(threshold)
        both = pairs.join(known.toDF("a", "na"), "a").join(known.toDF("b", "nb"), "b")
        both = both.filter(F.least("na", "nb") * t.denominator >= F.greatest("na", "nb") * t.numerator)
        both = both.join(sketches.toDF("a", "x"), "a").join(sketches.toDF("b", "y"), "b")
        return both.select("a", "b", "na", "nb", "x", "y").mapInArrow(_possible(plan), "a long, b long").distinct()

    def verify(pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
        ids = scratch.cut(ids)
        texts = scratch.cut(_only(docs, ids, ids.count()))
        both = pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("y")), "b").join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("x")), "a")
        links = scratch.cut(both.select("a", "b", "x", "y").mapInArrow(_verifier(words, Fraction(threshold)), "a long, b long").distinct())
        scratch.drop(ids, texts)
        return links

    def across(now: DataFrame) -> DataFrame:
        """Verified links across the components of open groups, enough to connect
        all that links connect; a large group is compared block by block."""
        rows = now.join(known.toDF("id", "n"), "id").join(sketches.toDF("id", "sketch"), "id")
        wide = F.greatest(F.count("*") / BLOCK, F.sum("n") / SHINGLES)
        rows = rows.join(rows.groupBy("g").agg(F.ceil(wide).cast("int").alias("blocks")), "g").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        rows = rows.withColumn("other", other).withColumns({"p": F.least("block", "other"), "q": F.greatest("block", "other")})
        # A fixed number of tasks: these rows are few, but each costs a comparison with many.
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.select("g", "p", "q", "id", "c", "n", "block", "sketch").repartition(tasks, "g", "p", "q")
        live = rows.groupBy("g", "p", "q").applyInArrow(_across(plan), "g long, p int, q int, id long, c long, block int")
        live = scratch.cut(live.distinct())
        ids = scratch.cut(live.select(F.col("id").alias("doc_id")).distinct())
        texts = scratch.cut(_only(docs, ids, ids.count()).distinct())
        held = live.join(texts.withColumnRenamed("doc_id", "id"), "id").repartition(tasks, "g", "p", "q")
        links = scratch.cut(held.groupBy("g", "p", "q").applyInArrow(_forest(words, plan), "a long, b long").distinct())
        scratch.drop(live, ids, texts)
        return links

    candidates = found.filter(F.col("kind") == PAIR).select("a", "b").distinct()
    late = found.filter(F.col("kind") == LATE).select(F.col("a").alias("doc_id")).distinct()
    if not late.isEmpty():
        candidates = candidates.unionByName(_late_pairs(docs.filter("doc_id is not null"), late, words, plan, scratch))
    tested = scratch.cut(as_reps(candidates))
    links = verify(scratch.cut(possible(tested)))
    groups = found.filter(F.col("kind") == GROUP).select(F.col("a").alias("g"), F.col("b").alias("doc_id")).distinct()
    groups = scratch.cut(groups.join(member, "doc_id").select("g", F.col("rep").alias("id")).distinct())
    linked = components(links, scratch)
    for step in range(STAR_ROUNDS + 1):
        now = groups.join(linked, "id", "left").select("g", "id", F.coalesce("component", "id").alias("c"))
        open_groups = now.groupBy("g").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi")
        now = scratch.cut(now.join(open_groups, "g").select("g", "id", "c", "lo"))
        if step < STAR_ROUNDS:
            # One document of each component against the first component's.
            heads = now.groupBy("g", "c", "lo").agg((F.min if step % 2 else F.max)("id").alias("id"))
            centre = heads.filter("c = lo").select("g", F.col("id").alias("a"))
            more = heads.filter("c <> lo").join(centre, "g").select("a", F.col("id").alias("b"))
            more = scratch.cut(as_reps(more).join(tested, ["a", "b"], "left_anti"))
            tested, allowed = tested.unionByName(more), scratch.cut(possible(more))
            new = None if allowed.isEmpty() else verify(allowed)
        else:
            new = None if now.isEmpty() else across(now)
        if new is not None:
            links = links.unionByName(new)
            # Components so far are stars; only the new links can merge them.
            linked = components(linked.toDF("a", "b").unionByName(new), scratch)
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    labels = classes.select("rep").distinct().join(linked.withColumnRenamed("id", "rep"), "rep", "left").join(degree, "rep", "left")
    found_for = (
        member.select("doc_id", "rep").join(labels, "rep").groupBy("doc_id")
        .agg(F.min(F.coalesce("component", "rep")).alias("component_id"), F.sum(F.coalesce("n_links", F.lit(0).cast("long"))).alias("n_links"))
    )
    return sets.select("doc_id", "n_shingles").join(found_for, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    )


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies over every whole text of ``documents``."""
    return join_components(spark, spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_shingles", "component_id")


OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct([w[i] || ' ' || w[i+1] || ' ' || w[i+2] || ' ' || w[i+3] || ' ' || w[i+4] FOR i IN range(1, len(w) - 3)]) END AS g FROM w),
t AS (SELECT doc_id, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM t a JOIN t b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN s x ON x.doc_id = p.a JOIN s y ON y.doc_id = p.b WHERE 100 * p.c >= 75 * (len(x.g) + len(y.g) - p.c)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS v, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.v WHERE r.c < e.b),
m AS (SELECT v, min(c) AS c FROM r GROUP BY v)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(m.c, s.doc_id) AS component_id FROM s LEFT JOIN m ON m.v = s.doc_id
"""
