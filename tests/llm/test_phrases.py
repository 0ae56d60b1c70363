"""Phrase mining against a plain count, with proposals that fail, and edge cases."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from platehub.llm import phrases
from platehub.llm.scratch import Scratch
from platehub.testing.oracle import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ASCII = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain(rows, least):
    """Counts of all phrases, by dictionaries."""
    found, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(ASCII)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                found.update((lang, k, " ".join(words[i : i + k])) for i in range(len(words) - k + 1))
    return {key: n for key, n in found.items() if n >= least} | {(lang, 0, ""): n for lang, n in total.items() if n}


def ranked(counts, top):
    out = []
    f = {(lang, p): a for (lang, k, p), a in counts.items() if k}
    for lang in {x[0] for x in counts}:
        rows = []
        for (lg, k, p), a in counts.items():
            if lg != lang or k < 2:
                continue
            w = p.split(" ")
            if any(lg2 == lang and k2 > k and any(q.split(" ")[i : i + k] == w for i in range(k2 - k + 1)) and 100 * b >= 80 * a for (lg2, k2, q), b in counts.items()):
                continue
            cuts = [(f[lang, " ".join(w[:c])], f[lang, " ".join(w[c:])]) for c in range(1, k)]
            score, cut = min((2_000_000 * a // (x + y), c) for c, (x, y) in enumerate(cuts))
            rows.append((-score, -a, p.encode(), p, a, *cuts[cut], counts[lang, 0, ""], score))
        rows.sort()
        out += [(lang, i, *r[3:]) for i, r in enumerate(rows[:top], 1)]
    return sorted(out)


def texts(rng, n):
    vocabulary = ["the", "of", "Red", "house", "ÉCOLE", "école", "x", "new", "york", "city"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += rng.choice([["new", "york", "city"], ["the", "red", "house"], [rng.choice(vocabulary)], [rng.choice(vocabulary) + rng.choice(".,;:!?")], [f"rare{rng.randint(0, 200)}"]])
        out.append(rng.choice([" ", "  ", "\t", " "]).join(words).replace("city new", "city\nnew"))
    return out


def mined(spark, df, **kw):
    return {(r["lang"], r["k"], r["phrase"]): r["a"] for r in phrases.mine(df, Scratch(spark, "t"), **kw).collect()}


@pytest.mark.parametrize("sample_least", [1, 2, 10**6])
def test_counts_with_any_proposal(spark, monkeypatch, sample_least):
    """Whatever the sample proposes, nothing at all included, the counts are whole."""
    monkeypatch.setattr(phrases, "SAMPLE_LEAST", sample_least)
    monkeypatch.setattr(phrases, "FLUSH", 300)
    monkeypatch.setattr(phrases, "CHUNK", 200)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 4096)
    rng = random.Random(13)
    rows = [(t, rng.choice(["en", "fr", None])) for t in texts(rng, 300)]
    df = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    want = plain(rows, 30)
    assert max(k for _, k, _ in want) == 4
    assert mined(spark, df) == want
    out = phrases.collocations(phrases.mine(df, Scratch(spark, "t")), top=15)
    assert sorted(map(tuple, out.collect())) == ranked(want, 15)


@pytest.mark.parametrize("sample_least", [2, 10**6])
def test_driver_sends_proposals_in_slices(spark, monkeypatch, sample_least):
    """The driver never holds a proposal as a whole."""
    monkeypatch.setattr(phrases, "SLICE", 16 << 10, raising=False)
    monkeypatch.setattr(phrases, "SAMPLE_LEAST", sample_least)
    monkeypatch.setattr(phrases, "BUCKET_BYTES", 4096)
    sent = []
    broadcast = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: sent.append(len(value)) or broadcast(self, value))
    rng = random.Random(14)
    rows = [(t, rng.choice(["en", "fr"])) for t in texts(rng, 300)]
    df = spark.createDataFrame([(i, t, lang, "s", 0) for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    assert mined(spark, df) == plain(rows, 30)
    assert sent and max(sent) <= 16 << 10 < (1 << phrases.FEWEST) // 8


def test_passes_until_closed(spark, monkeypatch):
    """With nothing proposed each pass reaches one word further, and the last finds nothing."""
    monkeypatch.setattr(phrases, "SAMPLE_LEAST", 10**6)
    calls = []
    frequent = phrases.Counter.frequent
    monkeypatch.setattr(phrases.Counter, "frequent", lambda self, *a, **b: calls.append(1) or frequent(self, *a, **b))
    df = spark.createDataFrame([(i, "a b c d e", "en", "s", 0) for i in range(40)], DOCS)
    assert len(mined(spark, df)) == 5 + 4 + 3 + 2 + 1
    assert len(calls) == 1 + 4 + 1  # sample, words to four words, and one that finds none


def test_edges(spark):
    many = "big data. " * 40
    rows = [(1, None, "en"), (2, "", "en"), (3, many, None), (3, many, None), (None, many, "en"), (4, "w " * 120_000, "de"), (5, ".,;\n", "fr"), (6, "Z" * 3_000_000, "es"), (7, "big\x0bdata", "en")]
    df = spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], DOCS)
    df = df.withColumn("k", F.lit(9)).withColumn("phrase", F.lit("clash")).withColumn("a", F.lit(1)).withColumn("part", F.lit(0))
    got = mined(spark, df)
    assert got == plain([(t, lang) for _, t, lang in rows], 30)
    assert got["und", 2, "big data"] == 80 and got["de", 4, "w w w w"] == 119_997 and got["es", 0, ""] == 1
    out = phrases.collocations(phrases.mine(df, Scratch(spark, "t"))).collect()
    assert ("en", 1, "big data", 40, 41, 41, 82, 975609) in [tuple(r) for r in out]
    none = phrases.mine(df.limit(0), Scratch(spark, "t"))
    assert none.collect() == [] and phrases.collocations(none).collect() == []


def test_scores_beyond_64_bits(spark):
    big = 7 * 10**15
    counts = spark.createDataFrame([("en", 0, "", 10**18), ("en", 1, "a", big + 1), ("en", 1, "b", big + 3), ("en", 2, "a b", big)], "lang string, k int, phrase string, a long")
    assert [tuple(r) for r in phrases.collocations(counts).collect()] == [("en", 1, "a b", big, big + 1, big + 3, 10**18, 2_000_000 * big // (2 * big + 4))]


def test_op13_sql(spark):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    r = compare(phrases.op13_phrases(spark, sf), con, phrases.OP13_SQL)
    assert r["cols_match"] and r["values_match"], r


def test_bits():
    bits = np.zeros(1 << 17, dtype=np.uint8)
    keys = np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64)
    for k in keys[::2]:
        at = int(k) >> 44
        bits[at >> 3] |= 1 << (at & 7)
    assert phrases.proposed(bits, keys[::2]).all() and phrases.proposed(bits, keys[1::2]).mean() < 0.01
    for parts in (1, 4, 16):
        assert (phrases.proposed(np.split(bits, parts), keys) == phrases.proposed(bits, keys)).all()
