"""Periodic runs against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from platehub.llm import runs

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACES = {" ", "\t", "\n", "\x0b", "\x0c", "\r"}


def words_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return out


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def brute(words):
    """Maximal stretches with equal words q apart, for each q; a stretch counts
    only if no smaller q has one that covers it."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i:
                start, length = i, j - i + q
                if length >= max(6, 4 * q):
                    smallest = next(p for p in range(1, q + 1) if all(words[k] == words[k + p] for k in range(start, start + length - p)))
                    if smallest == q:
                        out.append((start, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    w = planted(doc_id, words_of(text))
    found = brute(w)
    drop = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None,) * 3
    return (
        doc_id, len(found), *best, None if not found else 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(),
        hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest(),
    )


def random_words(rng, n):
    """Few letters, with stretches that repeat, and repeats of repeats."""
    out = [rng.choice("abc") for _ in range(rng.randint(1, 12))]
    while len(out) < n:
        k = rng.randint(1, min(9, len(out)))
        out += out[-k:] * rng.randint(1, 6) if rng.random() < 0.5 else [rng.choice("abc")]
    return out[:n]


def test_runs_brute_force():
    rng = random.Random(11)
    for _ in range(400):
        w = random_words(rng, rng.randint(0, 120))
        names = {}
        ids = np.array([names.setdefault(x, len(names)) for x in w], dtype=np.int64)
        assert runs.find(ids) == brute(w), w


def test_runs_of_one_word_and_of_blocks(monkeypatch):
    assert runs.find(np.zeros(30_000, dtype=np.int64)) == [(0, 30_000, 1)]
    ids = np.concatenate([np.zeros(3000), [7], np.zeros(3000), np.arange(1, 3), np.tile([3, 4, 5], 1000)]).astype(np.int64)
    assert runs.find(ids) == [(0, 3000, 1), (3001, 3000, 1), (6003, 3000, 3)]
    monkeypatch.setattr(runs, "BLOCK", 4)
    rng = random.Random(5)
    for _ in range(100):
        w = random_words(rng, 90)
        names = {}
        assert runs.find(np.array([names.setdefault(x, len(names)) for x in w], dtype=np.int64)) == brute(w)


def test_op11_documents(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    some = docs.filter("n_chars < 6000")
    some.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: tuple(r) for r in runs.op11_runs(spark, str(tmp_path)).collect()}
    want = {r["doc_id"]: expected(r["doc_id"], r["text"]) for r in some.collect()}
    assert got == want and any(r[1] for r in want.values())
    whole = runs.op11_runs(spark, sf)
    assert whole.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert whole.count() == docs.count()


def test_op11_edges(spark):
    say = " ".join(["a b"] * 10)
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, say), (4, say), (None, say), (5, "é " * 9 + "\u00a0x"), (6, "x\u2003y " * 8), (7, "w " * 200_000), (8, "\x0b".join("zz zz zz zz zz".split()))]
    df = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], DOCS).withColumn("runs", F.lit("clash")).withColumn("collapsed", F.lit(1))
    rows = runs.find_runs(df).collect()
    assert len(rows) == len(texts)
    by = {r["doc_id"]: r for r in rows}
    assert [tuple(x) for x in by[4]["runs"]] == [(0, 20, 2)] and by[4]["collapsed"] == "a b" == by[None]["collapsed"]
    assert by[1]["runs"] == by[2]["runs"] == by[3]["runs"] == [] and by[1]["collapsed"] == by[2]["collapsed"] == by[3]["collapsed"] == ""
    assert [tuple(x) for x in by[5]["runs"]] == [(0, 9, 1)] and by[5]["collapsed"] == "é \u00a0x"
    assert [tuple(x) for x in by[6]["runs"]] == [(0, 8, 1)]
    assert [tuple(x) for x in by[7]["runs"]] == [(0, 200_000, 1)] and by[7]["collapsed"] == "w"
    assert by[8]["runs"] == []
    assert runs.digest(runs.find_runs(df.limit(0))).collect() == []
    d = {r["doc_id"]: r for r in runs.digest(runs.find_runs(df)).collect()}
    assert d[1]["runs_sha256"] == hashlib.sha256(b"").hexdigest() and d[1]["start"] is None and d[1]["exponent_milli"] is None


@pytest.mark.parametrize("doc_id", [10, 17, 123456789])
def test_plant(spark, doc_id):
    ids = [k for k in range(doc_id, doc_id + 60)]
    text = " one two\tthree\nfour five  six seven eight nine ten"
    df = spark.createDataFrame([(i, text) for i in ids], "doc_id long, text string")
    got = {r[0]: words_of(r[1]) for r in df.select("doc_id", runs.plant(F.col("text"), F.col("doc_id"))).collect()}
    assert got == {i: planted(i, words_of(text)) for i in ids}
