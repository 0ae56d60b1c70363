"""Language ID: held-out accuracy, plain loops, codes and edge cases."""

import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from platehub.llm import language

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.mark.parametrize("k", [2, 3, 4, 6, 7, 12, 40])
def test_codewords(k):
    code = language.codewords(k)
    assert code.shape[0] == k and set(np.unique(code)) == {-1, 1}
    assert (np.abs(code.sum(axis=0, dtype=int)) < k).all()
    apart = min((code[i] != code[j]).sum() for i in range(k) for j in range(i))
    assert apart >= (1 if k < 3 else code.shape[1] // 4)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = language.op12_language(spark, sf).join(docs.select("doc_id", "lang"), "doc_id")
    rows = out.collect()
    assert len(rows) == docs.count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r["held_out"]]
    right = [r for r in held if r["lang_pred"] == r["lang"]]
    assert len(right) >= 0.97 * len(held)
    clear = [r for r in held if not r["ambiguous"]]
    assert len(clear) >= 0.8 * len(held) and sum(r["lang_pred"] == r["lang"] for r in clear) >= 0.99 * len(clear)
    assert all(0 <= r["score"] <= 1 for r in rows)


WORDS = {"aa": "the cat sat on that mat", "bb": "der hund und die katze", "cc": "le chien était très grand"}


def small(spark):
    rows = [(i, " ".join([text] * (1 + i % 3)), lang, "s", 0) for n, (lang, text) in enumerate(WORDS.items()) for i in range(100 * n, 100 * n + 60)]
    return spark.createDataFrame(rows, DOCS)


def test_plain_loops(spark):
    """The same scores from dictionaries and sums over one n-gram after the other."""
    model = language.fit(small(spark))
    assert model.languages == ["aa", "bb", "cc"]

    def bucket(gram):
        key = int.from_bytes(gram, "big")
        key = ((key ^ (key >> 15)) * 2654435761 + len(gram) * 40503) % 2**32
        return ((key ^ (key >> 13)) * 2246822519) % 2**32 >> 16

    for text in ["The dog and  the CAT!", "très, très grand", "und 12 die 34"]:
        spaced = " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split(" ")).split()
        raw = (" " + " ".join(spaced) + " ").encode()
        raw = raw.rstrip(b" ") + (b"  " if not text[-1].isalpha() else b" ")
        found = [bucket(raw[i : i + n]) for n in (2, 3, 4) for i in range(len(raw) - n + 1)]
        loss = []
        for k in range(3):
            total = 0.0
            for b in range(model.code.shape[1]):
                m = sum(float(model.weight[g, b]) for g in found) / len(found)
                z = (m - model.middle[b]) / model.half[b]
                total += model.trust[k, b] * math.log1p(math.exp(-language.SHARP * int(model.code[k, b]) * z))
            loss.append(total)
        best = min(range(3), key=lambda k: loss[k])
        score = 1 / sum(math.exp(loss[best] - x) for x in loss)
        got = language.decode(model, text)
        assert got[0] == model.languages[best] and got[1] == pytest.approx(score, rel=1e-4)


def test_language_edges(spark):
    docs = small(spark).unionByName(
        spark.createDataFrame([(900, None, "aa", "s", 0), (901, "", "bb", "s", 0), (902, "12 + 3 = 15 ¿?", "cc", "s", 0), (None, WORDS["aa"], "zz", "s", 0), (903, WORDS["bb"], None, "s", 0), (903, WORDS["bb"], None, "s", 0), (904, "die katze " * 150_000, None, "s", 0), (905, "ñ", None, "s", 0)], DOCS)
    )
    docs = docs.withColumn("lang_pred", F.lit("clash")).withColumn("half", F.lit(7)).withColumn("h", F.lit("x")).withColumn("count", F.lit(1))
    rows = language.detect(docs).collect()
    assert len(rows) == 188
    by = {r["doc_id"]: r for r in rows}
    assert all((by[i]["lang_pred"], by[i]["score"], by[i]["ambiguous"]) == ("und", 0.0, False) for i in (900, 901, 902))
    assert by[None]["lang_pred"] == "aa" and by[None]["held_out"] is False
    assert by[903]["lang_pred"] == "bb" == by[904]["lang_pred"] and by[905]["lang_pred"] in WORDS
    assert all(r["lang_pred"] == ["aa", "bb", "cc"][r["doc_id"] // 100] for r in rows if r["doc_id"] is not None and r["doc_id"] < 300)
    assert language.detect(docs.limit(0)).collect() == []
    none = language.detect(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r["lang_pred"], r["score"]) for r in none} == {("und", 0.0)}
    one = {r["doc_id"]: r for r in language.detect(docs.withColumn("lang", F.lit("xx"))).collect()}
    assert (one[0]["lang_pred"], one[0]["score"]) == ("xx", 1.0) and one[900]["lang_pred"] == "und"


def test_sample_is_bounded_and_labels_are_no_input(spark, monkeypatch):
    monkeypatch.setattr(language, "MAX_DOCS", 10)
    docs = small(spark)
    taken = {r["lang"]: r["count"] for r in language.labelled_sample(docs).groupBy("lang").count().collect()}
    assert set(taken) == set(WORDS) and all(n < 40 for n in taken.values())
    model = language.fit(docs)
    one = language.identify(docs, model).collect()
    other = language.identify(docs.withColumn("lang", F.lit("aa")).withColumn("source", F.lit("t")), model).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))
