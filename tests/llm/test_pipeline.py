"""The pipeline, stage by stage, on the smallest tables, and the queries' SQL."""

import re

import pytest

import corpus_pipeline
from platehub.llm import queries
from platehub.testing.oracle import compare, duckdb_conn

from .test_search_ops import brute_components, brute_leaks, brute_lines

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    r = compare(queries.QUERIES[name](spark, SF), duckdb_conn(SF), queries.ORACLE[name])
    assert r["cols_match"] and r["values_match"], r


def test_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_stages_on_odd_rows(spark, tmp_path):
    """Null ids, repeated rows, null and empty texts, a long text, other columns."""
    item = spark.read.parquet(f"{SF}/benchmark.parquet").filter("text is not null").orderBy("item_id").first()["text"]
    clean = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(6)]
    long = " ".join(f"y{i}" for i in range(50_000))
    rows = [(1, clean[0]), (1, clean[0]), (2, clean[1]), (None, clean[1]), (None, clean[2]), (None, clean[2]), (None, item), (3, item),
            (4, None), (5, ""), (None, None), (6, long), (7, clean[3] + " end"), (8, clean[3]), (9, clean[4]), (9, clean[5])]
    docs = spark.createDataFrame([(d, t, "en", "src0", len(t or ""), "k", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, row string, component_id int")
    corpus_pipeline.near_copies(spark, docs, SF).write.parquet(str(tmp_path / "near"))
    near = spark.read.parquet(str(tmp_path / "near"))
    got = sorted(((r["doc_id"] or 0, r["text"] or "") for r in near.collect()))
    want = [(1, clean[0]), (2, clean[1]), (0, clean[2]), (3, item), (4, ""), (5, ""), (0, ""), (6, long), (7, clean[3] + " end"), (9, clean[4]), (9, clean[5])]
    assert got == sorted(want) and near.columns == docs.columns
    kept = corpus_pipeline.decontaminate(spark, docs, SF)
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in kept.collect()) == sorted((d or 0, t or "") for d, t in rows if t != item)
    assert kept.columns == docs.columns
    mixed = corpus_pipeline.mixture(spark, docs, SF).collect()
    assert all(words(r["last_text"]) == words(r["text"])[: r["last_tokens"]] and r["taken_tokens"] > 0 for r in mixed)
    total = sum(len(words(t)) for _, t in rows)
    assert 0.79 * total < sum(r["taken_tokens"] for r in mixed) <= 0.8 * total


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        after = docs.collect()
        ids = {r["doc_id"] for r in after}
        assert ids <= {d for d, _ in before} and len(ids) == len(after)
        if name != "mixture":
            assert docs.columns == columns
        if name == "quality":
            assert len(ids) >= 0.7 * len(before)
        if name == "lines":
            gone = brute_lines(before)
            for d, t in before:
                kept = "\n".join(s for i, s in enumerate((t or "").split("\n")) if (d, i) not in gone)
                lost = any(g[0] == d for g in gone)
                assert (d not in ids) == (lost and not kept.strip())
            assert all(r["n_chars"] == len(r["text"]) for r in after)
        if name == "near_copies":
            assert ids == {i for i, (_, c) in brute_components(before).items() if c == i}
        if name == "decontaminate":
            items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert ids == {d for d, _ in before} - {d for d, _ in brute_leaks(before, items)}
        if name == "mixture":
            whole, taken = dict(before), sum(r["taken_tokens"] for r in after)
            total = sum(len(words(t)) for _, t in before)
            assert 0.79 * total < taken <= 0.8 * total
            for r in after:
                assert r["taken_tokens"] > 0 and r["text"] == whole[r["doc_id"]]
                assert words(r["last_text"]) == words(r["text"])[: r["last_tokens"]]
        seen.append(name)
    assert seen == ["quality", "lines", "near_copies", "decontaminate", "mixture"]
    final = sorted((tuple(r) for r in corpus_pipeline.run(spark, SF).collect()), key=str)
    assert final == sorted((tuple(r) for r in after), key=str)


def test_stages_on_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        assert docs.count() == 0
