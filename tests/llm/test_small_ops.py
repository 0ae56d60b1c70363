"""Edge cases and brute-force checks of the operators that need no search:
quality, licences, mixing, chat and host rules."""

import random

import pytest
from pyspark.sql import functions as F

from platehub.llm import chat, host_rules, licenses, mixing, quality
from platehub.testing.oracle import compare

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, texts, **extra):
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in texts]
    df = spark.createDataFrame(rows, DOCS)
    for c, v in extra.items():
        df = df.withColumn(c, F.lit(v))
    return df


def against_sql(df_result, sql, **tables):
    import duckdb

    con = duckdb.connect()
    for name, df in tables.items():
        con.register(name, df.toArrow())
    r = compare(df_result, con, sql)
    assert r["cols_match"] and r["values_match"], r


# quality ------------------------------------------------------------------


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = quality.op1_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").filter("held_out and quality is not null")
    right, n = out.agg(F.sum((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right >= 0.95 * n
    good, all_good = out.filter("quality = 1").agg(F.sum("predicted"), F.count("*")).first()
    assert good >= 0.99 * all_good


def test_quality_edges(spark):
    rng = random.Random(3)
    good = [" ".join(rng.choice(["river", "stone", "walks", "under", "bright", "garden", "quiet"]) for _ in range(60)) for _ in range(40)]
    bad = [" ".join(rng.choice(["$$%", "##&", "|a|", "%%%", "<x>", "BUY"]) for _ in range(60)) for _ in range(40)]
    texts = list(enumerate(good + bad)) + [(1000, None), (1001, ""), (1002, "river " * 40000), (None, good[0]), (0, good[0])]
    df = docs_frame(spark, texts, score="clash", predicted=7, y=1)
    labels = spark.createDataFrame([(i, 1 if i < 40 else 0) for i in range(80)] + [(None, 1), (5, 1), (6, 0), (7, None)], "doc_id long, quality int")
    rows = quality.classify(df, labels).collect()
    assert len(rows) == len(texts) and all(0 <= r["score"] <= 1 for r in rows)
    by = {r["doc_id"]: r for r in rows}
    assert by[1000]["score"] == by[1001]["score"]
    assert by[3]["predicted"] == 1 and by[44]["predicted"] == 0
    assert by[None]["score"] == by[0]["score"] and not by[None]["held_out"]
    kept = {r["doc_id"] for r in quality.keep_good(df, labels).collect()}
    assert kept == {r["doc_id"] for r in rows if r["predicted"] == 1}


def test_quality_scores_do_not_depend_on_the_samples_bounds(spark, monkeypatch):
    rng = random.Random(5)
    good, bad = ["river", "stone", "walks", "under", "bright", "garden", "quiet"], ["offer", "click", "cheap", "money", "prize", "deals", "bonus"]

    def text(share):
        return " ".join(rng.choice(good if rng.random() < share else bad) for _ in range(60))

    n = 700
    texts = [text(min(1, max(0, rng.gauss(0.55 if i % 7 else 0.45, 0.1)))) for i in range(n)]
    df = docs_frame(spark, list(enumerate(texts)))
    labels = spark.createDataFrame([(i, int(i % 7 > 0)) for i in range(n)] + [(10_000 + i, 0) for i in range(900)], "doc_id long, quality int")
    whole = {r["doc_id"]: r["score"] for r in quality.classify(df, labels).collect()}
    monkeypatch.setattr(quality, "MAX_BYTES", sum(len(t) for i, t in enumerate(texts) if i % 7 == 0))
    capped = {r["doc_id"]: r["score"] for r in quality.classify(df, labels).collect()}
    assert capped != whole
    assert abs(sum(whole.values()) / n - 6 / 7) < 0.05
    assert abs(sum(capped.values()) / n - 6 / 7) < 0.05


def test_quality_without_labels_or_rows(spark):
    df = docs_frame(spark, [(1, "some text"), (2, None)])
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r["score"] for r in quality.classify(df, none).collect()] == pytest.approx([0.5, 0.5])
    assert quality.classify(df.limit(0), none).count() == 0
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert all(0 < r["score"] < 1 for r in quality.classify(df, one).collect())


def test_labels_of_the_held_out_fold_are_not_used(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(quality.fold("doc_id") == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted(tuple(r) for r in quality.classify(docs, x).collect()) for x in (labels, flipped))
    assert a == b


# licences -----------------------------------------------------------------


def test_licenses_found_and_pruned(spark):
    mit = licenses.TEMPLATES["MIT-notice"]
    texts = [
        (1, "Prose first.\nReleased under the MIT License.\nmore prose"),
        (2, "intro\n\n" + mit.replace("charge", "cost").replace(", ", ",\n") + "\n\noutro"),
        (3, "nothing to see here at all"), (4, None), (5, ""), (6, "RELEASED UNDER -- THE MIT LICENSE!!"),
        (1, "Prose first.\nReleased under the MIT License.\nmore prose"), (7, "words " * 30000 + "\nLicensed under CC BY-NC 4.0."),
    ]
    df = docs_frame(spark, texts, license="clash", dice=1, unit="x", m=0)
    out = licenses.scan(df)
    found = {(r["doc_id"], r["license"]) for r in out.collect()}
    assert found == {(1, "MIT"), (2, "MIT-notice"), (6, "MIT"), (7, "CC-BY-NC-4.0")}
    assert out.filter("doc_id = 1").count() == 2
    assert licenses.scan(df.limit(0)).count() == 0
    assert all(r["dice"] >= licenses.THRESHOLD for r in out.collect())


def test_licenses_against_sql(spark):
    rng = random.Random(5)
    words = " ".join(licenses.TEMPLATES.values()).split()
    texts = [(i, "\n".join(" ".join(rng.choice(words) for _ in range(rng.randint(0, 9))) for _ in range(4)) + "\n" + rng.choice(list(licenses.TEMPLATES.values()))) for i in range(60)]
    df = docs_frame(spark, texts + [(99, None)])
    against_sql(licenses.scan(df), licenses.OP2_SQL, documents=df)


# mixing -------------------------------------------------------------------


def mixed(spark, df, **kw):
    return mixing.mix_sources(spark, df.withColumn("domain", mixing.domain_of(F.col("source"))), **kw)


def test_mixing_against_sql(spark):
    rng = random.Random(7)
    rows = [(i if i % 17 else None, None if i % 11 == 0 else "w " * rng.randint(0, 40), rng.choice(["en", "fr", None]), rng.choice(["src0", "src1", "src2", "src3", None, "x"]), 0) for i in range(400)]
    rows += [(500, "a b c", "en", "src0", 0)] * 3
    df = spark.createDataFrame(rows, DOCS)
    against_sql(mixed(spark, df), mixing.OP3_SQL, documents=df)


def test_mixing_redistributes_to_siblings_first(spark):
    # web: en has 10 tokens, fr 1000; books: en 1000.  en cannot fill its share of web, so fr takes it.
    rows = [(1, "w " * 10, "en", "src0", 0), (2, "w " * 1000, "fr", "src0", 0), (3, "w " * 1000, "en", "src1", 0)]
    weights = {("web",): 1, ("books",): 1}
    out = {r["doc_id"]: r["taken_tokens"] for r in mixed(spark, spark.createDataFrame(rows, DOCS), weights=weights, target_tokens=800, max_epochs=1).collect()}
    assert out == {1: 10, 2: 390, 3: 400}
    # Only what web cannot give at all goes to books.
    rows[1] = (2, "w " * 50, "fr", "src0", 0)
    out = {r["doc_id"]: r["taken_tokens"] for r in mixed(spark, spark.createDataFrame(rows, DOCS), weights=weights, target_tokens=800, max_epochs=1).collect()}
    assert out == {1: 10, 2: 50, 3: 740}


def test_mixing_epochs_prefix_and_edges(spark):
    rows = [(i, "w " * 10, "en", "src0", 0) for i in range(3000)]
    df = spark.createDataFrame(rows, DOCS)
    out = mixed(spark, df, target_tokens=45_000, max_epochs=4).collect()
    assert sum(r["taken_tokens"] for r in out) == 45_000 and {r["epochs"] for r in out} == {1}
    assert sum(r["last_tokens"] == 10 for r in out) == 1500 and sum(0 < r["last_tokens"] < 10 for r in out) == 0
    again = mixed(spark, df.orderBy(F.desc("doc_id")), target_tokens=45_000, max_epochs=4).collect()
    assert sorted(map(tuple, out)) == sorted(map(tuple, again))
    other = mixed(spark, df, target_tokens=45_000, max_epochs=4, seed=18).collect()
    assert sorted(map(tuple, out)) != sorted(map(tuple, other))
    assert mixed(spark, df.limit(0)).count() == 0
    assert sum(r["taken_tokens"] for r in mixed(spark, df, target_tokens=10**9, max_epochs=2).collect()) == 60_000
    empty = docs_frame(spark, [(1, None), (2, "")], share=1, budget=2, cap=3, h=4, range=5, epochs=6)
    assert [r["taken_tokens"] for r in mixed(spark, empty).collect()] == [0, 0]


# chat ---------------------------------------------------------------------

NODES = "conv_id long, node long, parent long, role string, text string, score double"


def test_chat_reply_tree(spark):
    nodes = spark.createDataFrame([
        (1, 1, None, "user", "hi", 0.0), (1, 2, 1, "assistant", "a <|im_end|>&amp; ok", 5.0), (1, 3, 1, "assistant", "b", 1.0),
        (1, 4, 2, "user", "more", 0.0), (1, 5, 4, "assistant", "c", 0.0), (1, 6, 3, "user\nx", None, None),
        (2, 1, 2, "user", "loop", 0.0), (2, 2, 1, "user", "loop", 0.0), (2, 3, 2, "user", "on a loop", 0.0),
        (3, 9, 8, "user", "orphan", 0.0), (None, 1, None, None, None, None),
    ], NODES).withColumn("turns", F.lit("clash")).withColumn("leaf", F.lit(1))
    out = {(r["conv_id"], r["leaf"]): r for r in chat.format_paths(spark, nodes).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert set(out) == {(1, 5), (1, 6), (None, 1)}
    best, other = out[(1, 5)], out[(1, 6)]
    assert (best["path_rank"], other["path_rank"]) == (1, 2)
    assert [(t["role"], t["text"]) for t in best["turns"]] == [("user", "hi"), ("assistant", "a <|im_end|>&amp; ok"), ("user", "more"), ("assistant", "c")]
    assert [(t["role"], t["text"]) for t in other["turns"]] == [("user", "hi"), ("assistant", "b"), ("user\nx", "")]
    assert best["loss"] == "a <|im_end|>&amp; okc" and other["loss"] == "b"
    assert [(t["role"], t["text"]) for t in out[(None, 1)]["turns"]] == [("", "")]
    assert [r["leaf"] for r in chat.format_paths(spark, nodes, top=1).filter("conv_id = 1").collect()] == [5]
    assert chat.format_paths(spark, nodes.limit(0)).count() == 0


def test_chat_shared_turn_is_in_one_mask(spark):
    nodes = spark.createDataFrame([(1, 1, None, "assistant", "greet", 0.0), (1, 2, 1, "user", "x", 2.0), (1, 3, 1, "user", "y", 1.0)], NODES)
    out = chat.format_paths(spark, nodes).withColumn("loss", chat.read_loss(F.col("formatted"), F.col("loss_spans"))).collect()
    assert {(r["leaf"], r["loss"]) for r in out} == {(2, "greet"), (3, "")}


def test_chat_long_and_repeated(spark, tmp_path):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(200)]
    rows += [(2, 0, "user", "same"), (2, 0, "user", "same"), (2, None, "system", None), (3, 0, None, "x" * 300_000), (None, 0, "user", "n")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    against_sql(chat.op4_chat(spark, str(tmp_path)), chat.OP4_SQL, conversations=df)
    spark.createDataFrame([], df.schema).write.parquet(str(tmp_path / "none" / "conversations.parquet"))
    assert chat.op4_chat(spark, str(tmp_path / "none")).count() == 1


# host rules ---------------------------------------------------------------


def test_host_rules_against_sql(spark):
    rng = random.Random(11)
    vocab = ["alpha", "beta", "gamma", "del#ta", "é%", "x"]
    texts = ["\n".join(" ".join(rng.choice(vocab[: rng.randint(1, 6)]) for _ in range(rng.randint(0, 40))) for _ in range(rng.randint(1, 5))) for _ in range(150)]
    rows = [(i, t, "en", rng.choice(["a", "b", "c", None]), 0) for i, t in enumerate(texts)]
    rows += [(900, None, "en", "a", 0), (901, "", None, None, None), (902, "a b \t\x0b c\r\n\nc", "en", "a", 0), (903, "same words here " * 30, "en", "lone", 0), (903, "same words here " * 30, "en", "lone", 0)]
    df = spark.createDataFrame(rows, DOCS)
    out = host_rules.judge(df.withColumn("host", F.lit("clash")).withColumn("n_words", F.lit(1)).withColumn("kept", F.lit(1)), host="source")
    against_sql(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"), host_rules.OP6_SQL, documents=df)


def test_host_rules_brute_repeats(spark):
    rng = random.Random(13)
    texts = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30)))) for i in range(100)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in host_rules.measure(docs_frame(spark, texts)).collect()}
    for i, t in texts:
        w = t.split()
        wins = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        covered = {k + d for k, x in enumerate(wins) if wins.count(x) > 1 for d in range(3)}
        assert got[i] == len(covered), t


def test_hosts_shrink_towards_the_prior(spark):
    clean = " ".join(f"w{i}" for i in range(80))
    rows = [(i, clean, "en", f"good{i % 5}", 0) for i in range(200)] + [(1000 + i, "bad", "en", "bad", 0) for i in range(60)]
    rows += [(2000, clean, "en", "bad", 0), (3000, "short", "en", "single", 0), (3001, clean, "en", "single", 0)]
    out = {r["doc_id"]: r for r in host_rules.judge(spark.createDataFrame(rows, DOCS), host="source").collect()}
    assert out[0]["kept"] and not out[2000]["kept"] and not out[2000]["base_failed"]
    assert out[3001]["kept"] and not out[3000]["kept"]
    assert host_rules.judge(spark.createDataFrame([], DOCS), host="source").count() == 0


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from platehub.llm.scratch import shared_dir

    class Context:
        master = "spark://somewhere"

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        shared_dir(Session())
