"""Versions, bulk inserts, keyed documents, BOM lookups and bound parameters
(K1, K2, K4, K5, S5, P12, S7)."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from platehub.__main__ import main
from platehub.plans import lookups as lk
from platehub.plans.bom import bom_lookups
from platehub.sources import sinks, versions
from platehub.streaming.intake import scratch_dir


# versions -------------------------------------------------------------------


def table(spark, *values):
    return spark.createDataFrame([(x,) for x in values], "x long")


def test_a_version_is_all_or_nothing(spark, monkeypatch):
    root = scratch_dir(spark, "versions")
    assert versions.current_version(spark, root) is None
    with pytest.raises(KeyError):
        versions.read(spark, root, "a")
    assert versions.publish(spark, root, {"a": table(spark, 1), "b": table(spark, 10)}) == 0

    def dies(*_):
        raise OSError("lost")

    broken = table(spark, 3).withColumn("x", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):  # midway: the first table is written, the second is not
        versions.publish(spark, root, {"a": table(spark, 2), "b": broken})
    assert rows(versions.read(spark, root, "a")) == [(1,)] and rows(versions.read(spark, root, "b")) == [(10,)]
    with monkeypatch.context() as m:  # all tables are written, the manifest is not
        m.setattr(spark, "createDataFrame", dies)
        with pytest.raises(OSError):
            versions.publish(spark, root, {"a": broken.limit(0)})
    assert versions.current_version(spark, root) == 0
    # the next attempt takes the same number; a table that it leaves out stays
    assert versions.publish(spark, root, {"a": table(spark, 4, 5)}) == 1
    assert rows(versions.read(spark, root, "a")) == [(4,), (5,)] and rows(versions.read(spark, root, "b")) == [(10,)]
    assert rows(versions.read(spark, root, "a", 0)) == [(1,)]
    with pytest.raises(KeyError):
        versions.read(spark, root, "c")


# bulk insert ----------------------------------------------------------------


def test_a_batch_counts_once(spark):
    root = scratch_dir(spark, "insert")
    batch = spark.createDataFrame([("t1", 1), ("t1", 1), ("t2", 2)], "token string, n int")
    more = spark.createDataFrame([("t2", 2), ("t3", 3)], "token string, n int")
    for b in (batch, batch, more, more.limit(0)):
        sinks.insert_once(b, root, "token")
    assert rows(sinks.read_inserted(spark, root, "token"), ["token", "n"]) == [("t1", 1), ("t1", 1), ("t2", 2), ("t3", 3)]
    with pytest.raises(ValueError):
        sinks.insert_once(spark.createDataFrame([(None, 1)], "token string, n int"), root, "token")


def test_an_insert_that_died_before_its_ledger_is_written_over(spark):
    root = scratch_dir(spark, "insert-died")
    sinks.insert_once(spark.createDataFrame([("t1", 1)], "token string, n int"), root, "token")
    half = spark.createDataFrame([("t2", 2)], "token string, n int")  # what a lost attempt left
    half.withColumn("batch_token", F.col("token")).write.mode("append").partitionBy("batch_token").parquet(f"{root}/rows")
    assert rows(sinks.read_inserted(spark, root, "token"), ["token", "n"]) == [("t1", 1)]
    sinks.insert_once(spark.createDataFrame([("t2", 2), ("t2", 3)], "token string, n int"), root, "token")
    assert rows(sinks.read_inserted(spark, root, "token"), ["token", "n"]) == [("t1", 1), ("t2", 2), ("t2", 3)]


# keyed documents ------------------------------------------------------------


def test_keyed_export_leaves_only_the_store(spark, tmp_path):
    """What it writes on the way is deleted, and the session's settings are as before."""
    from platehub.session import CLEANUP, checkpoint_dir

    folders = lambda: set(Path(checkpoint_dir(spark)).rglob("keyed-documents*"))
    before, setting = folders(), spark.conf.get(CLEANUP, "false")
    docs = spark.createDataFrame([(i % 9, f"d{i}") for i in range(50)], "key long, name string")
    sinks.export_keyed(docs, str(tmp_path / "store"), "key", 3)
    assert sinks.read_keyed(spark, str(tmp_path / "store"), "key").count() == 50
    assert folders() == before and spark.conf.get(CLEANUP, "false") == setting


def test_a_lookup_reads_one_range(spark):
    path = scratch_dir(spark, "docs")
    docs = spark.range(1000).select((F.col("id") * 7 % 1000).alias("key"), F.concat(F.lit("d"), "id").alias("name"), F.array(F.lit(1)).alias("parts"))
    docs = docs.unionByName(spark.createDataFrame([(None, "none", [2]), (5, "second page", [3])], "key long, name string, parts array<int>"))
    sinks.export_keyed(docs, path, "key", 8)
    assert sinks.read_keyed(spark, path, "key").count() == 1002
    files = lambda df: {r[0] for r in df.select(F.input_file_name()).distinct().collect()}
    assert len(files(spark.read.parquet(f"{path}/docs"))) == 8
    for key in (0, 5, 499, 999):
        found = sinks.read_keyed(spark, path, "key", key)
        assert len(found.inputFiles()) == 1, found.inputFiles()
        assert found.count() == (2 if key == 5 else 1)
    assert sinks.read_keyed(spark, path, "key", 10**6).count() == 0
    assert '"name":"d715"' in sinks.read_keyed(spark, path, "key", 5).where("json like '%d715%'").first().json  # 715 * 7 % 1000


# BOM lookups ----------------------------------------------------------------


def test_bom_lookups(spark):
    bom = spark.createDataFrame([(1, 1, "x1", 3), (1, 1, "X1", 2), (1, 1, "X1", 1), (1, 2, "X1", 9), (1, 1, "é", 4), (1, 1, None, 5), (2, 1, "y", 6)], "job int, shipment int, mark string, qty int")
    ask = [("a", 1, 1, "X1"), ("b", 1, 1, "x1"), ("c", 1, 1, "É"), ("d", 1, 1, "zz"), ("e", 1, 1, None), ("f", None, 1, "y"), ("g", 3, 1, None), ("b", 1, 1, "x1")]
    got = rows(bom_lookups(bom, spark.createDataFrame(ask, "request string, job int, shipment int, mark string")), ["request", "mark", "qty"])
    every = [("e", "x1", 3), ("e", "X1", 2), ("e", "X1", 1), ("e", "é", 4), ("e", None, 5)]
    assert got == sorted([("a", "X1", 1), ("b", "X1", 1), ("c", "é", 4), *every], key=repr)


def test_bom_lookups_join_on_collated_keys(spark, views):
    ask = views.bom.select(F.col("mark").alias("request"), "job", "shipment", F.lower("mark").alias("mark"))
    plan = bom_lookups(views.bom, ask)._jdf.queryExecution().executedPlan().toString()
    keys = [line for line in plan.split("\n") if "Join [" in line and "collate(mark" in line]
    assert keys and "collate(__mark" in keys[0] and "UTF8_LCASE" in keys[0]


# bound parameters -----------------------------------------------------------


def test_parameters_are_bound_and_checked(spark, views):
    name = views.program.first().ProgramName
    got = lk.run_named(lk.NAMED_SQL, "named_program", spark, SF_SMALL, {"program": name})
    assert got.count() == views.program.where(F.col("ProgramName") == name).count() > 0
    assert lk.run_named(lk.NAMED_SQL, "named_program", spark, SF_SMALL, {"program": "' OR '1'='1"}).count() == 0
    all_open = lk.run_named(lk.NAMED_SQL, "named_open_programs", spark, SF_SMALL, {"least": 1}).count()
    assert 0 < lk.run_named(lk.NAMED_SQL, "named_open_programs", spark, SF_SMALL, {"least": "2"}).count() < all_open
    for bad in ({"least": "two"}, {"least": 1.5}, {"least": True}, {"most": 1}, {"machine": 7}):
        with pytest.raises(ValueError):
            lk.run_named(lk.NAMED_SQL, "named_open_programs", spark, SF_SMALL, bad)
    with pytest.raises(ValueError):
        lk.NamedSql("SELECT :x AS x", (), {"x": "date"}, {}).values({})
    assert str(lk.NamedSql("SELECT :x AS x", (), {"x": "date"}, {}).values({"x": "2024-02-29"})["x"]) == "2024-02-29"
    with pytest.raises(ValueError):
        lk.NamedSql("SELECT :x AS x", (), {"x": "date"}, {}).values({"x": "2023-02-29"})


def test_command_line_refuses_wrong_parameters(capsys):
    assert main(["list"]) == 0
    assert "named_open_programs  (machine: string = '1-URGENT', least: int = 1)" in capsys.readouterr().out
    assert main(["run", "named_open_programs", "--param", "least=two"]) == 2
    assert main(["run", "named_program", "--param", "name=PRG7"]) == 2
    assert main(["run", "machine_list", "--param", "machine=x"]) == 2
    assert main(["run", "nothing"]) == 2
    assert "least is no int" in capsys.readouterr().err


def test_a_large_range_is_written_by_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(sinks, "TASK_BYTES", 2000, raising=False)
    docs = spark.createDataFrame([(i % 400 or None, f"d{i}") for i in range(2000)], "key long, name string")
    path = scratch_dir(spark, "documents")
    sinks.export_keyed(docs, path, "key", 2)
    store = spark.read.parquet(f"{path}/docs")
    files = store.select("part", F.input_file_name().alias("f")).distinct().groupBy("part").count()
    assert all(n > 3 for _, n in rows(files)) and files.count() == 2
    assert rows(sinks.read_keyed(spark, path, "key").selectExpr("key", "json_tuple(json, 'name') AS name")) == rows(docs)
    (_, _, end), (_, begin, _) = rows(spark.read.parquet(f"{path}/index"), ["part", "least", "largest"])
    assert end < begin and sinks.read_keyed(spark, path, "key", 7).count() == 5


# constraints ----------------------------------------------------------------


def test_audit_counts_and_scans_each_table_once(spark, views):
    from platehub.plans.audit import constraint_audit
    from platehub.plans.registry import _audit_checks

    a = spark.createDataFrame([(1, "x"), (1, None), (None, "y"), (None, "z"), (3, None)], "k int, s string")
    b = spark.createDataFrame([(1, "p"), (9, "q"), (9, "r"), (None, "t")], "k long, s string")
    checks = [("pk", "a", a, ["k"]), ("not_null", "a", a, ["k", "s"]), ("pk", "a", a, ["k", "s"]), ("fk", "b", b, ["k"], a, ["k"]), ("pk", "none", a.limit(0), ["k"])]
    got = [tuple(r) for r in constraint_audit(checks).collect()]
    assert sorted(got) == sorted([("a", "pk(k)", "pk", 2), ("a", "not_null(k,s)", "not_null", 4), ("a", "pk(k,s)", "pk", 0), ("b", "fk(k)", "fk", 2), ("none", "pk(k)", "pk", 0)])
    plan = constraint_audit(_audit_checks(views))._jdf.queryExecution().executedPlan().toString()
    tables = [views.config, views.part_wo, views.stock, views.program, views.st_pip_arc, views.slab_part_alloc, views.st_prg_arc]
    scans = sum(t._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") for t in tables)
    assert plan.count("FileScan parquet") == scans
