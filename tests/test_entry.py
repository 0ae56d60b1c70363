"""Driver contract: entry() runs; every query with a SQL twin matches DuckDB
at sf0.001 (row count, column names, values)."""

import pytest

import __spark_entry__ as entry
from platehub.plans import registry
from platehub.testing.oracle import compare, duckdb_conn

SF = "/root/testdata/sf0.001"
STREAMS = {n for n in registry.QUERIES if n.startswith("stream_")}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns == ["MachineName", "ProgramName", "CuttingTime", "Repeats"]


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(registry.QUERIES) == set(registry.ORACLE)  # every one has its SQL


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF)


@pytest.mark.parametrize("name", sorted(set(registry.ORACLE) - STREAMS))
def test_query_matches_oracle(spark, con, name):
    r = compare(entry.queries()[name](spark, SF), con, entry.oracle_sql()[name])
    assert r["cols_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


@pytest.mark.parametrize("name", sorted(STREAMS))
def test_stream_matches_oracle(spark, con, name):
    r = compare(registry.QUERIES[name](spark, SF), con, registry.ORACLE[name])
    assert r["cols_match"] and r["values_match"], r


def test_entry_without_the_optional_parts(tmp_path):
    """A copy of the repository without the optional folders still imports."""
    import os
    import shutil
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(entry.__file__))
    copy = tmp_path / "copy"
    shutil.copytree(root, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__", ".pytest_cache"))
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(sorted(e.queries()))"], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": ""})
    assert said.returncode == 0, said.stderr
    assert eval(said.stdout.strip().splitlines()[-1]) == sorted(registry.QUERIES)


def test_cli_lists_and_rejects_unknown(capsys):
    from platehub.__main__ import main

    assert main(["list"]) == 0
    out = capsys.readouterr().out
    assert "open_programs_by_machine" in out and "stream_program_state" in out
    assert main(["run", "no_such_query"]) == 2
