"""Plan audit over every registered batch query: the physical plans must not
contain the operators that do not scale (cartesian products, nested-loop
joins, row-at-a-time Python UDFs), and scans must be column-pruned."""

import re

import pytest

from platehub.plans import feedback as fb
from platehub.plans import nest as ns
from platehub.plans import registry
from platehub.plans.reconcile import demand_changes, inventory_changes
from platehub.streaming.jobs import posted_arrays

SF = "/root/testdata/sf0.001"
STREAMS = {n for n in registry.QUERIES if n.startswith("stream_")}
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - STREAMS))
def test_plan_has_no_unscalable_operators(spark, name):
    df = registry.QUERIES[name](spark, SF)
    plan = plan_text(df)
    for op in FORBIDDEN:
        assert op not in plan, f"{name}: {op} in plan"


def test_lineitem_scans_are_pruned(spark):
    df = registry.QUERIES["part_feedback"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    schemas = [c for c in re.findall(r"ReadSchema: struct<([^>]*)>", plan) if "l_orderkey" in c]
    assert schemas, plan
    for cols in schemas:
        if "l_orderkey" in cols:
            assert "l_comment" not in cols and "l_shipdate" not in cols and "l_tax" not in cols


def test_filters_reach_the_scan(spark, views):
    from pyspark.sql import functions as F

    plan = plan_text(views.table("orders").where(F.col("o_orderkey") == 7).select("o_custkey"))
    assert "PushedFilters: [IsNotNull(o_orderkey), EqualTo(o_orderkey,7)]" in plan


@pytest.mark.parametrize("name,scans,exchanges", [
    ("demand_reconcile", 10, 16), ("inventory_reconcile", 10, 14), ("nest_documents", 10, 22), ("feedback_documents", 10, 22),
    ("program_complete", 4, 10), ("open_programs_by_machine", 4, 8),
])
def test_plans_without_broadcasts(spark, name, scans, exchanges):
    """The plan at scale, where no side is small enough to be broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plan = plan_text(registry.QUERIES[name](spark, SF))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert not any(op in plan for op in FORBIDDEN)
    assert plan.count("FileScan parquet") <= scans and plan.count("Exchange hashpartitioning") <= exchanges


def test_lines_are_not_sorted_for_their_programs(spark, views):
    """At scale a task would hold its share of the lines to sort them."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        plans = [plan_text(df) for df in (views.st_pip_arc, views.pip, views.remnant, registry.QUERIES["retention_purge_all"](spark, SF))]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert all("ShuffledHashJoin" in p and "SortMergeJoin" not in p and "Sort [" not in p for p in plans)


def test_audit_deals_keys_out_before_it_adds_them_up(spark):
    """Nearly every key differs: the tasks that scan a table hold none of them."""
    lines = plan_text(registry.QUERIES["constraint_audit"](spark, SF)).splitlines()
    adds = [i for i, line in enumerate(lines) if "HashAggregate(keys=[check" in line and "key" in line.split("functions")[0]]
    dealt = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line]
    assert len(dealt) == 1 and adds and max(adds) < dealt[0]


def test_documents_are_not_shuffled_once_they_are_made(spark, views):
    """Above the aggregates that make the arrays there is no exchange."""
    v = views
    documents = (ns.nest_documents(v.program, v.pip, v.part_wo, v.stock, v.remnant), fb.feedback_documents(v.st_prg_arc, v.stock, v.st_pip_arc, v.part_wo, v.remnant))
    for docs in documents:
        lines = plan_text(docs).splitlines()
        arrays = [i for i, line in enumerate(lines) if "collect_list(" in line and "partial_collect_list(" not in line]
        assert len(arrays) == 2
        for i in arrays:
            depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
            for line in reversed(lines[:i]):
                at = len(line) - len(line.lstrip(" :+-"))
                if at < depth:
                    depth = at
                    assert "Exchange" not in line and "FullOuter" not in line


@pytest.mark.parametrize("kind", ["demand", "inventory"])
def test_first_calls_are_narrow(spark, views, kind):
    """First calls are sorted for: a row has what the removals need of it."""
    v = views
    if kind == "demand":
        removals, _ = demand_changes(v.demand_events, v.part_wo, v.pip, v.slab_part_alloc, v.config, v.trans_act)
    else:
        removals, _ = inventory_changes(v.inventory_events, v.stock, v.slab_sheet_alloc, v.config, v.trans_act)
    firsts = [line for line in plan_text(removals).splitlines() if "min_by(struct(" in line and "sap_event_id" in line]
    assert firsts and not any("notes" in line or "chargeref" in line for line in firsts)


def test_gate_does_not_hold_the_queue(spark, views):
    """The ids of all staged events are not broadcast, whatever their files' size."""
    v = views
    removals, _ = inventory_changes(v.inventory_events, v.stock, v.slab_sheet_alloc, v.config, v.trans_act)
    plan = plan_text(removals)
    assert plan.count("LeftAnti") == 2
    assert all("SortMergeJoin" in line for line in plan.splitlines() if "LeftAnti" in line)


def test_posted_calls_are_dealt_out_before_they_are_gathered(spark, views):
    """The task that scans a table holds none of its calls."""
    lines = plan_text(posted_arrays(views.inventory_events)).splitlines()
    gathers = [i for i, line in enumerate(lines) if "collect_list(" in line]
    dealt = [i for i, line in enumerate(lines) if "REPARTITION_BY_COL" in line]
    assert gathers and len(dealt) == 1 and max(gathers) < dealt[0]
