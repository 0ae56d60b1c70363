"""Streams: equality with the batch jobs, restarts, replays, and what a
micro-batch reads and writes (T1, T2, T3, T4, C12)."""

import re

from pyspark.sql import functions as F

from conftest import rows
from platehub.plans.queue import QUEUE_COLUMNS, conform
from platehub.plans.reconcile import DEMAND_KEYS, INVENTORY_KEYS, demand_changes, inventory_changes, reconcile_demand, reconcile_inventory
from platehub.streaming.intake import DEMAND_CALL_SCHEMA, INVENTORY_CALL_SCHEMA, call_stream, json_array_calls, scratch_dir, start_batches, start_gate
from platehub.streaming.jobs import OUTBOX_SCHEMA, Arrivals, in_drops
from platehub.streaming.queue_log import QueueLog, stage_changes


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_of(spark, path):
    return {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}


# the queue's log ------------------------------------------------------------


def demand_tables(v):
    return dict(part=v.part_wo, pip=v.pip, slab_part_alloc=v.slab_part_alloc, config=v.config)


def thirds(calls):
    seqs = sorted(r.seq for r in calls.select("seq").collect())
    a, b = seqs[len(seqs) // 3], seqs[2 * len(seqs) // 3]
    return [calls.where(F.col("seq") <= a), calls.where((F.col("seq") > a) & (F.col("seq") <= b)), calls.where(F.col("seq") > b)]


def test_log_of_three_batches_equals_one_batch(spark, views):
    v = views
    calls = v.demand_events.select(*DEMAND_CALL_SCHEMA.fieldNames())
    one = reconcile_demand(calls, trans_act=v.trans_act, **demand_tables(v))
    log = QueueLog(spark, scratch_dir(spark, "log"), DEMAND_KEYS).start(v.trans_act)
    step = stage_changes(log, demand_changes, **demand_tables(v))
    parts = thirds(calls)
    written = [files_of(spark, f"{log.root}/log")]
    for i, p in enumerate(parts):
        step(p, i)
        written.append(files_of(spark, f"{log.root}/log"))
        # a batch only adds its own folder
        assert written[-2] < written[-1] and all(f"/batch={i}/" in f for f in written[-1] - written[-2])
    columns = list(QUEUE_COLUMNS)
    assert rows(log.current(), columns) == rows(one, columns)
    step(parts[2], 2)  # a replay after a failure
    assert rows(log.current(), columns) == rows(one, columns)
    assert rows(log.current(before=1), columns) == rows(reconcile_demand(parts[0], trans_act=v.trans_act, **demand_tables(v)), columns)


def test_gate_reads_event_ids_only(spark, views):
    v = views
    log = QueueLog(spark, scratch_dir(spark, "log-plan"), DEMAND_KEYS).start(v.trans_act)
    calls = v.demand_events.select(*DEMAND_CALL_SCHEMA.fieldNames())
    removals, adds = demand_changes(calls, trans_act=log.rows(7), **demand_tables(v))
    plan = plan_text(removals.unionByName(adds))
    scans = [m for m in re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*/log", plan)]
    assert scans and all({c.split("#")[0] for c in s.split(",")} <= {"ItemData18", "batch"} for s in scans), scans
    assert "batch#" in plan and "PartitionFilters: [isnotnull(batch" in plan


def test_later_adds_supersede_across_batches(spark):
    log = QueueLog(spark, scratch_dir(spark, "log-order"), ["ItemName"])
    schema = "TransType string, ItemName string, ItemData18 string, Ordinal long"
    row = lambda *r: conform(spark.createDataFrame(list(r), schema))
    none = row(("x", "x", "x", 0)).limit(0)
    log.start(row(("old", "A", None, 99), ("old", None, None, 98), ("old", "C", "e0", None)))
    log.append(0, row(("rem", "A", "e1", 10)), row(("add", "A", "e1", 11), ("add", None, "e1", 13), ("add", "B", "e2", 15)))
    log.append(1, row(("rem", "B", "e3", 4)), row(("add", "A", "e3", 5)))  # a late call: larger batch, smaller ordinal
    log.append(2, none, none)
    got = rows(log.current(), ["TransType", "ItemName", "Ordinal"])
    assert got == sorted([("add", "A", 5), ("old", None, 98), ("add", None, 13), ("add", "B", 15), ("rem", "B", 4), ("old", "C", None)], key=repr)


def test_compaction_keeps_queue_and_gate(spark, views):
    v = views
    calls = v.inventory_events.select(*INVENTORY_CALL_SCHEMA.fieldNames())
    tables = dict(stock=v.stock, slab_sheet_alloc=v.slab_sheet_alloc, config=v.config)
    parts = thirds(calls)
    log = QueueLog(spark, scratch_dir(spark, "log-long"), INVENTORY_KEYS).start(v.trans_act)
    for i, p in enumerate(parts[:2]):
        stage_changes(log, inventory_changes, **tables)(p, i)
    short = log.compact(scratch_dir(spark, "log-short"))
    columns = list(QUEUE_COLUMNS)
    assert rows(short.current(), columns) == rows(log.current(), columns)
    events = lambda g: {r[0] for r in g.rows().select(F.explode(F.array("ItemData18", "BinNumber"))).where("col is not null").collect()}
    assert events(short) == events(log)
    for g in (log, short):
        stage_changes(g, inventory_changes, **tables)(parts[2], 2)
    assert rows(short.current(), columns) == rows(log.current(), columns)
    one = reconcile_inventory(calls, trans_act=v.trans_act, **tables)
    assert rows(short.current(), columns) == rows(one, columns)


def test_removals_of_a_hot_material_are_pruned(spark):
    """One material holds nearly all sheets, each added anew after the removals: the
    join makes no pair that a later add supersedes."""
    sheets, events = 400, 25
    stock = spark.createDataFrame([(f"S{i}", "HOT" if i else "COLD", "m", 1.0, 1.0, 1.0, "0") for i in range(sheets)], "SheetName string, PrimeCode string, Material string, Thickness double, Width double, Length double, BinNumber string")
    calls = [(e, f"{e:020d}", "AFR", None, None, 0, "HOT") for e in range(1, events + 1)]
    calls += [(1000 + i, f"{events:020d}", "AFR", f"S{i}", "Sheet", 1, "HOT") for i in range(sheets - 10)]
    calls = spark.createDataFrame(calls, "seq long, sap_event_id string, sap_system string, sheet_name string, sheet_type string, qty int, mm string")
    config = spark.createDataFrame([("AFR", 1, "t")], "SapSystem string, SimTransDistrict int, RemnantDxfTemplate string")
    alloc = spark.createDataFrame([], "SheetName string")
    queue = conform(spark.createDataFrame([], "TransType string"))
    removals, adds = inventory_changes(calls, stock, alloc, config, queue)
    assert removals.count() == 10 * events  # of 25 x 399 pairs, those of the ten sheets without an add
    assert rows(removals.groupBy("ItemName").count()) == sorted([(f"S{i}", events) for i in range(sheets - 10, sheets)], key=repr)
    assert adds.count() == sheets - 10
    out = reconcile_inventory(calls, stock, alloc, config, queue)
    assert out.count() == 10 * events + sheets - 10


# the gate in the state store ------------------------------------------------


def gate_runs(spark, drops, schema="seq long, sap_event_id string, note string"):
    """One run of the query for each drop, each from the checkpoint of the last."""
    root = scratch_dir(spark, "gate")
    data = [(k, *r) for k, drop in enumerate(drops) for r in drop]
    arrivals = Arrivals(spark.createDataFrame(data, f"k int, {schema}"), f"{root}/in", F.col("k"))
    passed = []
    for k in range(len(drops)):
        arrivals.arrive(k)
        q = start_gate(arrivals.stream(schema), f"{root}/passed", f"{root}/ck")
        q.awaitTermination()
        passed.append(rows(spark.read.parquet(f"{root}/passed"), ["seq", "sap_event_id"]))
    return passed, q


def test_gate_forgets_nothing(spark):
    """Late events pass, known events do not, however old; of a batch's calls the
    lowest passes; calls without an event never do.  Each drop is a restart."""
    passed, last = gate_runs(spark, [
        [(11, "e1", "b"), (10, "e1", "a"), (12, None, "x")],
        [(5, "e2", None), (12, "e3", "c"), (1, "e1", "late"), (7, None, "y")],
        [(13, "e2", "d"), (14, "e1", "e")],
        [(2, "e9", "f"), (3, "e9", "g")],
    ])
    assert passed == [
        [(10, "e1")], [(10, "e1"), (12, "e3"), (5, "e2")], [(10, "e1"), (12, "e3"), (5, "e2")], [(10, "e1"), (12, "e3"), (2, "e9"), (5, "e2")]
    ]
    progress = last.lastProgress
    assert progress["numInputRows"] == 2  # the last run read its own calls and nothing older
    assert progress["stateOperators"][0]["numRowsTotal"] == 4
    assert "RocksDB" in str(spark.conf.get("spark.sql.streaming.stateStore.providerClass"))


def test_gate_takes_the_lowest_call_of_many_tasks(spark):
    """The calls of a hot event lie in many files."""
    root = scratch_dir(spark, "gate-hot")
    calls = spark.range(4000).select((F.lit(5000) - F.col("id")).alias("seq"), F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("e"), F.col("id") % 50)).alias("sap_event_id"))
    calls.repartition(7).write.parquet(f"{root}/in")
    start_gate(call_stream(spark, f"{root}/in", calls.schema), f"{root}/passed", f"{root}/ck").awaitTermination()
    want = rows(calls.groupBy("sap_event_id").agg(F.min("seq").alias("seq")), ["sap_event_id", "seq"])
    assert rows(spark.read.parquet(f"{root}/passed"), ["sap_event_id", "seq"]) == want


# program posts --------------------------------------------------------------


def test_completions_do_not_depend_on_the_cut(spark, views):
    """T4: any cut of the posts into micro-batches, in any order, completes the
    repeats that one batch completes; a replayed batch changes nothing."""
    from platehub.plans.programs import stage_completion
    from platehub.streaming.program_state import StagedCompletions, stage_batches

    v = views
    posts = v.program_state_events
    want = rows(stage_completion(posts, v.program, v.trans_act), ["ProgramName", "ProgramRepeat"])
    store = StagedCompletions(spark, scratch_dir(spark, "t4-test")).start(v.trans_act)
    step = stage_batches(store, v.program)
    for batch, k in enumerate((2, 0, 3, 1)):
        step(posts.where(F.pmod(F.xxhash64("post_seq"), F.lit(4)) == k), batch)
    assert rows(store.rows(), ["ProgramName", "ProgramRepeat"]) == want
    step(posts.where(F.pmod(F.xxhash64("post_seq"), F.lit(4)) == 1), 3)
    assert rows(store.rows(), ["ProgramName", "ProgramRepeat"]) == want


def test_latest_state_with_late_posts(spark):
    """A late post changes nothing, and a batch writes the programs it has posts of."""
    from platehub.streaming.program_state import read_latest_state, start_latest_state

    root = scratch_dir(spark, "t4-latest")
    schema = "post_seq long, program string, batch string, state string"
    data = [(0, 5, "P", "b", "Complete"), (0, 1, "Q", "b", "Initiated"), (1, 3, "P", "b", "Processing"), (1, 2, "Q", "b", None), (2, 9, "R", None, "Complete")]
    data += [(0, i, f"old{i}", "b", "Complete") for i in range(200)]
    arrivals = Arrivals(spark.createDataFrame(data, f"k int, {schema}"), root, F.col("k"))
    in_drops([arrivals], lambda: start_latest_state(arrivals.stream(schema), f"{root}/out", f"{root}/ck"))
    latest = read_latest_state(spark, f"{root}/out")
    assert rows(latest.where("program not like 'old%'"), ["program", "post_seq", "batch", "state"]) == [("P", 5, "b", "Complete"), ("Q", 2, "b", None), ("R", 9, None, "Complete")]
    assert latest.count() == 203
    written = {r.step: r["count"] for r in spark.read.parquet(f"{root}/out").groupBy("step").count().collect()}
    assert written[0] == 202 and written[1] == 2 and written[2] == 1


def test_updates_wait_for_their_program(spark):
    from platehub.streaming.program_update import POST_SCHEMA, PROGRAM_SCHEMA, UpdateStore, posts_and_programs, stage_updates

    config = spark.createDataFrame([("AFR", 1)], "SapSystem string, SimTransDistrict int")
    event = lambda n: f"{n:020d}"
    posts = [(0, 1, "AFR", event(1), 10), (0, 2, "AFR", event(2), 20), (0, 3, "ZZZ", event(3), 10), (0, 4, "AFR", event(4), None), (1, 5, "AFR", event(5), 20), (2, 6, "AFR", event(6), 30), (2, 7, "AFR", event(7), 99)]
    programs = [(1, 20, "P20", 1), (1, 20, "P20", 2), (1, 30, "P30", 1), (2, 77, "P77", 1)]
    root = scratch_dir(spark, "update")
    store = UpdateStore(spark, f"{root}/store").start(spark.createDataFrame([(10, "P10", 1)], "ArchivePacketID long, ProgramName string, RepeatID int"))
    sent = Arrivals(spark.createDataFrame(posts, f"k int, {POST_SCHEMA}"), f"{root}/posts", F.col("k"))
    late = Arrivals(spark.createDataFrame(programs, f"k int, {PROGRAM_SCHEMA}"), f"{root}/programs", F.col("k"))
    step = stage_updates(store, config)
    in_drops([sent, late], lambda: start_batches(posts_and_programs(sent.stream(POST_SCHEMA), late.stream(PROGRAM_SCHEMA)), step, f"{root}/ck"))
    got = rows(store.staged(), ["TransID", "ProgramName", "ProgramRepeat"])
    assert got == sorted([(event(1)[-10:], "P10", 1), *[(event(n)[-10:], "P20", r) for n in (2, 5) for r in (1, 2)], (event(6)[-10:], "P30", 1)], key=repr)
    assert [rows(store.pending(k), ["seq"]) for k in range(3)] == [[(2,)], [], [(7,)]]
    # a replay of a batch stages the same
    both = spark.createDataFrame([r[1:] for r in posts if r[0] == 1], POST_SCHEMA), spark.createDataFrame([r[1:] for r in programs if r[0] == 1], PROGRAM_SCHEMA)
    step(posts_and_programs(*both), 1)
    assert rows(store.staged(), ["TransID", "ProgramName", "ProgramRepeat"]) == got


# the outbox -----------------------------------------------------------------


def test_outbox_export_then_compaction(spark, views):
    from platehub.streaming.outbox import compact_outbox, start_outbox_export, store_children

    v = views
    root = scratch_dir(spark, "t2-test")
    v.st_prg_arc.write.parquet(f"{root}/outbox")
    children = store_children(spark, root, v.st_pip_arc, v.part_wo, v.remnant)
    start_outbox_export(call_stream(spark, f"{root}/outbox", OUTBOX_SCHEMA), root, v.stock, children).awaitTermination()
    children.forget()
    docs = spark.read.json(f"{root}/docs")
    assert docs.where("state = 'created'").count() == v.st_prg_arc.join(v.stock, "SheetName").where(
        "TransType = 'SN100'").count()
    assert compact_outbox(spark, v.st_prg_arc, root).count() == 0


def test_children_are_not_shuffled(spark, views):
    """Without broadcasts, no exchange lies between a batch's joins and the scans of
    the stored children."""
    from platehub.plans.feedback import documents_of_children, feedback_documents
    from platehub.streaming.outbox import store_children

    v = views
    children = store_children(spark, scratch_dir(spark, "t2-plan"), v.st_pip_arc, v.part_wo, v.remnant)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k) for k in keys}
    outbox = v.st_prg_arc.where("AutoID % 3 = 0")
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        docs = documents_of_children(outbox, v.stock, *children.tables())
        lines = plan_text(docs).split("\n")
        assert rows(docs) == rows(feedback_documents(outbox, v.stock, v.st_pip_arc, v.part_wo, v.remnant))
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line and "platehub_" in line]
    assert len(scans) >= 2 and all("Bucketed: true" in lines[i] for i in scans)
    for i in scans:
        depth, j = re.search(r"\w", lines[i]).start(), i
        while "Join" not in lines[j]:  # up the tree to the first join
            j -= 1
            if re.search(r"\w", lines[j]).start() < depth:
                depth = re.search(r"\w", lines[j]).start()
                assert "Exchange" not in lines[j], "\n".join(lines[j : i + 1])
    children.forget()


# intake forms ---------------------------------------------------------------


def test_json_array_intake(spark):
    raw = spark.createDataFrame(
        [('[{"seq": 1, "sap_event_id": "00000000000000000001", "sap_system": "AFR", "part_name": "J1-P1", '
          '"work_order": "WO1", "qty": 3, "job": "J1"}, {"seq": 2, "sap_event_id": "00000000000000000001", '
          '"sap_system": "AFR", "part_name": "J1-P1", "work_order": "WO2", "qty": 0, "job": "J1"}]',)],
        "value string",
    )
    got = json_array_calls(raw, DEMAND_CALL_SCHEMA)
    assert rows(got, ["seq", "work_order", "qty"]) == [(1, "WO1", 3), (2, "WO2", 0)]


def test_drops_arrive_in_parallel_files_and_may_be_empty(spark):
    root = scratch_dir(spark, "arrivals")
    arrivals = Arrivals(spark.range(100).repartition(5), root, F.when(F.col("id") < 60, 0).otherwise(2))
    seen = []
    in_drops([arrivals], lambda: start_batches(arrivals.stream("id long"), lambda b, k: seen.append((k, b.count())), f"{root}/ck"))
    assert [n for _, n in seen] == [60, 40] and len(files_of(spark, f"{root}/arrived/0")) == 5


def test_periodic_trigger(spark, views):
    """The same intake with a processing-time trigger."""
    v = views
    root = scratch_dir(spark, "t6-test")
    v.demand_events.select(*DEMAND_CALL_SCHEMA.fieldNames()).write.parquet(f"{root}/calls")
    log = QueueLog(spark, f"{root}/queue", DEMAND_KEYS).start(v.trans_act)
    step = stage_changes(log, demand_changes, **demand_tables(v))
    q = start_batches(call_stream(spark, f"{root}/calls", DEMAND_CALL_SCHEMA), step, f"{root}/ck", trigger={"processingTime": "1 second"})
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    assert log.current().count() > v.trans_act.count()
