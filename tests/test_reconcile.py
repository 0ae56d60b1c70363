"""Demand / inventory reconciliation: golden micro-cases and a property test
against a call-by-call simulation of the procedures (brute force on small
random inputs).

The simulator below follows the procedure steps literally, one call at a
time, with SQL NULL rules: it is the slow, obviously-sequential model; the
Spark jobs are the set-based plans under test.
"""

import random

import pytest

from platehub.plans.reconcile import reconcile_demand, reconcile_inventory
from platehub.plans.queue import QUEUE_COLUMNS

CONFIG = [("AAA", 7, "/dxf/a/<sheet_name>.dxf"), ("BBB", 9, None)]
CONFIG_SCHEMA = "SapSystem string, SimTransDistrict int, RemnantDxfTemplate string"
PART_SCHEMA = "PartName string, WONumber string, QtyCompleted int, Data18 string"
PIP_SCHEMA = "PartName string, WONumber string, QtyInProcess int"
ALLOC_SCHEMA = "PartName string, WoNumber string, Qty int"
CALL_SCHEMA = "seq long, sap_system string, sap_event_id string, work_order string, part_name string, qty int, job string"
QUEUE_SCHEMA = ", ".join(f"{c} {t}" for c, t in QUEUE_COLUMNS.items())
STOCK_SCHEMA = "SheetName string, PrimeCode string, Material string, Thickness double, Width double, " \
               "Length double, BinNumber string"
ICALL_SCHEMA = "seq long, sap_system string, sap_event_id string, sheet_name string, sheet_type string, qty int, " \
               "mm string, matl string"


def _right10(s):
    return None if s is None else s[-10:]


def _eq(a, b):
    """SQL '=': unknown (None) when either side is NULL."""
    return None if a is None or b is None else a == b


def _not_in(x, values):
    """SQL ``x NOT IN (values)``: True / False / None."""
    if not values:
        return True
    if x is None:
        return None
    if x in [v for v in values if v is not None]:
        return False
    return None if any(v is None for v in values) else True


def _cfg(system):
    for s, d, t in CONFIG:
        if s == system:
            return d, t
    return None


def _row(**kw):
    r = dict.fromkeys(QUEUE_COLUMNS)
    r.update(kw)
    return r


def simulate_demand(calls, parts, pip, alloc, queue, literal):
    queue = [dict(r) for r in queue]
    known = {r[c] for r in queue for c in ("ItemData18", "BinNumber")} - {None}
    seen_events = set()
    for seq, system, event, wo, part, qty, job in sorted(calls):
        tid = _right10(event)
        mark = part.replace((job or "") + "-", "") if part is not None else None
        if literal:
            gate = _not_in(tid, [r["TransID"] for r in queue]) is True
        else:
            gate = event is not None and event not in seen_events and event not in known
            seen_events.add(event)
        cfg = _cfg(system)
        if gate and cfg:
            for pn, pwo, completed, d18 in parts:
                if pn == part and _eq(d18, event) is False:
                    inproc = sum(q for a, b, q in pip if a == pn and b == pwo)
                    committed = None if completed is None else completed + inproc
                    tt = "SN82" if committed == 0 else "SN81"
                    queue.append(_row(TransType=tt, District=cfg[0], TransID=tid, OrderNo=pwo, ItemName=pn,
                                      Qty=committed, ItemData18=event, Ordinal=2 * seq))
        hits = [q for a, b, q in alloc if a == part and b == wo]
        if hits:
            net = qty - sum(hits)
        else:
            net = None if literal else qty
        if net is not None and net > 0:
            queue = [r for r in queue if not (_eq(r["OrderNo"], wo) and _eq(r["ItemName"], part)
                                              and _eq(r["ItemData18"], event))]
            if cfg:
                queue.append(_row(TransType="SN81", District=cfg[0], TransID=tid, OrderNo=wo, ItemName=part,
                                  Qty=net, ItemData1=job, ItemData9=mark, ItemData14="HighHeatNum",
                                  ItemData18=event, Ordinal=2 * seq + 1))
    return queue


def simulate_inventory(calls, stock, alloc_sheets, queue, literal):
    queue = [dict(r) for r in queue]
    known = {r[c] for r in queue for c in ("ItemData18", "BinNumber")} - {None}
    seen_events = set()
    for seq, system, event, sheet, stype, qty, mm, matl in sorted(calls):
        tid = _right10(event)
        if literal:
            gate = _not_in(tid, [r["TransID"] for r in queue]) is True
        else:
            gate = event is not None and event not in seen_events and event not in known
            seen_events.add(event)
        cfg = _cfg(system)
        if gate and cfg:
            for name, prime, material, thk, wid, length, binno in stock:
                if prime == mm and _eq(binno, event) is False:
                    queue.append(_row(TransType="SN91A", District=cfg[0], TransID=tid, ItemName=name, Qty=0,
                                      Material=material, Thickness=thk, Length=length, Width=wid,
                                      Ordinal=2 * seq))
        net = qty - sum(1 for s in alloc_sheets if s == sheet)
        if net > 0:
            queue = [r for r in queue if not _eq(r["ItemName"], sheet)]
            if cfg:
                rem = stype == "Remnant"
                fname = cfg[1].replace("<sheet_name>", sheet) if rem and cfg[1] is not None else None
                queue.append(_row(TransType="SN97" if rem else "SN91A", District=cfg[0], TransID=tid,
                                  ItemName=sheet, Qty=net, Material=matl, PrimeCode=mm, BinNumber=event,
                                  FileName=fname, Ordinal=2 * seq + 1))
    return queue


def _key(r, cols):
    return tuple(r[c] for c in cols)


DEMAND_COLS = ["TransType", "District", "TransID", "OrderNo", "ItemName", "Qty", "ItemData1", "ItemData9",
               "ItemData14", "ItemData18", "Ordinal"]
INVENTORY_COLS = ["TransType", "District", "TransID", "ItemName", "Qty", "Material", "Thickness", "Width",
                  "Length", "PrimeCode", "BinNumber", "FileName", "Ordinal"]


def _spark_rows(df, cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def _sim_rows(q, cols):
    return sorted((_key(r, cols) for r in q), key=repr)


def _demand_frames(spark, calls, parts, pip, alloc, queue):
    return dict(
        calls=spark.createDataFrame(calls, CALL_SCHEMA),
        part=spark.createDataFrame(parts, PART_SCHEMA),
        pip=spark.createDataFrame(pip, PIP_SCHEMA),
        slab_part_alloc=spark.createDataFrame(alloc, ALLOC_SCHEMA),
        config=spark.createDataFrame(CONFIG, CONFIG_SCHEMA),
        trans_act=spark.createDataFrame([tuple(r[c] for c in QUEUE_COLUMNS) for r in queue], QUEUE_SCHEMA),
    )


def run_demand(spark, calls, parts, pip, alloc, queue, literal):
    f = _demand_frames(spark, calls, parts, pip, alloc, queue)
    return reconcile_demand(f["calls"], f["part"], f["pip"], f["slab_part_alloc"], f["config"], f["trans_act"],
                            literal=literal)


EV = "0000000000{:010d}"


# -- golden micro-cases --------------------------------------------------------------


@pytest.mark.parametrize(
    "alloc,literal,want",
    [
        ([], True, []),                                              # D1: NULL netting, nothing pushed
        ([], False, [("SN81", 5)]),                                  # intended: full demand
        ([("X1", "W1", 2), ("X1", "W1", 1)], False, [("SN81", 2)]),  # partly allocated
        ([("X1", "W1", 5)], False, []),                              # fully allocated: only removals
    ],
)
def test_demand_netting(spark, alloc, literal, want):
    calls = [(1, "AAA", EV.format(1), "W1", "X1", 5, "J")]
    out = run_demand(spark, calls, [], [], alloc, [], literal)
    assert _spark_rows(out, ["TransType", "Qty"]) == want


def test_committed_removal_replaced_by_readd(spark):
    parts = [("X1", "W1", 2, EV.format(99)), ("X1", "W2", 0, EV.format(99)), ("X1", "W3", 0, None)]
    pip = [("X1", "W1", 1), ("X1", "W1", 1)]
    calls = [(1, "AAA", EV.format(1), "W1", "X1", 3, "J")]
    out = run_demand(spark, calls, parts, pip, [], [], False)
    got = _spark_rows(out, ["TransType", "OrderNo", "Qty"])
    # W1 committed 4 -> SN81 removal, replaced by the add of the same event;
    # W2 nothing committed -> SN82 qty 0; W3 never touched (NULL Data18) -> none
    assert got == [("SN81", "W1", 3), ("SN82", "W2", 0)]


def test_null_transid_in_queue_closes_literal_gate(spark):
    parts = [("X1", "W1", 0, EV.format(99))]
    queue = [_row(TransType="SN70", District=1, TransID=None, ProgramName="P", ProgramRepeat=1)]
    calls = [(1, "AAA", EV.format(1), "W9", "X1", 0, "J")]
    lit = run_demand(spark, calls, parts, [], [], queue, True)
    intended = run_demand(spark, calls, parts, [], [], queue, False)
    assert _spark_rows(lit, ["TransType"]) == [("SN70",)]
    assert _spark_rows(intended, ["TransType"]) == [("SN70",), ("SN82",)]


def test_unknown_system_stages_nothing(spark):
    calls = [(1, "ZZZ", EV.format(1), "W1", "X1", 5, "J")]
    assert run_demand(spark, calls, [("X1", "W1", 0, EV.format(2))], [], [], [], False).count() == 0


# -- property test against the call-by-call simulation ---------------------------------


def _demand_scenario(rng, s):
    """One in-contract scenario; every key carries the scenario number so
    scenarios cannot interact when run together."""
    P = [f"S{s}-J{s}-P{i}" for i in range(2)]
    W = [f"S{s}W{i}" for i in range(3)]
    events = [f"{900 + s:010d}{s:05d}{e:05d}" for e in range(4)]
    parts = []
    for p in P:
        for w in W:
            if rng.random() < 0.7:
                comp = rng.choice([0, 0, 1, 2, None])
                d18 = rng.choice([None] + events)
                parts.append((p, w, comp, d18))
    pip = [(rng.choice(P), rng.choice(W), rng.randint(0, 2)) for _ in range(rng.randint(0, 4))]
    alloc = [(rng.choice(P), rng.choice(W), rng.randint(0, 3)) for _ in range(rng.randint(0, 3))]
    queue = []
    for e in events:
        if rng.random() < 0.25:  # already staged before the batch: TransID = right(ItemData18, 10)
            queue.append(_row(TransType="SN81", District=7, TransID=e[-10:], OrderNo=rng.choice(W),
                              ItemName=rng.choice(P), Qty=1, ItemData18=e))
        elif rng.random() < 0.25:  # another event, with the same last ten characters
            queue.append(_row(TransType="SN70", District=7, TransID=e[-10:], ProgramName="PRG", ProgramRepeat=2,
                              ItemData18="9" + e[1:]))
    if rng.random() < 0.3:
        queue.append(_row(TransType="SN70", District=1, TransID=f"{s:05d}99999", ProgramName="PRG", ProgramRepeat=1))
    calls, seq = [], s * 1000
    for e in rng.sample(events, rng.randint(1, 4)):
        part = rng.choice(P)  # one part per event, calls of an event contiguous
        for _ in range(rng.randint(1, 3)):
            seq += 1
            calls.append((seq, rng.choice(["AAA", "BBB"]), e, rng.choice(W), part, rng.randint(0, 5), f"J{s}"))
    return calls, parts, pip, alloc, queue


@pytest.mark.parametrize("literal", [False, True])
def test_demand_matches_call_by_call_simulation(spark, literal):
    rng = random.Random(20240 + literal)
    scen = [_demand_scenario(rng, s) for s in range(150)]
    calls = [c for sc in scen for c in sc[0]]
    parts = [p for sc in scen for p in sc[1]]
    pip = [p for sc in scen for p in sc[2]]
    alloc = [a for sc in scen for a in sc[3]]
    queue = [q for sc in scen for q in sc[4]]
    want = []
    for sc in scen:
        want += simulate_demand(*sc, literal=literal)
    got = run_demand(spark, calls, parts, pip, alloc, queue, literal)
    assert _spark_rows(got, DEMAND_COLS) == _sim_rows(want, DEMAND_COLS)


def _inventory_scenario(rng, s):
    mms = [f"S{s}MM{i}" for i in range(2)]
    sheets = [f"S{s}SH{i}" for i in range(4)]
    events = [f"{800 + s:010d}{s:05d}{e:05d}" for e in range(4)]
    stock = []
    for sh in sheets:
        if rng.random() < 0.8:
            stock.append((sh, rng.choice(mms), "MS", 0.5, 96.0, 240.0, rng.choice([None] + events)))
    alloc = [rng.choice(sheets) for _ in range(rng.randint(0, 3))]
    queue = []
    for e in events:
        if rng.random() < 0.25:  # staged earlier, under a name no call of this batch touches
            queue.append(_row(TransType="SN91A", District=7, TransID=e[-10:], ItemName=f"S{s}OLD{e[-2:]}", Qty=1,
                              BinNumber=e))
        elif rng.random() < 0.25:
            queue.append(_row(TransType="SN70", District=7, TransID=e[-10:], ProgramName="PRG", ProgramRepeat=2,
                              BinNumber="9" + e[1:]))
    calls, seq = [], s * 1000
    for e in rng.sample(events, rng.randint(1, 4)):
        mm = rng.choice(mms)  # one material master per event, calls contiguous
        system = rng.choice(["AAA", "BBB"])
        for _ in range(rng.randint(1, 3)):
            seq += 1
            calls.append((seq, system, e, rng.choice(sheets), rng.choice(["Sheet", "Remnant"]), rng.randint(0, 3),
                          mm, "MS"))
    return calls, stock, alloc, queue


@pytest.mark.parametrize("literal", [False, True])
def test_inventory_matches_call_by_call_simulation(spark, literal):
    rng = random.Random(777 + literal)
    scen = [_inventory_scenario(rng, s) for s in range(150)]
    calls = [c for sc in scen for c in sc[0]]
    stock = [x for sc in scen for x in sc[1]]
    alloc = [a for sc in scen for a in sc[2]]
    queue = [q for sc in scen for q in sc[3]]
    want = []
    for sc in scen:
        want += simulate_inventory(*sc, literal=literal)
    got = reconcile_inventory(
        spark.createDataFrame(calls, ICALL_SCHEMA),
        spark.createDataFrame(stock, STOCK_SCHEMA),
        spark.createDataFrame([(a,) for a in alloc], "SheetName string"),
        spark.createDataFrame(CONFIG, CONFIG_SCHEMA),
        spark.createDataFrame([tuple(r[c] for c in QUEUE_COLUMNS) for r in queue], QUEUE_SCHEMA),
        literal=literal,
    )
    assert _spark_rows(got, INVENTORY_COLS) == _sim_rows(want, INVENTORY_COLS)


def test_replaying_a_batch_is_idempotent(spark):
    rng = random.Random(5)
    calls, parts, pip, alloc, queue = _demand_scenario(rng, 1)
    once = run_demand(spark, calls, parts, pip, alloc, queue, False)
    f = _demand_frames(spark, calls, parts, pip, alloc, queue)
    twice = reconcile_demand(f["calls"], f["part"], f["pip"], f["slab_part_alloc"], f["config"], once)
    assert _spark_rows(twice, DEMAND_COLS) == _spark_rows(once, DEMAND_COLS)


@pytest.mark.parametrize("literal", [False, True])
def test_null_event_add_closes_later_gates_literally(spark, literal):
    parts = [("X2", "W2", 0, EV.format(99)), ("X1", "W1", 1, EV.format(98))]
    calls = [(1, "AAA", None, "W1", "X1", 5, "J"), (2, "AAA", EV.format(2), "W2", "X2", 0, "J")]
    alloc = [("X1", "W1", 1)]  # so the literal netting is not NULL
    got = run_demand(spark, calls, parts, [], alloc, [], literal)
    want = simulate_demand(calls, parts, [], alloc, [], literal)
    assert _spark_rows(got, DEMAND_COLS) == _sim_rows(want, DEMAND_COLS)
    kinds = sorted(r.TransType for r in got.collect())
    assert kinds == (["SN81"] if literal else ["SN81", "SN82"])


def test_queue_invariants_on_proxy_data(spark, views):
    from pyspark.sql import functions as F

    v = views
    out = reconcile_demand(v.demand_events, v.part_wo, v.pip, v.slab_part_alloc, v.config, v.trans_act)
    new = out.where(F.col("Ordinal").isNotNull())
    adds = new.where(F.col("Ordinal") % 2 == 1)
    # at most one surviving add per (work order, part, event)
    assert adds.groupBy("OrderNo", "ItemName", "ItemData18").count().where("count > 1").count() == 0
    # the gate opens once per event: all removals of an event come from one call
    rem = new.where(F.col("Ordinal") % 2 == 0)
    assert rem.groupBy("ItemData18").agg(F.countDistinct("Ordinal").alias("n")).where("n > 1").count() == 0
    # an event that is in the queue opens no gate; one that shares its tail does
    assert rem.join(v.trans_act.select("ItemData18"), "ItemData18", "left_semi").count() == 0
    # pre-existing rows are never touched (their keys are NULL)
    assert out.where(F.col("Ordinal").isNull()).count() == v.trans_act.count()
    inv = reconcile_inventory(v.inventory_events, v.stock, v.slab_sheet_alloc, v.config, v.trans_act)
    inv_adds = inv.where(F.col("Ordinal") % 2 == 1)
    # inventory: the last add per sheet evicts every earlier row of that sheet
    last = inv_adds.groupBy("ItemName").agg(F.max("Ordinal").alias("m"))
    assert inv.join(last, "ItemName").where(F.col("Ordinal") < F.col("m")).count() == 0


def test_inventory_replay_does_not_open_the_gate_again(spark):
    """Removals carry the event, so a second batch of the same event removes nothing."""
    stock = spark.createDataFrame([("S1", "MM", "MS", 0.5, 96.0, 240.0, EV.format(5))], STOCK_SCHEMA)
    alloc, config = spark.createDataFrame([], "SheetName string"), spark.createDataFrame(CONFIG, CONFIG_SCHEMA)
    queue = spark.createDataFrame([], QUEUE_SCHEMA)
    one = reconcile_inventory(spark.createDataFrame([(1, "AAA", EV.format(1), "S9", "Sheet", 0, "MM", "MS")], ICALL_SCHEMA), stock, alloc, config, queue)
    assert one.count() == 1
    again = spark.createDataFrame([(2, "AAA", EV.format(1), "S9", "Sheet", 0, "MM", "MS"), (3, "AAA", "9" + EV.format(1)[1:], "S9", "Sheet", 0, "MM", "MS")], ICALL_SCHEMA)
    two = reconcile_inventory(again, stock, alloc, config, one)
    assert _spark_rows(two, ["Ordinal"]) == [(2,), (6,)]


def test_unknown_system_quarantine(spark):
    from platehub.plans.reconcile import unknown_system_calls

    calls = spark.createDataFrame([(1, "ZZZ", EV.format(1), "W1", "X1", 5, "J"), (2, "AAA", EV.format(1), "W1", "X1", 5, "J"), (3, None, EV.format(1), "W1", "X1", 5, "J")], CALL_SCHEMA)
    assert _spark_rows(unknown_system_calls(calls, spark.createDataFrame(CONFIG, CONFIG_SCHEMA)), ["seq"]) == [(1,), (3,)]
