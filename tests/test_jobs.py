"""Composite jobs: golden scenarios and document / digest consistency."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from platehub.operators.documents import child_arrays, exact_sum
from platehub.plans import demand as dm
from platehub.plans import feedback as fb
from platehub.plans import nest as ns
from platehub.plans import programs as pg
from platehub.plans.audit import read_snapshot, snapshot_tables
from platehub.sources.batches import read_batch_dimensions, read_batches


def test_open_programs_loop_closes_after_completion(spark):
    program = spark.createDataFrame(
        [("P1", 1, 11, "M1", 60.0, "S1"), ("P1", 2, 12, "M1", 60.0, "S1"), ("P2", 1, 21, "M2", 30.0, "S2")],
        "ProgramName string, RepeatID int, ArchivePacketID int, MachineName string, CuttingTime double, "
        "SheetName string",
    )
    pm = program.select("MachineName", "ProgramName", "CuttingTime").distinct()
    queue = spark.createDataFrame([], "TransType string, ProgramName string, ProgramRepeat int")
    before = rows(pg.open_programs(pm, program, queue))
    assert before == [("M1", "P1", 60.0, 2), ("M2", "P2", 30.0, 1)]
    posts = spark.createDataFrame([(1, "P2", "b", "Complete"), (2, "P1", "b", "Complete")],
                                  "post_seq long, program string, batch string, state string")
    staged = pg.stage_completion(posts, program, queue)
    assert rows(staged, ["ProgramName", "ProgramRepeat"]) == [("P1", 1), ("P2", 1)]
    after = rows(pg.open_programs(pm, program, staged.select("TransType", "ProgramName", "ProgramRepeat")))
    assert after == [("M1", "P1", 60.0, 1)]
    assert rows(pg.open_programs(pm, program, queue, machine="M2")) == [("M2", "P2", 30.0, 1)]


def test_program_update_needs_config(spark):
    events = spark.createDataFrame([("AAA", "00000000000000000042", 11), ("ZZZ", "00000000000000000043", 11)],
                                   "sap_system string, sap_event_id string, archive_packet_id int")
    program = spark.createDataFrame([("P1", 1, 11)], "ProgramName string, RepeatID int, ArchivePacketID int")
    config = spark.createDataFrame([("AAA", 3, None)], "SapSystem string, SimTransDistrict int, RemnantDxfTemplate string")
    got = rows(pg.stage_program_update(events, program, config))
    assert got == [("SN76", 3, "0000000042", "P1", 1)]


def test_feedback_documents_agree_with_summary(spark, views):
    v = views
    docs = fb.feedback_documents(v.st_prg_arc, v.stock, v.st_pip_arc, v.part_wo, v.remnant)
    summ = fb.feedback_summary(v.st_prg_arc, v.stock, v.st_pip_arc, v.part_wo, v.remnant)
    from_docs = docs.select(
        "ArchivePacketID",
        "state",
        F.when(F.col("nest").isNotNull(), F.size("nest.parts")).alias("parts_n"),
        F.col("nest.program.programName").alias("ProgramName"),
        F.when(F.col("nest").isNotNull(), F.size("nest.remnants")).alias("remnants_n"),
    )
    assert rows(from_docs) == rows(summ.select("ArchivePacketID", "state", "parts_n", "ProgramName", "remnants_n"))
    # marker states carry no document
    assert docs.where("state <> 'created' AND nest IS NOT NULL").count() == 0
    small = fb.feedback_documents(v.st_prg_arc, v.stock, v.st_pip_arc, v.part_wo, v.remnant, page_size=3)
    per = small.groupBy("ArchivePacketID", "state").agg(
        F.sum(F.size("nest.parts")).alias("parts_n"), F.sum(F.size("nest.remnants")).alias("remnants_n"))
    assert rows(per) == rows(summ.select("ArchivePacketID", "state", "parts_n", "remnants_n"))
    # arrays are sorted (deterministic documents)
    first = docs.where("state = 'created' AND size(nest.parts) > 1").select("nest.parts").first()[0]
    assert [tuple(p) for p in first] == sorted(tuple(p) for p in first)


def test_nest_documents_agree_with_summary_and_paging(spark, views):
    v = views
    docs = ns.nest_documents(v.program, v.pip, v.part_wo, v.stock, v.remnant)
    summ = ns.nest_summary(v.program, v.pip, v.part_wo, v.stock, v.remnant)
    got = docs.select(
        F.col("program.programName").alias("ProgramName"), F.size("parts").alias("parts_n"),
        F.size("remnants").alias("remnants_n"), F.col("sheet.sheetName").alias("SheetName"),
    )
    assert rows(got) == rows(summ.select("ProgramName", "parts_n", "remnants_n", "SheetName"))
    # small pages: same children, spread over several rows per program
    small = ns.nest_documents(v.program, v.pip, v.part_wo, v.stock, v.remnant, page_size=2)
    per_prog = small.groupBy(F.col("program.programName").alias("ProgramName")).agg(
        F.sum(F.size("parts")).alias("parts_n"), F.sum(F.size("remnants")).alias("remnants_n"))
    assert rows(per_prog) == rows(summ.select("ProgramName", "parts_n", "remnants_n"))
    assert small.where("page > 0").count() > 0
    one = ns.nest_documents(v.program, v.pip, v.part_wo, v.stock, v.remnant, program_name="PRG1")
    assert one.count() <= 1
    paged = ns.nest_parts(v.pip, v.part_wo)
    arr = child_arrays(paged, ["ProgramName"], ns.NEST_PART_FIELDS, "parts", page_size=2, child_id=["WONumber", *ns.NEST_PART_FIELDS])
    n = arr.select(F.explode("parts")).count()
    assert n == paged.count()


def test_nest_literal_join_fans_out(spark):
    pip = spark.createDataFrame([("A", "W1", "P", 1, 2.0, 3.0)],
                                "PartName string, WONumber string, ProgramName string, QtyInProcess int, "
                                "TrueArea double, NestedArea double")
    part = spark.createDataFrame([("A", "W1", "J1", "1"), ("A", "W2", "J2", "2")],
                                 "PartName string, WONumber string, Data1 string, Data2 string")
    assert ns.nest_parts(pip, part).count() == 1
    assert ns.nest_parts(pip, part, literal=True).count() == 2  # D6


def test_batch_csv_source_and_grouping(spark, tmp_path):
    p = tmp_path / "batches.csv"
    lines = ["id,mm,sheet_name,remnant"]
    lines += [f"{i:010d},MM-9006,MM-9006,N" for i in range(1, 14)]
    lines += [f"{i:010d},MM-9008,MM-9008,N" for i in range(20, 28)]
    lines += ["0000000099,MM-9100,SBX01,Y"]
    p.write_text("\n".join(lines) + "\n")
    b = read_batches(spark, str(p))
    assert b.where("id = '0000000001'").count() == 1  # leading zeros kept
    grouped = rows(ns.batches_by_sheet(spark.read.schema("id string, mm string, sheet_name string, remnant string")
                                       .option("header", True).csv(str(p))), ["sheet_name", "id", "batches"])
    assert grouped == [("MM-9006", "0000000001", 13), ("MM-9008", "0000000020", 8), ("SBX01", "0000000099", 1)]
    bad = tmp_path / "bad.csv"
    bad.write_text("id,mm,sheet_name,remnant\n0000000001,M,S,Q\n")
    with pytest.raises(Exception):
        read_batches(spark, str(bad)).collect()


def test_odd_batch_dimensions_keep_rows(spark, tmp_path):
    p = tmp_path / "odd.csv"
    p.write_text("batch,sheet_name,batch_level,width,length\n1,SBX01,Y,,286\n2,SBX04,Y,104,x\n")
    got = rows(read_batch_dimensions(spark, str(p)), ["batch", "width", "length"])
    assert got == [("1", None, 286.0), ("2", 104.0, None)]


PART = "PartName string, WONumber string, QtyOrdered int, QtyCompleted int"


def test_demand_revision_scenarios(spark):
    part = spark.createDataFrame([("X11F", "WO", 1, 0), ("X5K", "WO", 3, 0), ("X10B", "WO", 0, 0)], PART)
    ip = spark.createDataFrame([("X11F", "WO", 1)], "PartName string, WONumber string, QtyInProcess int")
    revised = dm.revise_demand(part, ip, part_name="X11F")
    assert rows(revised, ["PartName", "QtyOrdered"]) == [("X10B", 0), ("X11F", 1), ("X5K", 3)]
    # an unrelated zero order is staged too (no name filter)
    assert rows(dm.zero_order_deletes(revised), ["TransType", "ItemName"]) == [("SN82", "X10B")]
    ip0 = spark.createDataFrame([("X11F", "WO", 0)], "PartName string, WONumber string, QtyInProcess int")
    r0 = dm.revise_demand(part, ip0, part_name="X11F")
    assert rows(r0.where("PartName = 'X11F'"), ["QtyOrdered"]) == [(0,)]
    empty = spark.createDataFrame([], "PartName string, WONumber string, QtyInProcess int")
    assert rows(dm.revise_demand(part, empty), ["PartName", "QtyOrdered"]) == rows(part, ["PartName", "QtyOrdered"])


def test_demand_overlay_has_one_marker(spark, views):
    v = views
    out = dm.overlay_demand(v.part_wo, dm.parts_in_process(v.part_wo, v.pip), v.demand_events)
    assert out.where("TransType = 'SN89I'").count() == 1
    phases = rows(out.groupBy("Phase").agg(F.min("TransType").alias("t")), ["Phase", "t"])
    assert [p for p, _ in phases] == [0, 1, 2]


def test_stock_overlay_markers_then_reload(spark, views):
    out = dm.overlay_stock(views.inventory_events, views.config)
    assert rows(out.where("Phase = 0"), ["TransType"]) == [("SN95",), ("SN95R",)]
    rem = out.where("TransType = 'SN97'").first()
    assert rem is None or rem.FileName.endswith(rem.ItemName + ".dxf")


def test_spreadsheet_ingest(spark):
    rows_in = spark.createDataFrame(
        [("E1", "1230039B-G12A-A1", 10.7, None, 1.0), ("E2", "1230039B-X5K", 3.0, None, 2.0)],
        "event_id string, part string, qty double, unused string, shipment double",
    )
    got = rows(dm.ingest_spreadsheet_demand(rows_in), ["TransType", "OrderNo", "ItemName", "Qty", "ItemData1"])
    assert got == [("SN81B", "1230039B-1-main", "1230039B_G12A-A1", 10, "1230039B"),
                   ("SN81B", "1230039B-2-sec", "1230039B_X5K", 3, "1230039B")]


def test_snapshot_roundtrip(spark, views, tmp_path):
    tables = {"stock": views.stock, "config": views.config}
    folder = snapshot_tables(tables, str(tmp_path))
    for name, df in tables.items():
        back = read_snapshot(spark, folder, name)
        assert back.count() == df.count()
    assert os.path.basename(folder).startswith("snapshot_ts=")


def test_exact_sum_is_order_independent(spark):
    vals = [0.1, 0.2, 0.3, 1e6 + 0.0001, 12345.6789]
    a = spark.createDataFrame([(v,) for v in vals], "x double").agg(exact_sum(F.col("x")).alias("s")).first().s
    b = spark.createDataFrame([(v,) for v in reversed(vals)], "x double").repartition(3).agg(
        exact_sum(F.col("x")).alias("s")).first().s
    assert a == b


def test_document_export_roundtrip(spark, views, tmp_path):
    from platehub.sources.sinks import document_json, export_documents

    v = views
    docs = ns.nest_documents(v.program, v.pip, v.part_wo, v.stock, v.remnant)
    export_documents(docs, str(tmp_path / "nests"), max_records_per_file=50)
    back = spark.read.json(str(tmp_path / "nests"))
    assert back.count() == docs.count()
    assert {"archivePacketId", "program", "parts", "sheet", "remnants"} <= set(back.columns)
    js = document_json(docs, "archivePacketId").first()
    assert '"programName"' in js.json


def test_point_lookups_and_named_queries(spark, views, tmp_path):
    import __spark_entry__ as entry
    from platehub.plans import lookups as lk
    from platehub.plans.demand import ingest_spreadsheet_demand
    from platehub.sources.spreadsheet import read_spreadsheet_csv

    v = views
    name = v.program.first().ProgramName
    assert lk.program_by_name(v.program, name).count() >= 1
    got = lk.sql_lookup(spark, v.program, "SELECT * FROM t WHERE ProgramName = :p", p=name)
    assert got.count() == lk.program_by_name(v.program, name).count()
    pk = v.st_pip_arc.where("TransType = 'SN100'").first().ArchivePacketID
    assert lk.parts_by_packet(v.st_pip_arc, pk).count() >= 1
    r = v.remnant.first()
    assert lk.remnants_by_program(v.remnant, r.ProgramName, r.RepeatID).count() >= 1
    with pytest.raises(KeyError):
        lk.run_named(entry.queries(), "no_such_query", spark, "/root/testdata/sf0.001")
    assert lk.run_named(entry.queries(), "machine_list", spark, "/root/testdata/sf0.001").count() > 0
    p = tmp_path / "sheet.csv"
    p.write_text("event_id,part,qty,unused,shipment\nE1,1230039B-G12A-A1,10.0,,1.0\n")
    assert ingest_spreadsheet_demand(read_spreadsheet_csv(spark, str(p))).first().OrderNo == "1230039B-1-main"


def test_bom_lookup_case_insensitive_first_match(spark):
    from platehub.plans.bom import bom_lookup

    bom = spark.createDataFrame(
        [(1, 0, "X10b", 1), (1, 0, "x10B", 2), (1, 0, "X11", 3), (2, 0, "X10B", 4)],
        "job int, shipment int, mark string, qty int",
    )
    assert bom_lookup(bom, 1, 0).count() == 3
    hit = bom_lookup(bom, 1, 0, mark="X10B").collect()
    assert len(hit) == 1 and hit[0].mark.lower() == "x10b" and hit[0].job == 1
    assert bom_lookup(bom, 1, 0, mark="nope").count() == 0


def test_export_order_newest_first(spark, views):
    v = views
    docs = fb.feedback_documents(v.st_prg_arc, v.stock, v.st_pip_arc, v.part_wo, v.remnant)
    ids = [r.AutoID for r in fb.export_order(docs).select("AutoID").limit(5).collect()]
    assert ids == sorted(ids, reverse=True)


def test_completion_literal_stages_nothing(spark, views):
    v = views
    assert pg.stage_completion(v.program_state_events, v.program, v.trans_act, literal=True).count() == 0


def test_diff_between_two_snapshots(spark, views, tmp_path):
    import datetime as dt

    from platehub.plans.audit import diff_snapshots

    stock = views.stock.select("SheetName", "PrimeCode", "Qty")
    first = snapshot_tables({"stock": stock}, str(tmp_path), dt.datetime(2024, 1, 1))
    changed = stock.where("Qty <> 0").withColumn("Qty", F.when(F.col("Qty") == 1, 99).otherwise(F.col("Qty")))
    second = snapshot_tables({"stock": changed}, str(tmp_path), dt.datetime(2024, 1, 2))
    d = diff_snapshots(spark, first, second, "stock", ["SheetName"], "SheetName string, PrimeCode string, Qty int")
    counts = {r.status: r["count"] for r in d.groupBy("status").count().collect()}
    assert counts.get("delete") == stock.where("Qty = 0").count()
    assert counts.get("change") == stock.where("Qty = 1").count()
    assert "add" not in counts


CONFIG_ROWS = [("AAA", 1, "/dxf/remnants/<sheet_name>.dxf")]
ICALLS = "seq long, sap_system string, sheet_name string, sheet_type string, qty int, mm string, matl string"


def test_stock_scenarios(spark):
    """Batch level, sheet to remnant, remnant changes MM, destructive import."""
    config = spark.createDataFrame(CONFIG_ROWS, "SapSystem string, SimTransDistrict int, RemnantDxfTemplate string")
    mm = "50/50W-0012"
    # batch level: the one sheet of 12 becomes 11 + a separate batch of 1
    feed = spark.createDataFrame([(1, "AAA", mm, "Sheet", 11, mm, "MS"), (2, "AAA", "S001", "Sheet", 1, mm, "MS")],
                                 ICALLS)
    out = dm.overlay_stock(feed, config)
    assert rows(out, ["Phase", "TransType", "ItemName", "Qty"]) == [
        (0, "SN95", None, None), (0, "SN95R", None, None), (1, "SN91A", mm, 11), (1, "SN91A", "S001", 1)]
    # sheet to remnant: a remnant row with its file name
    feed2 = feed.unionByName(spark.createDataFrame([(3, "AAA", "R008", "Remnant", 1, mm, "MS")], ICALLS))
    r = dm.overlay_stock(feed2, config).where("ItemName = 'R008'").first()
    assert (r.TransType, r.FileName) == ("SN97", "/dxf/remnants/R008.dxf")
    # remnant changes MM: the later call wins
    feed3 = feed2.unionByName(spark.createDataFrame([(4, "AAA", "R008", "Remnant", 1, "9-MS-0012", "MS")], ICALLS))
    assert dm.overlay_stock(feed3, config).where("ItemName = 'R008'").first().PrimeCode == "9-MS-0012"
    # destructive import: attributes that are not in the feed do not survive a reload
    assert "SpecialInstruction" not in dm.overlay_stock(feed3, config).columns


def test_demand_overlay_scenario(spark):
    part = spark.createDataFrame(
        [(p, "1230039B-1-G", q, 0) for p, q in
         [("1230039B_X5K", 3), ("1230039B_X10B", 1), ("1230039B_X11F", 1), ("1230039B_X13C", 2),
          ("1230039B_X13F", 1), ("1230039B_X15F", 9)]], PART)
    # X10B has nothing completed and nothing in process: its order drops to 0
    ip = spark.createDataFrame([(p, "1230039B-1-G", q) for p, q in
                                [("1230039B_X5K", 3), ("1230039B_X10B", 0), ("1230039B_X11F", 16),
                                 ("1230039B_X13C", 2), ("1230039B_X13F", 1), ("1230039B_X15F", 9)]],
                               "PartName string, WONumber string, QtyInProcess int")
    calls = spark.createDataFrame(
        [(i, "1230039B-1-G", p, q, "1230039B") for i, (p, q) in enumerate(
            [("1230039B_X5K", 3), ("1230039B_X11F", 16), ("1230039B_X13C", 2), ("1230039B_X13F", 1),
             ("1230039B_X15F", 9)])],
        "seq long, work_order string, part_name string, qty int, job string")
    out = dm.overlay_demand(part, ip, calls)
    got = rows(out, ["Phase", "TransType", "ItemName"])
    assert got[0] == (0, "SN82", "1230039B_X10B")
    assert [g[1] for g in got if g[0] == 1] == ["SN89I"]
    reload = [g[2] for g in got if g[0] == 2]
    assert len(reload) == 5 and "1230039B_X10B" not in reload


def test_batch_grouping_ten_groups(spark, tmp_path):
    sizes = [("9006", 13), ("9008", 8), ("9010", 8), ("9012", 12), ("9100", 3), ("9108", 4)]
    lines, n = ["id,mm,sheet_name,remnant"], 502899
    for mm, k in sizes:
        for _ in range(k):
            lines.append(f"{n:010d},50/50W-{mm},50/50W-{mm},N")
            n += 1
    for i in range(1, 5):
        lines.append(f"{n:010d},50/50W-9100,SBX0{i},Y")
        n += 1
    p = tmp_path / "b.csv"
    p.write_text("\n".join(lines) + "\n")
    raw = spark.read.schema("id string, mm string, sheet_name string, remnant string").option("header", True).csv(str(p))
    got = {r.sheet_name: r.batches for r in ns.batches_by_sheet(raw).collect()}
    assert len(got) == 10 and len(lines) - 1 == 52
    assert [got[f"50/50W-{mm}"] for mm, _ in sizes] == [k for _, k in sizes]
    assert all(got[f"SBX0{i}"] == 1 for i in range(1, 5))


def test_cached_batches_view(spark, tmp_path):
    from platehub.sources.batches import cached_batches

    p = tmp_path / "c.csv"
    p.write_text("id,mm,sheet_name,remnant\n0000000001,M,S,N\n0000000002,M,S,Y\n")
    df = cached_batches(spark, str(p), view="batches_test")
    assert df.is_cached
    assert spark.sql("SELECT count(*) AS n FROM batches_test").first().n == 2
    df.unpersist()


def test_bad_batch_code_fails_even_without_type_column(spark, tmp_path):
    bad = tmp_path / "bad2.csv"
    bad.write_text("id,mm,sheet_name,remnant\n0000000001,M,S,N\n0000000002,M,S,Q\n")
    with pytest.raises(Exception):
        read_batches(spark, str(bad)).select("id").collect()


def test_duplicate_config_rows_pick_smallest_district(spark):
    from platehub.plans.queue import district_by_system

    config = spark.createDataFrame([("AAA", 9, "/b/<sheet_name>"), ("AAA", 3, "/a/<sheet_name>"), ("BBB", 5, None)],
                                   "SapSystem string, SimTransDistrict int, RemnantDxfTemplate string")
    got = rows(district_by_system(config), ["cfg_system", "cfg_district", "cfg_template"])
    assert got == [("AAA", 3, "/a/<sheet_name>"), ("BBB", 5, None)]
    events = spark.createDataFrame([("AAA", "00000000000000000042", 11)],
                                   "sap_system string, sap_event_id string, archive_packet_id int")
    program = spark.createDataFrame([("P1", 1, 11)], "ProgramName string, RepeatID int, ArchivePacketID int")
    assert rows(pg.stage_program_update(events, program, config), ["District"]) == [(3,)]


def test_snapshot_diff_applies_on_proxy_stock(spark, views):
    from platehub.operators.changelog import apply_diff, snapshot_diff
    from platehub.plans.registry import _STOCK_VALUES, _stock_versions

    old, new = _stock_versions(views)
    diff = snapshot_diff(old, new, ["SheetName"], _STOCK_VALUES)
    cols = ["SheetName", *_STOCK_VALUES]
    assert rows(apply_diff(old.select(*cols), diff, ["SheetName"]), cols) == rows(new.select(*cols), cols)
