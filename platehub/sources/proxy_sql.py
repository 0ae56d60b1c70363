"""SQL text of the proxy tables, for the DuckDB oracle only.

These are the fixture definitions of FIXTURES.md part 2 (plus two event
tables of ours).  ``with_views`` prefixes an oracle query with exactly the
CTEs it references, in dependency order.
"""

from __future__ import annotations

import re

# Fixed view definitions (fixture values), in dependency order.
VIEW_SQL: dict[str, str] = {
    "config": (
        "select upper(substr(r_name,1,3)) SapSystem, cast(r_regionkey+1 as int) SimTransDistrict, "
        "concat('/dxf/',lower(r_name),'/<sheet_name>.dxf') RemnantDxfTemplate from region"
    ),
    "st_prg_arc": """SELECT o_orderkey AS AutoID, o_orderkey AS ArchivePacketID,
  CASE WHEN o_orderstatus = 'O' THEN 'SN100' WHEN o_orderstatus = 'F' THEN 'SN101' WHEN o_orderpriority = '5-LOW' THEN 'SN109' ELSE 'SN102' END AS TransType,
  'PRG' || o_custkey AS ProgramName, o_orderkey AS RepeatID, o_orderpriority AS MachineName, o_totalprice AS CuttingTime, 'S' || o_custkey AS SheetName
FROM orders""",
    "program": (
        "select ProgramName,RepeatID,ArchivePacketID,MachineName,CuttingTime,SheetName from st_prg_arc "
        "where TransType<>'SN101'"
    ),
    "stock": """SELECT 'S' || p_partkey AS SheetName, 'MM' || p_partkey // 10 AS PrimeCode, p_type AS Material, p_size * 0.125::DOUBLE AS Thickness, CAST(48 + p_size AS DOUBLE) AS Width,
  p_retailprice AS Length, CAST(p_size % 10 AS INTEGER) AS Qty, CASE WHEN p_partkey % 7 <> 0 THEN lpad(CAST(p_partkey % 100 AS VARCHAR), 20, '0') END AS BinNumber
FROM part""",
    "part_wo": """SELECT 'J' || l_partkey % 50 || '-P' || l_partkey AS PartName, 'WO' || l_orderkey AS WONumber, CAST(sum(l_quantity) AS INTEGER) AS QtyOrdered,
  CAST(sum(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'A' THEN l_quantity ELSE 0 END) AS INTEGER) AS QtyCompleted, 'J' || l_partkey % 50 AS Data1,
  CASE min(l_linenumber) WHEN 3 THEN '' WHEN 4 THEN 'n/a' WHEN 5 THEN NULL ELSE ' ' || min(l_linenumber) END AS Data2,
  CASE WHEN l_partkey % 7 <> 0 THEN lpad(CAST(l_partkey % 100 AS VARCHAR), 20, '0') END AS Data18
FROM lineitem GROUP BY l_partkey, l_orderkey""",
    "pip": (
        "select concat('J',cast(l_partkey%50 as varchar(20)),'-P',cast(l_partkey as varchar(20))) PartName, "
        "concat('WO',cast(l_orderkey as varchar(20))) WONumber, p.ProgramName, cast(l_quantity as int) "
        "QtyInProcess, l_extendedprice*(1-l_discount) TrueArea, l_extendedprice NestedArea from lineitem "
        "join st_prg_arc p on p.ArchivePacketID=l_orderkey where l_linestatus='O'"
    ),
    "st_pip_arc": (
        "select l_orderkey*1000000000+l_partkey*10000+l_suppkey*10+l_linenumber AutoID, l_orderkey "
        "ArchivePacketID, p.TransType, p.SheetName, concat('J',cast(l_partkey%50 as varchar(20)),'-P',"
        "cast(l_partkey as varchar(20))) PartName, concat('WO',cast(l_orderkey as varchar(20))) WONumber, "
        "cast(case when l_returnflag='R' then 0 else l_quantity end as int) QtyInProcess, "
        "l_extendedprice*(1-l_discount) TrueArea, l_extendedprice NestedArea from lineitem join st_prg_arc p "
        "on p.ArchivePacketID=l_orderkey"
    ),
    "remnant": """SELECT 'R' || l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS RemnantName, p.ProgramName, p.RepeatID,
  l_quantity AS Length, l_quantity / 2 AS Width, l_quantity * l_quantity / 2 AS Area, l_quantity * 7.5::DOUBLE AS Weight, 'MM' || l_partkey // 10 AS PrimeCode, CAST(l_linenumber AS INTEGER) AS Qty
FROM lineitem JOIN st_prg_arc p ON p.ArchivePacketID = l_orderkey WHERE l_returnflag = 'R'""",
    "st_prt_arc": """SELECT l_orderkey AS ArchivePacketID, 'J' || l_partkey % 50 || '-P' || l_partkey AS PartName, CAST(l_quantity AS INTEGER) AS QtyProgram,
  'J' || l_partkey % 50 AS Data1, CASE WHEN l_linenumber = 4 THEN 'n/a' WHEN l_linenumber <> 3 THEN CAST(l_linenumber AS VARCHAR) END AS Data2,
  l_extendedprice * (1 - l_discount) AS TrueArea, l_extendedprice AS NestedArea FROM lineitem WHERE l_linestatus = 'F'""",
    "st_wo_arc": "SELECT 'WO' || o_orderkey AS WONumber FROM orders",
    "sip": "select ProgramName,RepeatID,SheetName from program",
    "batches": """SELECT lpad(CAST(p_partkey AS VARCHAR), 10, '0') AS id, p_brand AS mm, 'S' || p_partkey // 4 AS sheet_name, CASE p_type WHEN 'PROMO' THEN 'Y' ELSE 'N' END AS remnant FROM part""",
    "trans_act": """SELECT 'SN70' AS TransType, CAST(1 AS INTEGER) AS District, right(e, 10) AS TransID, e AS ItemData18, e AS BinNumber, ProgramName, RepeatID AS ProgramRepeat
FROM (SELECT *, CASE AutoID % 2 WHEN 0 THEN lpad(CAST(AutoID // 8 AS VARCHAR), 20, '0') ELSE '9' || lpad(CAST(AutoID // 8 AS VARCHAR), 19, '0') END AS e
      FROM st_prg_arc WHERE MachineName = '5-LOW')""",
    "slab_part_alloc": """SELECT 'J' || event_id // 10 % 50 || '-P' || event_id // 10 AS PartName, 'WO' || user_id AS WoNumber, CAST(floor(value / 2) AS INTEGER) AS Qty
FROM events WHERE event_type = 'purchase'""",
    "demand_events": """SELECT event_id AS seq, lpad(CAST(e AS VARCHAR), 20, '0') AS sap_event_id, CASE e % 6 WHEN 0 THEN 'AFR' WHEN 1 THEN 'AME' WHEN 2 THEN 'ASI' WHEN 3 THEN 'EUR' WHEN 4 THEN 'MID' ELSE 'OLD' END AS sap_system, 'J' || e % 50 || '-P' || e AS part_name,
  'WO' || user_id AS work_order, CAST(floor(value) AS INTEGER) AS qty, CASE WHEN e % 9 <> 0 THEN 'J' || e % 50 END AS job, 'M' || e % 7 AS matl, 'C-' || event_type AS state,
  'D' || e AS dwg, CASE event_type WHEN 'click' THEN 'CG' END AS codegen, CAST(e % 4 AS VARCHAR) AS shipment, 'CR' || user_id AS chargeref,
  CASE event_type WHEN 'error' THEN 'DRILL' END AS op1, CASE event_type WHEN 'signup' THEN 'BEVEL' END AS op2, CASE event_type WHEN 'view' THEN 'PAINT' END AS op3,
  CASE WHEN e % 13 = 0 THEN 'MK' || e END AS mark, 'R' || e % 11 AS raw_mm, event_type, ts
FROM (SELECT *, event_id // 10 AS e FROM events)""",
    "bom": (
        "select cast(p_partkey%20 as int) job, cast(p_partkey%4 as int) shipment, "
        "concat('X',cast(p_partkey as varchar(20))) mark, cast(1+p_size%5 as int) qty, case p_type when "
        "'ECONOMY' then 'PL' when 'MEDIUM' then 'SHT' when 'LARGE' then 'PL' else 'W' end type, "
        "cast(p_size as double)/16 thk, cast(20+p_size*2 as double) wid, cast(p_size as double)*7.25 len, "
        "case p_partkey%5 when 0 then 'A240 Type 304' when 1 then 'A606 TYPE 4' when 2 then 'A709' when 3 "
        "then 'A709' else 'A588' end spec, case p_partkey%3 when 0 then '50' when 1 then 'HPS70W' else "
        "'345W' end grade, case p_partkey%4 when 0 then 'T' when 1 then 'FCM' else '' end test, case "
        "p_partkey%11 when 0 then 'SRM' when 1 then 'BEV. FILL' else '' end remark, case p_partkey%3 when "
        "0 then '03' when 1 then '04' else '07' end item from part"
    ),
    "inventory_events": """SELECT event_id AS seq, lpad(CAST(e AS VARCHAR), 20, '0') AS sap_event_id, CASE e % 6 WHEN 0 THEN 'AFR' WHEN 1 THEN 'AME' WHEN 2 THEN 'ASI' WHEN 3 THEN 'EUR' WHEN 4 THEN 'MID' ELSE 'OLD' END AS sap_system, 'S' || event_id // 5 AS sheet_name,
  CASE event_type WHEN 'error' THEN 'Remnant' ELSE 'Sheet' END AS sheet_type, CAST(floor(value / 2) AS INTEGER) AS qty, 'MM' || event_id // 100 AS mm, 'A' || e % 7 AS matl,
  user_id % 8 / 8 AS thk, CAST(user_id % 90 AS DOUBLE) AS wid, CAST(user_id % 500 AS DOUBLE) AS len, 'n' || user_id AS notes1,
  CASE event_type WHEN 'error' THEN 'check' END AS notes2, CAST(e % 3 AS VARCHAR) AS notes3, event_type AS notes4
FROM (SELECT *, event_id // 10 AS e FROM events)""",
    "slab_sheet_alloc": """SELECT 'S' || p_partkey // 20 AS SheetName FROM part""",
    "program_machine": "select distinct MachineName, ProgramName, CuttingTime from program",
    # ours: operator state posts and program update events
    "program_state_events": (
        "select o_orderkey post_seq, concat('PRG',cast(o_custkey as varchar(20))) program, "
        "lpad(cast(o_orderkey as varchar(20)),10,'0') batch, case o_orderpriority when '1-URGENT' then "
        "'Complete' when '2-HIGH' then 'Processing' when '3-MEDIUM' then 'Initiated' when "
        "'4-NOT SPECIFIED' then 'Cancelled' else 'Complete' end state from orders"
    ),
    "program_update_events": """SELECT event_id AS seq, CASE e % 6 WHEN 0 THEN 'AFR' WHEN 1 THEN 'AME' WHEN 2 THEN 'ASI' WHEN 3 THEN 'EUR' WHEN 4 THEN 'MID' ELSE 'OLD' END AS sap_system, lpad(CAST(event_id AS VARCHAR), 20, '0') AS sap_event_id, event_id AS archive_packet_id
FROM (SELECT *, event_id AS e FROM events WHERE event_type = 'purchase')""",
}

_ORDER = list(VIEW_SQL)


def _deps(sql: str) -> set[str]:
    return {v for v in VIEW_SQL if re.search(rf"\b{v}\b", sql)}


def with_views(body: str, extra_ctes: list[tuple[str, str]] | None = None) -> str:
    """Return ``WITH <needed views>, <extra ctes> <body>``."""
    extra_ctes = extra_ctes or []
    needed: set[str] = set()
    frontier = _deps(body) | set().union(*[_deps(sql) for _, sql in extra_ctes])
    while frontier:
        v = frontier.pop()
        if v in needed:
            continue
        needed.add(v)
        frontier |= _deps(VIEW_SQL[v]) - {v}
    ctes = [(v, VIEW_SQL[v]) for v in _ORDER if v in needed] + list(extra_ctes)
    if not ctes:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({s})" for n, s in ctes) + "\n" + body
