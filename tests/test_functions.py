"""Golden cases for the scalar expressions (F1-F17, P2, P3, S1 decode)."""

import pytest
from pyspark.sql import functions as F

from platehub.functions import bom as B
from platehub.functions import codes
from platehub.functions import text as X


def one(spark, expr, schema, row):
    return spark.createDataFrame([row], schema).select(expr.alias("v")).first()["v"]


def test_runtime_text(spark):
    df = spark.createDataFrame([(3725.0,), (3599.6,), (0.0,)], "t double")
    got = [r.v for r in df.select(X.runtime_text(F.col("t")).alias("v")).collect()]
    assert got == ["1:2:5", "0:59:60", "0:0:0"]


@pytest.mark.parametrize(
    "x,feet,want",
    [(30.5, True, "2'-6 1/2"), (0.75, False, "3/4"), (24.0, True, "2'-0"), (7.25, False, "7 1/4"),
     (0.0, False, ""), (3.125, False, "3 1/8"), (12.0, False, "12"), (36.25, True, "3'-0 1/4"), (23.999, True, "2'-0"), (11.999, True, "1'-0")],
)
def test_inches_text(spark, x, feet, want):
    assert one(spark, X.inches_text(F.col("x"), feet=feet), "x double", (x,)) == want


def test_derive_mark(spark):
    df = spark.createDataFrame(
        [(None, "1230039B-X5K", "1230039B"), (None, "1230039B-X5K", None), ("M1", "1230039B-X5K", "1230039B")],
        "mark string, part string, job string",
    )
    got = [r.v for r in df.select(X.derive_mark(F.col("mark"), F.col("part"), F.col("job")).alias("v")).collect()]
    assert got == ["X5K", "1230039BX5K", "M1"]


def test_trans_id_and_template(spark):
    assert one(spark, X.trans_id(F.col("e")), "e string", ("00000000001234567890",)) == "1234567890"
    assert one(spark, X.fill_template(F.col("t"), F.lit("R008")), "t string", ("/dxf/<sheet_name>.dxf",)) == (
        "/dxf/R008.dxf"
    )


def test_main_member_and_part_text(spark):
    df = spark.createDataFrame([("1230039B-G12A-A1",), ("1230039B-X5K",)], "p string")
    got = df.select(
        X.is_main_member(F.col("p")).alias("m"), X.job_of(F.col("p")).alias("j"),
        X.first_dash_to_underscore(F.col("p")).alias("u"),
    ).collect()
    assert [(r.m, r.j, r.u) for r in got] == [
        (True, "1230039B", "1230039B_G12A-A1"), (False, "1230039B", "1230039B_X5K")
    ]


def test_shipment_int(spark):
    df = spark.createDataFrame([("3",), ("",), (None,), ("x",), (" 4 ",)], "s string")
    assert [r.v for r in df.select(X.shipment_int(F.col("s")).alias("v")).collect()] == [3, 0, 0, None, 4]


def test_state_codes_roundtrip(spark):
    df = spark.createDataFrame([("SN100",), ("SN101",), ("SN102",), ("SN999",)], "c string")
    got = df.select(codes.decode_state(F.col("c")).alias("s")).select(
        "s", codes.encode_state(F.col("s")).alias("c2")
    ).collect()
    assert [(r.s, r.c2) for r in got] == [("created", "SN100"), ("deleted", "SN101"), ("updated", "SN102"),
                                          (None, None)]
    with pytest.raises(Exception):
        df.select(codes.decode_state(F.col("c"), strict=True)).collect()


def test_batch_type_decode_fails_on_unknown(spark):
    ok = spark.createDataFrame([("N",), ("Y",)], "r string").select(codes.batch_type(F.col("r")).alias("t"))
    assert [r.t for r in ok.collect()] == ["New", "Remnant"]
    with pytest.raises(Exception):
        spark.createDataFrame([("Q",)], "r string").select(codes.batch_type(F.col("r"))).collect()


BOM_SCHEMA = "spec string, grade string, test string, remark string"


@pytest.mark.parametrize(
    "row,grade,cvn",
    [
        (("A709", "50", "", ""), "A709-50", "A709-50T2"),
        (("A709", "HPS70W", "T", ""), "A709-HPS70WT3", "A709-HPS70WT3"),
        (("A709", "345W", "FCM", ""), "A709-345WF2", "A709-345WF2"),
        (("A240 Type 304", "x", "", ""), "A240-304", "A240-304"),
        (("A606 TYPE 4", "x", "", ""), "A606-TYPE4", "A606-TYPE4"),
        (("A709", "50", "", "SRM"), "A709-50F2", "A709-50F2"),
        (("A709", "HPS70W", "", ""), "A709-HPS70W", "A709-HPS70WT3"),
    ],
)
def test_matl_grade(spark, row, grade, cvn):
    c = [F.col(n) for n in ("spec", "grade", "test", "remark")]
    df = spark.createDataFrame([row], BOM_SCHEMA)
    r = df.select(B.matl_grade(*c).alias("g"), B.matl_grade_cvn(*c).alias("v")).first()
    assert (r.g, r.v) == (grade, cvn)


def test_cvn_literal_differs_for_raw_spec_and_srm(spark):
    c = [F.col(n) for n in ("spec", "grade", "test", "remark")]
    df = spark.createDataFrame([("A240 Type 304", "x", "", ""), ("A709", "50", "", "SRM")], BOM_SCHEMA)
    got = [r.v for r in df.select(B.matl_grade_cvn(*c, literal=True).alias("v")).collect()]
    # raw spec is not in the exempt list, SRM rows get the double suffix
    assert got == ["A240-304T2", "A709-50F2T2"]


def test_near_stock_thickness(spark):
    df = spark.createDataFrame([(0.2,), (0.25,), (0.1,), (2.5,), (1.9,)], "t double")
    got = [r.v for r in df.select(B.near_stock_thickness(F.col("t")).alias("v")).collect()]
    assert got == [True, True, False, False, True]


def test_for_prenest(spark):
    schema = "type string, thk double, wid double, len double, spec string, grade string, test string, " \
             "remark string, item string"
    data = [
        ("PL", 0.5, 40.0, 100.0, "A709", "50", "", "", "03"),    # stock plate size & thickness -> not prenest
        ("PL", 0.6, 40.0, 100.0, "A709", "50", "", "", "03"),    # odd thickness -> prenest
        ("W", 0.6, 40.0, 100.0, "A709", "50", "", "", "03"),     # a shape -> never
        ("PL", 0.5, 99.0, 100.0, "A709", "50", "", "", "03"),    # too wide -> prenest
        ("PL", 0.4, 40.0, 100.0, "A709", "50", "", "BEV. FILL", "03"),  # milled from 0.5 -> not prenest
        ("PL", 0.5, 40.0, 100.0, "A709", "HPS70W", "T", "", "03"),  # grade not stock -> prenest
        ("PL", 0.5, 40.0, 100.0, "A709", "50", "", "", "07"),    # secondary on a main prenest -> no
    ]
    df = spark.createDataFrame(data, schema)
    cols = [F.col(c) for c in ("type", "thk", "wid", "len", "spec", "grade", "test", "remark", "item")]
    got = [r.v for r in df.select(B.for_prenest(*cols, prenest_type="main", skip_stock=False).alias("v")).collect()]
    assert got == [False, True, False, True, False, True, False]
    allp = [r.v for r in df.select(B.for_prenest(*cols).alias("v")).collect()]
    assert allp == [True, True, False, True, True, True, True]
