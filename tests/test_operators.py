"""Generic operators on ~10-row frames, NULLs in every nullable key."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from platehub.operators import changelog as cl
from platehub.operators.dedup import first_per_key, last_per_key, survivors_after_later_writes
from platehub.operators.documents import attach_children, child_arrays, child_summary
from platehub.operators.joins import bounded_broadcast, not_exists, not_in
from platehub.operators.quality import mask_sentinel, resolve_aliases, split_required, with_defaults

from conftest import rows


def test_not_in_three_valued(spark):
    left = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    empty = spark.createDataFrame([], "t string")
    with_null = spark.createDataFrame([("a",), (None,)], "t string")
    plain = spark.createDataFrame([("a",), ("c",)], "t string")
    assert rows(not_in(left, "k", empty, "t")) == rows(left)
    assert not_in(left, "k", with_null, "t").count() == 0
    assert rows(not_in(left, "k", plain, "t")) == [("b",)]


def test_not_exists_keeps_null_keys(spark):
    left = spark.createDataFrame([("p", 1), ("p", 2), ("q", None)], "n string, r int")
    right = spark.createDataFrame([("p", 1), ("q", None)], "n string, r int")
    got = rows(not_exists(left, right, [("n", "n"), ("r", "r")]))
    assert got == [("p", 2), ("q", None)]


def test_bounded_broadcast_respects_bound(spark):
    small = spark.range(5)
    big = spark.range(50)
    assert "broadcast" in small.join(bounded_broadcast(small, 10), "id")._jdf.queryExecution().analyzed().toString().lower()
    plan = big.join(bounded_broadcast(big, 10), "id")._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" not in plan


def test_first_last_per_key(spark):
    df = spark.createDataFrame([("a", 3, "x"), ("a", 1, "y"), ("b", 2, "z"), ("a", 2, "w")], "k string, s int, v string")
    assert rows(first_per_key(df, ["k"], ["s"]), ["k", "s", "v"]) == [("a", 1, "y"), ("b", 2, "z")]
    assert rows(last_per_key(df, ["k"], ["s"]), ["k", "s", "v"]) == [("a", 3, "x"), ("b", 2, "z")]


def test_survivors_last_write_wins(spark):
    q = spark.createDataFrame(
        [("k1", None, "old"), ("k1", 4, "add1"), ("k1", 9, "add2"), ("k2", 2, "rem"), (None, 1, "nullkey"),
         ("k1", 10, "removal-after")],
        "key string, Ordinal long, tag string",
    )
    adds = q.where(F.col("tag").startswith("add"))
    got = rows(survivors_after_later_writes(q, adds, ["key"], "Ordinal"), ["tag"])
    assert got == [("add2",), ("nullkey",), ("rem",), ("removal-after",)]


def test_purge_partition_is_complete(spark):
    df = spark.createDataFrame([(1, "SN100"), (2, "SN101"), (3, "SN102"), (4, None)], "id int, t string")
    kept = cl.purge_keep(df, "t", ("SN100", "SN101"))
    gone = cl.purged(df, "t", ("SN100", "SN101"))
    assert rows(kept, ["id"]) == [(1,), (2,), (4,)]
    assert sorted(rows(kept) + rows(gone)) == sorted(rows(df))


def test_ack_removes_ids(spark):
    outbox = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "AutoID int, v string")
    acks = spark.createDataFrame([(2,), (None,)], "AutoID int")
    assert rows(cl.ack(outbox, acks), ["AutoID"]) == [(1,), (3,)]


def test_snapshot_diff_roundtrip(spark):
    old = spark.createDataFrame([("a", 1, None), ("b", 2, "x"), ("c", 3, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("a", 1, None), ("b", 5, "x"), ("d", 4, "z")], "k string, v int, w string")
    diff = cl.snapshot_diff(old, new, ["k"])
    assert rows(diff, ["k", "status"]) == [("a", "same"), ("b", "change"), ("c", "delete"), ("d", "add")]
    assert rows(cl.apply_diff(old, diff, ["k"])) == rows(new)


def test_feedback_entry_equality_ignores_payload(spark):
    a = spark.createDataFrame([(1, "created", "p1"), (1, "created", "p2"), (2, "deleted", None)],
                              "ArchivePacketID int, state string, payload string")
    assert cl.dedupe_feedback(a).count() == 2
    b = spark.createDataFrame([(1, "created"), (2, "updated")], "ArchivePacketID int, state string")
    assert rows(cl.match_feedback(a, b), ["ArchivePacketID", "payload"]) == [(1, "p1"), (1, "p2")]


def test_split_required_and_defaults(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), ("c", None)], "n string, q int")
    good, bad = split_required(df, ["n", "q"])
    assert rows(good) == [("a", 1)]
    assert rows(bad, ["missing"]) == [("n",), ("q",)]
    assert rows(with_defaults(df, {"n": "", "q": 0})) == [("", 2), ("a", 1), ("c", 0)]


def test_resolve_aliases(spark):
    df = spark.createDataFrame([(None, 5), (3, 6)], "QtyProgram int, QtyInProcess int")
    by_value = resolve_aliases(df, {"Qty": ("Qty", "QtyProgram", "QtyInProcess")}, by="value")
    by_header = resolve_aliases(df, {"Qty": ("Qty", "QtyProgram", "QtyInProcess")}, by="header")
    assert rows(by_value) == [(3,), (5,)]
    assert rows(by_header) == [(3,), (None,)]
    with pytest.raises(KeyError):
        resolve_aliases(df, {"Area": ("Area",)})


def test_mask_sentinel(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(1900, 1, 1)), (2, dt.datetime(2024, 5, 6, 7, 8, 9))], "id int, d timestamp_ntz"
    )
    assert rows(mask_sentinel(df)) == [(1, "--"), (2, "2024-05-06 07:08:09")]
    assert rows(mask_sentinel(df, as_text=False), ["id"]) == [(1,), (2,)]
    assert mask_sentinel(df, as_text=False).where("d IS NULL").count() == 1


def test_paged_children_keep_every_child(spark):
    kids = spark.createDataFrame([("p", f"c{i}", i) for i in range(25)] + [("q", "c0", 1)], "k string, name string, n int")
    paged = child_arrays(kids, ["k"], ["name", "n"], "items", page_size=4)
    flat = paged.select("k", F.explode("items").alias("i")).select("k", "i.name", "i.n")
    assert rows(flat) == rows(kids)
    assert paged.where("k = 'p'").select("page").distinct().count() > 1
    whole = child_arrays(kids, ["k"], ["name", "n"], "items")
    assert rows(whole.select("k", F.size("items").alias("n")), ["k", "n"]) == [("p", 25), ("q", 1)]
    summ = child_summary(kids.withColumnRenamed("n", "qty"), ["k"], "kids", ["qty"], "name")
    r = {x.k: x for x in summ.collect()}
    assert (r["p"].kids_n, r["p"].kids_qty, r["p"].kids_min_name, r["p"].kids_max_name) == (25, 300.0, "c0", "c9")


def test_row_number_within_splits_hot_keys(spark):
    from pyspark.sql import Window

    from platehub.operators.ranking import row_number_within

    data = [("hot", i * 7 % 1000) for i in range(1000)] + [(f"k{i % 5}", i) for i in range(40)]
    data += [("skew", 10**12 + i) for i in range(300)] + [("skew", None), ("hot", None)] + [(None, i * i) for i in range(200)]  # skewed values, no value, no key
    df = spark.createDataFrame(data, "k string, o long")
    want = rows(df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("o"))))
    got = row_number_within(df, ["k"], "o", max_rows_per_task=50)
    assert rows(got.select("k", "o", "rn")) == want
    assert rows(row_number_within(df, ["k"], "o").select("k", "o", "rn")) == want


def test_rows_without_an_order_value_are_kept_whole(spark):
    df = spark.createDataFrame([("a", None, "x"), ("b", None, "y"), ("b", 1, "z")], "k string, s int, v string")
    assert rows(first_per_key(df, ["k"], ["s"]), ["k", "v"]) == [("a", "x"), ("b", "y")]
    assert rows(last_per_key(df, ["k"], ["s"]), ["k", "v"]) == [("a", "x"), ("b", "z")]


def test_pages_are_exact_and_split_equal_children(spark):
    kids = spark.createDataFrame([("p", "x", i) for i in range(4)] + [("p", "y", 10 + i) for i in range(4)] + [("p", "z", 20)], "k string, name string, id int")
    nine = child_arrays(kids, ["k"], ["name"], "items", page_size=9, child_id=["id"])
    assert rows(nine, ["page"]) == [(0,)] and nine.first()["items"][0]["name"] == "x" and len(nine.first()["items"]) == 9
    same = spark.createDataFrame([("p", "x", i) for i in range(400)], "k string, name string, id int")
    pages = child_arrays(same, ["k"], ["name"], "items", page_size=100, child_id=["id"])
    assert rows(pages, ["page"]) == [(0,), (1,), (2,), (3,)]
    assert pages.agg(F.sum(F.size("items"))).first()[0] == 400


def test_documents_of_a_repeated_outbox_row(spark):
    """A packet that is in the outbox twice doubles no child, and a marker
    stands once however many pages its packet's children fill."""
    from platehub.plans.feedback import feedback_documents

    outbox = spark.createDataFrame([(1, 7, "SN100", "P", 1, "M", 1.0, "S"), (2, 7, "SN100", "P", 1, "M", 1.0, "S"), (3, 7, "SN101", "P", 1, "M", 1.0, "S")],
                                   "AutoID long, ArchivePacketID long, TransType string, ProgramName string, RepeatID long, MachineName string, CuttingTime double, SheetName string")
    stock = spark.createDataFrame([("S", "MM1")], "SheetName string, PrimeCode string")
    pips = spark.createDataFrame([(i, 7, "SN100", "A", "W", 1, 1.0, 2.0) for i in range(5)], "AutoID long, ArchivePacketID long, TransType string, PartName string, WONumber string, QtyInProcess int, TrueArea double, NestedArea double")
    part = spark.createDataFrame([("A", "W", "J", "bad")], "PartName string, WONumber string, Data1 string, Data2 string")
    remnant = spark.createDataFrame([("P", 1, "R", 1.0, 1.0, 1.0)], "ProgramName string, RepeatID long, RemnantName string, Length double, Width double, Area double")
    docs = feedback_documents(outbox, stock, pips, part, remnant, page_size=2)
    assert docs.where("state = 'deleted'").count() == 1
    per = docs.where("nest is not null").groupBy("AutoID").agg(F.sum(F.size("nest.parts")).alias("p"), F.sum(F.size("nest.remnants")).alias("r"))
    assert rows(per, ["AutoID", "p", "r"]) == [(1, 5, 1), (2, 5, 1)]
    assert docs.select(F.explode("nest.parts.shipment")).distinct().collect()[0][0] is None  # no shipment, not 0


def test_stage_completion_with_hot_program(spark):
    from platehub.plans.programs import stage_completion

    program = spark.createDataFrame([("P", r) for r in range(1, 301)] + [("Q", 1)], "ProgramName string, RepeatID int")
    posts = spark.createDataFrame([(i, "P", "b", "Complete") for i in range(120)] + [(500, "Q", "b", "Complete")],
                                  "post_seq long, program string, batch string, state string")
    queue = spark.createDataFrame([("SN70", "P", 2)], "TransType string, ProgramName string, ProgramRepeat int")
    got = stage_completion(posts, program, queue, max_rows_per_task=16)
    reps = sorted(r.ProgramRepeat for r in got.where("ProgramName = 'P'").collect())
    assert reps == [1] + list(range(3, 122))
    assert got.where("ProgramName = 'Q'").count() == 1


def test_assert_required_fails_the_job(spark):
    from platehub.operators.quality import assert_required

    ok = spark.createDataFrame([("a", 1)], "n string, q int")
    assert assert_required(ok, ["n", "q"]).count() == 1
    bad = spark.createDataFrame([("a", None)], "n string, q int")
    with pytest.raises(Exception):
        assert_required(bad, ["n", "q"]).collect()


def test_attached_children_by_pages(spark):
    heads = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "k int, h string")
    some = spark.createDataFrame([(1, i) for i in range(9)] + [(2, 20), (None, 30), (4, 40)], "k int, x int")
    few = spark.createDataFrame([(1, 7), (3, 8), (3, 9)], "k int, y int")
    docs = attach_children(heads, ["k"], [(some, ["x"], "xs", ["x"]), (few, ["y"], "ys", ["y"])], page_size=2).collect()
    assert {(r.h, x.x) for r in docs for x in r.xs} == {(h, i) for h in "ab" for i in range(9)} | {("c", 20)}
    assert sum(len(r.xs) for r in docs) == 19
    assert sorted((r.h, y.y) for r in docs for y in r.ys) == [("a", 7), ("b", 7), ("d", 8), ("d", 9)]
    assert {(r.h, r.page, len(r.xs), len(r.ys)) for r in docs if r.h in "cde"} == {("c", 0, 1, 0), ("d", 0, 0, 2), ("e", 0, 0, 0)}
    assert all(r.xs or r.ys for r in docs if r.h in "ab") and len({(r.h, r.page) for r in docs}) == len(docs)
    whole = attach_children(heads, ["k"], [(some, ["x"], "xs", ["x"])], page_size=None).collect()
    assert sorted((r.h, r.page, len(r.xs)) for r in whole) == [("a", 0, 9), ("b", 0, 9), ("c", 0, 1), ("d", 0, 0), ("e", 0, 0)]
