"""Registered queries write no build, and the tables of a side share one shuffle of the line items."""

import datetime as dt
import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_mod
from truetally.operators.keys import small_side
from truetally.operators.windows import trailing_window_sum, trailing_window_sum_join
from truetally.plans.conform import arrival_resolution, order_line_fill, order_line_id, public
from truetally.plans.keys import Q, _both, ctx
from truetally.session import checkpoint_dir
from truetally.sources.driver import packed, unpacked

SF001 = "/root/testdata/sf0.001"


def shuffles(spark, df):
    """Shuffles of the plan, without those that Spark reuses and those of one row; no join is broadcast for its size."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"- Exchange (hashpartitioning\(.*), \d+\)", plan)]


def test_a_query_writes_none_of_the_build(spark, tmp_path):
    sf = f"{tmp_path}/sf"
    shutil.copytree(SF001, sf)
    before = set(os.listdir(checkpoint_dir(spark).removeprefix("file:")))
    assert entry_mod.queries()["calendar_labels"](spark, sf).count() > 0
    assert entry_mod.queries()["grading_summary"](spark, sf).count() > 0
    assert set(os.listdir(checkpoint_dir(spark).removeprefix("file:"))) == before


@pytest.mark.parametrize("key, side", [("fct_po_line", "concat(45"), ("arrival_resolution", "concat(45"),
                                       ("freight_allocation", "concat(45"), ("legacy_supplier_otd", "concat(45"),
                                       ("fct_shipment", "concat(10"), ("fct_order_line", "concat(10"),
                                       ("fct_inventory", "concat(10"), ("uom_convert", "concat(10")])
def test_line_items_are_shuffled_once(spark, x, key, side):
    assert sum(side in s for s in shuffles(spark, Q[key](x))) == 1


def test_joins_of_po_lines_need_no_other_shuffle_than_the_gate_reads(spark, x):
    for key in ("fct_po_line", "freight_allocation"):
        big = [s for s in shuffles(spark, Q[key](x)) if "concat(45" in s or "ebeln" in s or "po_ref" in s or "asn_ref" in s]
        assert len(big) == 2, (key, big)


def test_snapshots_are_not_shuffled_after_they_multiply(spark, x):
    assert not [s for s in shuffles(spark, Q["fct_inventory"](x)) if "snapshot_date" in s]


def test_trailing_sum_with_events_around_all_windows(spark):
    d = dt.date
    anchors = spark.createDataFrame([("a", d(2020, 1, 31)), ("a", d(2020, 2, 29)), ("b", d(2020, 1, 31)), (None, d(2020, 2, 29))],
                                    "k string, at date")
    events = spark.createDataFrame([("a", d(2020, 1, 1), 1), ("a", d(2020, 1, 2), 2), ("a", d(2020, 1, 31), 4), ("a", d(2020, 2, 29), 8),
                                    ("a", d(2020, 3, 1), 16), ("b", d(1990, 1, 1), 32), (None, d(2020, 2, 1), 64), ("c", d(2020, 2, 1), 128)],
                                   "k string, day date, v int")
    args = (["k"], "at", "day", "v", 30, "s")
    got = {(r.k, r.at): r.s for r in trailing_window_sum(anchors, events, *args).collect()}
    assert got == {("a", d(2020, 1, 31)): 6, ("a", d(2020, 2, 29)): 12, ("b", d(2020, 1, 31)): 0, (None, d(2020, 2, 29)): 64}
    known = anchors.filter("k is not null")
    assert trailing_window_sum(known, events, *args).exceptAll(trailing_window_sum_join(known, events, *args)).isEmpty()
    assert trailing_window_sum(anchors.limit(0), events, *args).isEmpty()


def test_gate_reads_of_one_receipt_count_once(spark):
    d, ts = dt.date, dt.datetime
    receipts = spark.createDataFrame([("45", 10, 1, d(2020, 1, 9), 5), ("45", 10, 2, d(2020, 1, 9), 6), ("46", 10, 1, d(2020, 1, 9), 7)],
                                     "ebeln string, ebelp int, receipt_seq int, budat date, menge int")
    reads = spark.createDataFrame([("45-10-1", ts(2020, 1, 8), "GATE_IN"), ("45-10-1", ts(2020, 1, 7), "GATE_IN"),
                                   ("45-10-2", ts(2020, 1, 5), "GATE_OUT"), ("46-x-1", ts(2020, 1, 1), "GATE_IN"), (None, ts(2020, 1, 1), "GATE_IN")],
                                  "asn_ref string, event_ts_utc timestamp_ntz, event_type string")
    po = spark.createDataFrame([("45", 10, "UTC", 11), ("46", 10, "UTC", 7)], "ebeln string, ebelp int, time_zone string, menge int")
    got = {(r.ebeln, r.receipt_seq): (r.arrival_date, r.arrival_source) for r in arrival_resolution(receipts, reads, po).collect()}
    assert got == {("45", 1): (d(2020, 1, 7), "IOT_GATE_IN"), ("45", 2): (d(2020, 1, 9), "ERP_GR_POSTING"),
                   ("46", 1): (d(2020, 1, 9), "ERP_GR_POSTING")}


def test_fill_is_the_same_with_the_order_as_a_key(spark):
    so = spark.createDataFrame([("11", 10, dt.date(2020, 1, 10)), ("11", 20, dt.date(2020, 1, 10)), ("12", 10, None),
                                ("11", None, None), ("12", None, None)],
                               "vbeln string, posnr int, edatu date")
    legs = (spark.createDataFrame([("11", 10, 1), ("11", 10, 2), ("12", 10, 4), (None, 10, 8)], "_order_ref string, posnr int, n int")
            .select("_order_ref", order_line_id("_order_ref", "posnr").alias("order_line_id"), F.col("n").cast("decimal(18,3)").alias("shipped_qty_ea"),
                    F.lit(dt.date(2020, 1, 9)).alias("ship_date"), F.lit(dt.date(2020, 1, 11)).alias("delivery_date"),
                    F.lit("C1").alias("carrier_id"), F.lit("2020-01-09").cast("timestamp_ntz").alias("ship_ts_local"), F.col("n").cast("string").alias("shipment_id")))
    keyed, plain = order_line_fill(so, legs), order_line_fill(so, legs.drop("_order_ref"))
    assert keyed.columns == plain.columns and keyed.filter("order_line_id is null").count() == 1  # lines without an id: one row
    assert sorted(map(str, keyed.collect())) == sorted(map(str, plain.collect()))


def test_small_side_beyond_its_bound_is_left_to_spark(spark):
    assert "ResolvedHint" in small_side(spark.range(3), 3)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in small_side(spark.range(4), 3)._jdf.queryExecution().analyzed().toString()


@pytest.mark.parametrize("key", ["canonical_scorecard", "consistency_run", "definition_change_effect", "metrics_multi_fact",
                                 "metrics_multi_fact_unmatched"])
def test_queries_over_both_sides_shuffle_line_items_once(spark, x, key):
    dealt = [s for s in shuffles(spark, Q[key](x)) if "concat(" in s]
    assert len(dealt) == 1 and "concat(45" in dealt[0], dealt


def test_both_sides_have_the_facts_of_each(spark, x):
    both = _both(x)
    for name in ("fct_shipment", "fct_order_line", "fct_po_line", "fct_inventory"):
        one, other = public(getattr(both, name)), public(getattr(x.c, name))
        assert one.schema == other.schema and one.count() == other.count() > 0
        assert one.exceptAll(other).isEmpty(), name


def test_the_price_of_line_items_is_not_shuffled(spark, x):
    for key in ("fct_po_line", "fct_order_line"):
        assert "l_extendedprice" not in Q[key](x)._jdf.queryExecution().executedPlan().toString()


def test_rows_alike_but_for_the_price_and_unknown_orders(spark, tmp_path):
    sf = f"{tmp_path}/sf"
    shutil.copytree(SF001, sf, ignore=shutil.ignore_patterns("lineitem.parquet"))
    os.chmod(sf, 0o755)
    old = spark.read.parquet(f"{SF001}/lineitem.parquet")
    some = old.filter("l_orderkey % 50 = 0")
    odd = some.withColumn("l_extendedprice", F.col("l_extendedprice") + 1).unionByName(
        some.withColumn("l_orderkey", F.lit(None).cast("long")))
    old.unionByName(odd).unionByName(some).write.parquet(f"{sf}/lineitem.parquet")
    x = ctx(spark, sf, materialize=False)
    assert x.raw.goods_receipt.count() > 0 and _both(x).fct_shipment.count() > 0
    for name in ("fct_shipment", "fct_order_line", "fct_po_line"):
        one, other = public(getattr(_both(x), name)), public(getattr(x.c, name))
        assert one.count() == other.count() and one.exceptAll(other).isEmpty(), name


@pytest.mark.parametrize("key", ["fct_po_line", "fct_order_line", "fct_inventory", "duty_lookup"])
def test_line_items_are_packed_for_the_shuffle(spark, x, key):
    plan = Q[key](x)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(concat\((?:45|10)[^\n]*\n([^\n]*)", plan)
    assert dealt and all(" AS plain" in s and " AS word" in s and "AS pk" not in s for s in dealt), dealt


def test_packed_line_items_come_back_as_they_were(spark):
    day, many = "timestamp_ntz'2001-03-04 00:00:00'", 2 ** 62
    rows = [(1, 2, 3, 4, 5.5, day), (None, None, None, None, None, None), (-1, 1, 2 ** 24 - 1, 2 ** 20 - 1, -0.5, day),
            (many, 15, 2 ** 24, 1, 1.0, day), (2, 16, 1, 1, 1.0, day), (3, -1, 1, 1, 1.0, day), (4, 1, -1, 1, 1.0, day),
            (5, 1, 1, 2 ** 20, 1.0, day), (6, 1, -many, many, 1.0, day), (7, 1, 1, 1, 1.0, "timestamp_ntz'2001-03-04 00:00:00.000001'"),
            (8, 1, 1, 1, 1.0, "timestamp_ntz'1969-12-31 00:00:00'"), (9, 1, 1, 1, 1.0, "timestamp_ntz'2059-09-18 00:00:00'"),
            (10, 1, 1, 1, 1.0, "timestamp_ntz'2059-09-19 00:00:00'"), (11, None, 1, 1, 1.0, day), (12, 1, None, 1, 1.0, day),
            (13, 1, 1, None, 1.0, day), (14, 1, 1, 1, None, day), (15, 1, 1, 1, 1.0, None), (16, 0, 0, 0, 0.0, "timestamp_ntz'1970-01-01 00:00:00'")]
    values = ", ".join("(" + ", ".join("null" if v is None else str(v) for v in row) + ")" for row in rows)
    items = spark.sql(f"select cast(a as bigint) ok, cast(b as int) ln, cast(c as bigint) pk, cast(d as bigint) sk, cast(e as double) l_quantity, "
                      f"cast(f as timestamp_ntz) l_shipdate from values {values} as t(a, b, c, d, e, f)")
    for kind in ("timestamp_ntz", "timestamp", "date"):
        some = items.withColumn("l_shipdate", F.col("l_shipdate").cast(kind))
        there = packed(some)
        back = unpacked(there).select(*some.columns)
        assert back.dtypes == some.dtypes and there.count() == len(rows)
        assert sorted(map(str, back.collect())) == sorted(map(str, some.collect())), kind
        plain = {r.ok for r in there.filter("plain is not null").collect()}
        assert plain == {None, many, 2, 3, 4, 5, 6, 8, 10, 11, 12, 13, 15} | ({7} if kind != "date" else set())
        assert there.filter("(word is null) = (plain is null)").isEmpty()
