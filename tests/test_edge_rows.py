"""Hand-made edge rows (FIXTURES.md section 4) with literal expectations."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from truetally.functions.calendar import fiscal_quarter_label, quarter_bounds, quarter_label
from truetally.functions.rules import classify_window, order_line_rules
from truetally.functions.units import hours_between, hours_to_days_2dp, to_base_uom, utc_to_local
from truetally.operators import first_reach_date, fx_convert, resolve_first, trailing_window_sum
from truetally.operators.windows import trailing_window_sum_join
from truetally.plans import conform

D = dt.date
AS_OF = D(2000, 1, 15)


def test_tolerance_window_edges(spark):
    conf = D(1999, 11, 10)
    rows = [(conf - dt.timedelta(3),), (conf - dt.timedelta(4),), (conf + dt.timedelta(2),),
            (conf + dt.timedelta(3),), (None,)]
    df = spark.createDataFrame(rows, "full date").withColumn("conf", F.lit(conf))
    w = classify_window("full", "conf", 3, 2, AS_OF)
    got = [r[0] for r in df.select(w["delivery_status"]).collect()]
    assert got == ["ON_TIME", "EARLY", "ON_TIME", "LATE", "OPEN_OVERDUE"]


def test_due_is_strict(spark):
    df = spark.createDataFrame([(AS_OF - dt.timedelta(2),), (AS_OF - dt.timedelta(3),)], "conf date")
    w = classify_window(F.lit(None).cast("date"), "conf", 3, 2, AS_OF)
    assert [r[0] for r in df.select(w["is_due"]).collect()] == [False, True]
    assert [r[0] for r in df.select(w["delivery_status"]).collect()] == ["NOT_YET_DUE", "OPEN_OVERDUE"]


def test_full_receipt_first_reach(spark):
    ev = spark.createDataFrame([
        ("A", D(2000, 1, 1), Decimal("4")), ("A", D(2000, 1, 9), Decimal("6")),   # second completes
        ("B", D(2000, 1, 2), Decimal("15")),                                       # over-receipt in one doc
        ("C", D(2000, 1, 3), Decimal("2")),                                        # partial only
        ("E", D(2000, 1, 4), Decimal("5")), ("E", D(2000, 1, 4), Decimal("5")),   # same day, two seqs
    ], "k string, d date, q decimal(18,3)")
    tg = spark.createDataFrame([("A", Decimal("10")), ("B", Decimal("10")), ("C", Decimal("10")),
                                ("E", Decimal("10"))], "k string, menge decimal(18,3)")
    got = {r.k: r.full for r in first_reach_date(ev, ["k"], "d", "q", tg, "menge", "full").collect()}
    assert got == {"A": D(2000, 1, 9), "B": D(2000, 1, 2), "C": None, "E": D(2000, 1, 4)}


def test_gate_read_evening_utc_is_next_local_day_in_tokyo(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 5, 20, 15),)], "ts timestamp_ntz")
    r = df.select(F.to_date(utc_to_local("ts", F.lit("Asia/Tokyo"))).alias("d")).first()
    assert r.d == D(2000, 1, 6)


def test_hour_boundaries_and_transit_days(spark):
    df = spark.createDataFrame([(dt.datetime(2000, 1, 1, 2, 45), dt.datetime(2000, 1, 1, 5, 0)),
                                (dt.datetime(2000, 1, 1, 0, 0), dt.datetime(2000, 1, 2, 1, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    r = df.select(hours_between("a", "b").alias("h"), hours_to_days_2dp(hours_between("a", "b")).alias("d")).collect()
    assert [x.h for x in r] == [3, 25]
    assert [x.d for x in r] == [Decimal("0.13"), Decimal("1.04")]


def test_box_to_each(spark):
    df = spark.createDataFrame([(Decimal("2.5"), "BOX", 10), (Decimal("7"), "EA", 10)],
                               "q decimal(18,3), u string, pack int")
    assert [r[0] for r in df.select(to_base_uom("q", "u", "pack")).collect()] == [Decimal("25.000"), Decimal("7.000")]


def test_confirmation_fallback_and_latest_wins(spark):
    conf = spark.createDataFrame([
        ("P1", 10, D(2000, 1, 10), dt.datetime(1999, 12, 1)), ("P1", 10, D(2000, 1, 4), dt.datetime(1999, 11, 30))],
        "po_ref string, line_ref int, confirmed_delivery_date date, confirmed_at timestamp_ntz")
    latest = conform.latest_confirmation(conf).first()
    assert latest.confirmed_delivery_date == D(2000, 1, 10)
    po = spark.createDataFrame([("P1", 10, D(2000, 1, 2)), ("P2", 10, D(2000, 1, 3))],
                               "ebeln string, ebelp int, eindt date")
    j = po.join(conform.latest_confirmation(conf), (F.col("ebeln") == F.col("po_ref")) &
                (F.col("ebelp") == F.col("line_ref")), "left")
    r = {x.ebeln: (x.confirmed_date, x.src) for x in resolve_first(
        j, [("confirmed_delivery_date", "SUPPLIER_PORTAL"), ("eindt", "REQUESTED_DATE_FALLBACK")],
        "confirmed_date", "src").collect()}
    assert r == {"P1": (D(2000, 1, 10), "SUPPLIER_PORTAL"), "P2": (D(2000, 1, 3), "REQUESTED_DATE_FALLBACK")}


def test_missing_fx_month_drops_row(spark):
    rates = spark.createDataFrame([(D(2000, 1, 1), "INR", Decimal("0.012"))],
                                  "month_start date, currency string, usd_per_unit decimal(18,6)")
    df = spark.createDataFrame([("a", "INR", D(2000, 1, 20)), ("b", "INR", D(2000, 2, 1))],
                               "id string, cur string, d date")
    assert [r.id for r in fx_convert(df, rates, "cur", "d").collect()] == ["a"]


def test_unreceived_line_gets_no_freight(spark):
    po = spark.createDataFrame([("P", 10, Decimal("10"), Decimal("1")), ("P", 20, Decimal("10"), Decimal("1"))],
                               "ebeln string, ebelp int, menge decimal(18,3), unit_weight_kg decimal(18,3)")
    fr = spark.createDataFrame([("P", Decimal("100.00"))], "po_ref string, po_freight_usd decimal(38,8)")
    rcv = spark.createDataFrame([("P", 10, Decimal("10"))], "ebeln string, ebelp int, received_qty_ea decimal(18,3)")
    got = {r.ebelp: r.freight_usd for r in conform.freight_allocation(po, fr, rcv).collect()}
    assert got == {10: Decimal("50.00"), 20: Decimal("0.00")}


def test_order_line_rules(spark):
    c = AS_OF - dt.timedelta(5)
    rows = [(AS_OF, 10, 0, 0, 0),           # commit = today -> not yet due
            (c, 10, 10, 10, 0),             # shipped in full, still in transit -> DELIVERED_LATE
            (c, 10, 12, 12, 12),            # over-shipped by commit -> capped
            (c, 10, 0, 0, 0), (c, 10, 5, 5, 5)]
    df = spark.createDataFrame([tuple(Decimal(v) if isinstance(v, int) else v for v in r) for r in rows],
                               "commit date, q decimal(18,3), s decimal(18,3), sbc decimal(18,3), dbc decimal(18,3)")
    r = order_line_rules("commit", "q", "s", "sbc", "dbc", AS_OF)
    got = df.select(r["line_status"].alias("st"), r["due_shipped_by_commit_qty_ea"].alias("cap")).collect()
    assert [g.st for g in got] == ["NOT_YET_DUE", "DELIVERED_LATE", "DELIVERED_ON_TIME", "NOT_SHIPPED",
                                   "SHORT_OR_PARTIAL"]
    assert got[2].cap == Decimal("10.000")


def test_trailing_window_edges_both_forms(spark):
    snap = D(1999, 12, 31)
    ev = spark.createDataFrame([("P", "X", snap - dt.timedelta(90), Decimal("1")),
                                ("P", "X", snap - dt.timedelta(89), Decimal("10")),
                                ("P", "X", snap, Decimal("100")), ("P", "X", snap + dt.timedelta(1), Decimal("1000"))],
                               "plant_id string, part_id string, ship_date date, cogs_usd decimal(18,2)")
    anc = spark.createDataFrame([(snap, "P", "X"), (snap, "P", "Y")], "snapshot_date date, plant_id string, part_id string")
    for fn in (trailing_window_sum, trailing_window_sum_join):
        got = {r.part_id: r.c for r in fn(anc, ev, ["plant_id", "part_id"], "snapshot_date", "ship_date", "cogs_usd",
                                          90, "c").collect()}
        assert got == {"X": Decimal("110.00"), "Y": Decimal("0.00")}, fn.__name__


def test_calendar_labels(spark):
    df = spark.createDataFrame([(D(2026, 2, 1),), (D(2026, 4, 1),), (None,)], "d date")
    got = df.select(quarter_label("d").alias("q"), fiscal_quarter_label("d").alias("f")).collect()
    assert [(g.q, g.f) for g in got] == [("2026-Q1", "FY2025-Q4"), ("2026-Q2", "FY2026-Q1"), (None, None)]
    assert quarter_bounds(D(2000, 1, 15)) == (D(1999, 10, 1), D(2000, 1, 1))
    assert quarter_bounds(D(2000, 4, 1)) == (D(2000, 1, 1), D(2000, 4, 1))
