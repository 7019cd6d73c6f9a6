"""Randomised check of the rule expressions against plain-Python statements
of the same rules (tolerance window, order-line status)."""

import datetime as dt
from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from truetally.functions.rules import classify_window, order_line_rules

AS_OF = dt.date(2000, 1, 15)
BASE = dt.date(1999, 12, 20)


def py_window(actual, promised, early, late):
    due = promised + dt.timedelta(late) < AS_OF
    within = actual is not None and promised - dt.timedelta(early) <= actual <= promised + dt.timedelta(late)
    if not due:
        status = "NOT_YET_DUE"
    elif within:
        status = "ON_TIME"
    elif actual is None:
        status = "OPEN_OVERDUE"
    elif actual < promised - dt.timedelta(early):
        status = "EARLY"
    else:
        status = "LATE"
    return due, status


def py_order(commit, q, s, sbc, dbc):
    due = commit < AS_OF
    if not due:
        return "NOT_YET_DUE", Decimal(0)
    cap = min(sbc, q)
    if dbc >= q:
        return "DELIVERED_ON_TIME", cap
    if s == 0:
        return "NOT_SHIPPED", cap
    if s < q:
        return "SHORT_OR_PARTIAL", cap
    return "DELIVERED_LATE", cap


rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(-40, 40)), st.integers(-40, 40)), min_size=1, max_size=60)


@settings(max_examples=15, deadline=None)
@given(rows, st.integers(0, 10), st.integers(0, 10))
def test_window_matches_python(spark, data, early, late):
    recs = [(None if a is None else BASE + dt.timedelta(a), BASE + dt.timedelta(p)) for a, p in data]
    df = spark.createDataFrame(recs, "a date, p date")
    w = classify_window("a", "p", early, late, AS_OF)
    got = [(r.due, r.st) for r in df.select(w["is_due"].alias("due"), w["delivery_status"].alias("st")).collect()]
    assert got == [py_window(a, p, early, late) for a, p in recs]


qty = st.integers(0, 12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(-30, 30), qty, qty, qty, qty), min_size=1, max_size=60))
def test_order_rules_match_python(spark, data):
    recs = [(BASE + dt.timedelta(c), Decimal(q), Decimal(s), Decimal(min(b, s)), Decimal(min(d, b, s)))
            for c, q, s, b, d in data]
    df = spark.createDataFrame(recs, "c date, q decimal(18,3), s decimal(18,3), b decimal(18,3), d decimal(18,3)")
    r = order_line_rules("c", "q", "s", "b", "d", AS_OF)
    got = [(x.st, x.cap) for x in df.select(r["line_status"].alias("st"),
                                            r["due_shipped_by_commit_qty_ea"].alias("cap")).collect()]
    assert got == [py_order(*rec) for rec in recs]
