
import datetime as dt
from decimal import Decimal

from truetally.functions.calendar import month_end_spine, month_spine, with_calendar_labels
from truetally.operators import proportional_allocate, running_total
from truetally.sources.reference_data import table_tags_df

D = dt.date


def test_month_spines(spark):
    m = [r.month_start for r in month_spine(spark, D(1999, 11, 20), D(2000, 2, 3)).collect()]
    assert m == [D(1999, 11, 1), D(1999, 12, 1), D(2000, 1, 1), D(2000, 2, 1)]
    e = [r.snapshot_date for r in month_end_spine(spark, D(2000, 1, 15), 3).collect()]
    assert e == [D(1999, 10, 31), D(1999, 11, 30), D(1999, 12, 31)]


def test_with_calendar_labels(spark):
    df = spark.createDataFrame([(D(1999, 12, 31),)], "d date")
    r = with_calendar_labels(df, "d", "d").first()
    assert (r.d_month, r.d_quarter, r.d_fiscal_quarter) == (D(1999, 12, 1), "1999-Q4", "FY1999-Q3")


def test_running_total(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 7), ("b", 1, 1), ("a", 3, -2)], "k string, o int, v int")
    got = {(r.k, r.o): r.cum for r in running_total(df, ["k"], ["o"], "v", "cum").collect()}
    assert got == {("a", 1): 5, ("a", 2): 12, ("a", 3): 10, ("b", 1): 1}


def test_proportional_allocate(spark):
    lines = spark.createDataFrame([("P", 1, Decimal("1"), True), ("P", 2, Decimal("3"), True),
                                   ("P", 3, Decimal("4"), False), ("Q", 1, Decimal("0"), True)],
                                  "po string, ln int, w decimal(18,3), ok boolean")
    totals = spark.createDataFrame([("P", Decimal("80.00")), ("Q", Decimal("10.00"))], "po string, amt decimal(18,2)")
    got = {(r.po, r.ln): r.share for r in proportional_allocate(lines, totals, "po", "w", "amt", "share", "ok").collect()}
    # weights 1:3:4 of 80; the ineligible line keeps its share unallocated; zero total weight gives 0
    assert got == {("P", 1): Decimal("10.00000000"), ("P", 2): Decimal("30.00000000"),
                   ("P", 3): Decimal("0E-8"), ("Q", 1): Decimal("0E-8")}


def test_table_tags_allowed_values(spark):
    rows = table_tags_df(spark).collect()
    assert len(rows) == 12 and all(r.is_allowed for r in rows)


def test_semantic_describe_rows_name_everything(spark):
    from truetally.plans.semantic import SemanticModel
    names = {r.name for r in SemanticModel().describe(spark).collect()}
    assert {"po_lines.supplier_otd", "inventory.days_of_inventory", "po_to_supplier"} <= names
