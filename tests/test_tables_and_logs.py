"""Typed tables, schema evolution, appends, audit rows, pivots."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from truetally.params import Params, params_wide
from truetally.plans.grading import audit_rows, grade_behaviour, question_log
from truetally.plans.scorecard import canonical_scorecard, scorecard_map
from truetally.session import checkpoint_dir
from truetally.sources.schemas import AUDIT_SCHEMA, ENTITLEMENT_RESULT_SCHEMA
from truetally.sources.tables import append, empty_table, ensure_columns, with_defaults

SF001 = "/root/testdata/sf0.001"


def test_empty_table_and_schema_evolution(spark):
    e = empty_table(spark, ENTITLEMENT_RESULT_SCHEMA)
    assert e.count() == 0 and e.schema == ENTITLEMENT_RESULT_SCHEMA
    df = spark.createDataFrame([("E01", "PASS")], "test_id string, status string")
    out = ensure_columns(df, ENTITLEMENT_RESULT_SCHEMA)
    assert out.columns == [f.name for f in ENTITLEMENT_RESULT_SCHEMA.fields]
    r = out.first()
    assert r.test_id == "E01" and r.status == "PASS" and r.run_ts is None


def test_defaults_and_append(spark):
    path = f"{checkpoint_dir(spark).rstrip('/')}/tt-test-{os.getpid()}-{tempfile.mktemp(dir='').strip('/')}"
    rows = spark.createDataFrame([("PLANNING", "q1", None)], "persona string, question string, app_user string")
    rows = with_defaults(rows, {"app_user": F.lit("tester"), "logged_at": F.lit(dt.datetime(2000, 1, 1))})
    append(rows, path, AUDIT_SCHEMA)
    append(rows, path, AUDIT_SCHEMA)
    back = spark.read.parquet(path)
    assert back.count() == 2 and back.first().app_user == "tester"


def test_audit_rows_from_events(spark):
    ev = spark.read.parquet(f"{SF001}/events.parquet")
    a = audit_rows(grade_behaviour(question_log(ev)), "tester")
    assert a.columns == [f.name for f in AUDIT_SCHEMA.fields]
    assert a.count() == ev.count() and a.filter(F.col("app_user") != "tester").count() == 0


def test_params_wide_pivot(spark):
    w = params_wide(Params().to_df(spark)).first()
    assert (w.early_tol, w.late_tol, w.doi_window, w.insurance_pct) == (
        Decimal("3.0000"), Decimal("2.0000"), Decimal("90.0000"), Decimal("0.5000"))


def test_scorecard_map(x):
    m = scorecard_map(canonical_scorecard(x.c)).first()["scorecard"]
    assert set(m) == {"supplier_otd", "customer_otd", "unit_fill_rate", "days_of_inventory",
                      "total_landed_cost_usd"}
