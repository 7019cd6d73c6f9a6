"""Stored governed changes, policies broken on purpose, and inputs at the edges."""

import datetime as dt
from dataclasses import replace
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from truetally.params import DOI_WINDOW, LATE, DEFAULT_AS_OF
from truetally.sources import reference_data as ref


@pytest.fixture(scope="module")
def w(spark):
    """Written RAW + conformed frames over the sf0.001 driver tables."""
    from truetally.plans.keys import ctx
    return ctx(spark, "/root/testdata/sf0.001")


def test_a_new_reader_sees_stored_changes_and_plans_stay_short(spark, w, tmp_path):
    from truetally.plans.governance import GovernanceStore
    root = str(tmp_path / "state")
    GovernanceStore(spark, root).create(w.c)
    for value in (3, 4, 2):
        _, r = GovernanceStore(spark, root).change(w.c, LATE, value, "yearly review", "me", ref.STEWARD_ROLE)
        assert r["status"] == "APPLIED"
    state = GovernanceStore(spark, root).load(w.c)
    assert state.params.late_tol == 2 and state.params.row(LATE).version == "1.5"
    assert state.registry_version("supplier_otd") == "1.5"
    assert [(r[5], r[6]) for r in state.change_log] == [(Decimal(2), Decimal(3)), (Decimal(3), Decimal(4)), (Decimal(4), Decimal(2))]
    for name in ("fct_po_line", "fct_inventory"):
        plan = getattr(state.conformed, name)._jdf.queryExecution().executedPlan().toString()
        assert "Window" not in plan and "Join" not in plan
    same = state.conformed.fct_po_line.drop("anchor_year")
    assert same.exceptAll(w.c.fct_po_line.drop("anchor_year")).isEmpty()  # changed back: the build itself


def test_refused_and_broken_changes_leave_no_version(spark, w, tmp_path, monkeypatch):
    from truetally.plans import governance
    store = governance.GovernanceStore(spark, str(tmp_path / "state"))
    store.create(w.c)
    assert store.change(w.c, LATE, 3, "yearly review", "me", "SC_PLANNING")[1]["status"] == "REFUSED"
    monkeypatch.setattr(governance, "write_fact", lambda *a: (_ for _ in ()).throw(OSError("lost disk")))
    with pytest.raises(OSError):
        store.change(w.c, DOI_WINDOW, 60, "yearly review", "me", ref.STEWARD_ROLE)
    assert store.version() == 0 and store.load(w.c).params.doi_window == 90


def statuses(w):
    from truetally.plans.entitlement import entitlement_tests
    return {r.test_id: r.status for r in entitlement_tests(w.model, w.raw, w.c, w.scope, DEFAULT_AS_OF).collect()}


def test_entitlement_tests_fail_when_a_policy_is_broken(w, monkeypatch):
    from truetally.plans import entitlement, semantic
    assert set(statuses(w).values()) == {"PASS"}
    with monkeypatch.context() as m:
        m.setattr(entitlement, "apply_mask", lambda df, role: df)
        assert statuses(w)["E02"] == "FAIL"
    with monkeypatch.context() as m:
        m.setattr(semantic, "apply_row_scope", lambda df, scope, role: df)
        got = statuses(w)
        assert got["E01"] == got["E06"] == "FAIL"
    with monkeypatch.context() as m:
        m.setattr(entitlement, "read_raw", lambda raw, table, role: raw)
        assert statuses(w)["E04"] == "FAIL"


def test_metric_under_role_fails_without_row_scope(w, monkeypatch):
    from truetally.plans import semantic
    from truetally.plans.entitlement import metric_under_role
    read = lambda: {(r.role, r.plant_city): r.status for r in metric_under_role(w.model, w.c, w.scope).collect()}
    before = read()
    monkeypatch.setattr(semantic, "apply_row_scope", lambda df, scope, role: df)
    assert read() != before


def test_guard_takes_literals_of_any_length(spark):
    from truetally.plans.grading import is_read_only
    long_ = "x''" * 50_000
    df = spark.createDataFrame([(f"SELECT '{long_}'",), (f"SELECT '{long_}' ; DROP TABLE t",), ("SELECT 'a''delete''b'",)], "s string")
    assert [r[0] for r in df.select(is_read_only("s")).collect()] == [True, False, True]


def test_summary_holds_large_values(spark):
    from truetally.plans.grading import grading_summary
    rows = [("t1", "ANSWER", "G", "m", "P", "PASS", 2.5e10), ("t2", "ANSWER", "G", "m", "Q", "FAIL", 2.5e10 + 1)]
    df = spark.createDataFrame(rows, "test_id string, expected_behavior string, golden_id string, metric_id string, "
                                     "persona string, status string, returned_value double")
    assert grading_summary(df)[1].first()["distinct_values"] == 2


def test_numeric_plant_codes_stay_text(spark, tmp_path):
    from truetally.plans.conform import write_fact
    df = spark.createDataFrame([("0001", dt.date(2020, 1, 5), 1), ("0002", None, 2)], "plant_id string, day date, n int")
    back = write_fact(df, str(tmp_path / "f"), "day")
    assert sorted((r.plant_id, r.day, r.n) for r in back.collect()) == [("0001", dt.date(2020, 1, 5), 1), ("0002", None, 2)]


def test_period_query_prunes_directories_and_plants(w):
    df = w.model.query(w.c, ["supplier_otd"], [], [("plant_id", "==", "IN01")], period="last_quarter", as_of=DEFAULT_AS_OF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(plant_id" in plan and "anchor_year" in plan.split("PartitionFilters", 1)[1].split("]")[0]
    assert "Join" not in plan


def test_multi_fact_query_keeps_one_null_group(w):
    c = replace(w.c, fct_po_line=w.c.fct_po_line.withColumn("part_id", F.lit(None).cast("string")),
                fct_order_line=w.c.fct_order_line.withColumn("part_id", F.lit(None).cast("string")))
    rows = w.model.query(c, ["total_goods_value_usd", "ordered_units"], ["commodity"]).collect()
    assert len(rows) == 1 and rows[0].commodity is None and None not in rows[0][1:]


def test_longest_glossary_term_is_found(spark):
    from truetally.plans import glossary
    terms = glossary.glossary_terms_df(spark)
    texts = spark.createDataFrame([(1, "What was the landed cost per unit USD at Chennai"), (2, None), (3, "")], "i int, t string")
    found = {r.target for r in glossary.match_terms(texts, ["i"], "t", terms).where("kind = 'metric'").collect()}
    assert "landed_cost_per_unit_usd" in found


def test_rates_cover_every_date(spark):
    from truetally.sources.driver import fx_rates
    days = spark.createDataFrame([(dt.date(1951, 3, 9),), (dt.date(2031, 7, 1),), (None,)], "day date")
    months = fx_rates(spark, days, DEFAULT_AS_OF).agg(F.min("month_start"), F.max("month_start")).first()
    assert months[0] <= dt.date(1951, 1, 1) and months[1] >= dt.date(2031, 12, 1)
    assert fx_rates(spark, days.limit(0), DEFAULT_AS_OF).count() > 0


def test_fingerprint_follows_the_input_files(spark, tmp_path):
    from truetally.plans.keys import SOURCE_TABLES, input_state
    for t in SOURCE_TABLES:
        spark.range(3).write.parquet(f"{tmp_path}/{t}.parquet")
    first = input_state(spark, str(tmp_path))
    assert first == input_state(spark, str(tmp_path))
    spark.range(1).write.mode("append").parquet(f"{tmp_path}/{SOURCE_TABLES[0]}.parquet")
    assert first != input_state(spark, str(tmp_path))


def test_a_line_with_most_legs_meets_the_join_as_one_row_per_days(spark):
    from truetally.plans.conform import order_line_fill
    so = spark.createDataFrame([("10", 10, dt.date(2020, 1, 10)), ("11", 10, dt.date(2020, 1, 10))], "vbeln string, posnr int, edatu date")
    legs = spark.range(3000).select(
        F.when(F.col("id") < 1000, "11-000010").otherwise("10-000010").alias("order_line_id"), F.lit(1).cast("decimal(18,3)").alias("shipped_qty_ea"),
        F.lit(dt.date(2020, 1, 9)).alias("ship_date"), F.lit(dt.date(2020, 1, 11)).alias("delivery_date"),
        F.concat(F.lit("C"), F.col("id")).alias("carrier_id"), F.lit("2020-01-09").cast("timestamp_ntz").alias("ship_ts_local"),
        F.format_string("%05d", "id").alias("shipment_id"))
    got = {r.order_line_id: tuple(r)[1:] for r in order_line_fill(so, legs).collect()}
    assert got == {"10-000010": (2000, 2000, 0, "C1000"), "11-000010": (1000, 1000, 0, "C0")}


def test_delete_where_keeps_unknown_rows(spark):
    from truetally.sources.tables import delete_where
    df = spark.createDataFrame([(1,), (2,), (None,)], "n int")
    assert sorted(str(r.n) for r in delete_where(df, F.col("n") > 1).collect()) == ["1", "None"]
