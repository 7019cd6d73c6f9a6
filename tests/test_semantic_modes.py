"""Row-level facts, semi-additive metrics, keys unknown to a dimension, text bounds, goldens as data, audit log, catalogue."""

import datetime as dt
import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from truetally.params import DEFAULT_AS_OF
from truetally.plans.semantic import SemanticError
from truetally.sources import reference_data as ref


@pytest.fixture(scope="module")
def w(spark):
    from truetally.plans.keys import ctx
    return ctx(spark, "/root/testdata/sf0.001")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- facts by row

def test_rows_join_only_what_is_asked_for(w):
    df = w.model.rows(w.c, ["po_days_late"], ["po_number", "plant_id", "part_id"], [("po_days_late", ">", 2)])
    assert "Join" not in plan_of(df) and "landed_cost" not in plan_of(df)
    assert df.columns == ["po_number", "plant_id", "part_id", "po_days_late"]
    assert df.count() == w.c.fct_po_line.where("days_late > 2").count()
    one = w.model.rows(w.c, ["shp_transit_days", "shp_freight_cost_usd"], ["transport_mode", "plant_region", "part_category"])
    assert plan_of(one).count("Join ") + plan_of(one).count("Join\n") <= 3 and one.count() == w.c.fct_shipment.count()


def test_rows_refuse_mixed_tables_and_unreachable_dimensions(w):
    with pytest.raises(SemanticError, match="one table"):
        w.model.rows(w.c, ["po_days_late", "inv_value_usd"])
    with pytest.raises(SemanticError, match="reachable"):
        w.model.rows(w.c, ["inv_value_usd"], ["supplier_name"])
    with pytest.raises(SemanticError, match="unknown fact"):
        w.model.rows(w.c, ["supplier_otd"])


def test_every_fact_is_a_column_and_every_metric_is_made_of_facts(w):
    columns = {(f.entity, f.column) for f in w.model.facts}
    for f in w.model.facts:
        assert f.column in getattr(w.c, w.model.entity(f.entity).table).columns
    assert len(columns) == 27
    for m in w.model.metrics:
        assert {(m.entity, c) for c in (m.num, m.den) if c} <= columns


def test_facts_filter_metrics(w):
    got = w.model.query(w.c, ["total_goods_value_usd"], [], [("po_lines.po_days_late", ">", 2)]).first()[0]
    assert got == w.c.fct_po_line.where("days_late > 2").agg(F.sum("goods_value_usd")).first()[0]


# --- semi-additive metrics

def stock(spark, w, rows):
    schema = w.c.fct_inventory.schema
    full = [{"plant_id": p, "part_id": part, "snapshot_date": day, "inventory_value_usd": v, "avg_daily_cogs_usd": 1,
             "is_latest_snapshot": False} for p, part, day, v in rows]
    df = spark.createDataFrame([(r["plant_id"], r["part_id"], r["snapshot_date"], r["inventory_value_usd"], r["avg_daily_cogs_usd"],
                                 False) for r in full],
                               "plant_id string, part_id string, snapshot_date date, inventory_value_usd int, avg_daily_cogs_usd int, "
                               "is_latest_snapshot boolean")
    return replace(w.c, fct_inventory=df.select(*[F.col(c).cast(schema[c].dataType) for c in df.columns]))


def test_stock_counts_at_the_last_snapshot_of_each_group(spark, w):
    d = dt.date
    parts = [r.part_id for r in w.c.dim_part.orderBy("part_id").limit(2).collect()]
    c = stock(spark, w, [("IN01", parts[0], d(1999, 10, 31), 100), ("IN01", parts[0], d(1999, 11, 30), 50), ("IN01", parts[1], d(1999, 11, 30), 7),
                         ("JP01", parts[0], d(1999, 10, 31), 9), ("JP01", parts[0], d(1999, 12, 31), 4), ("JP01", parts[1], d(2000, 1, 31), 3),
                         ("IN01", parts[1], None, 1000)])
    quarter = ("snapshot_date", "range", ("1999-10-01", "2000-01-01"))
    ask = lambda dims, where=(): {tuple(r)[:-1]: r[-1] for r in w.model.query(
        c, ["total_inventory_value_usd"], dims, where, latest_snapshot_default=False).collect()}
    assert ask(["plant_id"], [quarter]) == {("IN01",): 57, ("JP01",): 4}  # each at its own last one
    assert ask([], [quarter]) == {(): 4}  # the group's last snapshot
    assert ask(["plant_id", "snapshot_date.quarter"]) == {("IN01", "1999-Q4"): 57, ("JP01", "1999-Q4"): 4, ("JP01", "2000-Q1"): 3,
                                                          ("IN01", None): None}
    assert ask(["snapshot_date"], [quarter]) == {(d(1999, 10, 31),): 109, (d(1999, 11, 30),): 57, (d(1999, 12, 31),): 4}
    # a group whose last row is another part's: the date decides, not the row
    assert ask(["plant_city"], [quarter]) == {("Chennai",): 57, (w.c.dim_plant.where("plant_id = 'JP01'").first().plant_city,): 4}
    assert ask(["snapshot_date.year"], [("snapshot_date", ">=", d(1999, 1, 1))]) == {(1999,): 4, (2000,): 3}


def test_empty_stock_has_no_value(w):
    c = replace(w.c, fct_inventory=w.c.fct_inventory.where("false"))
    assert w.model.query(c, ["total_inventory_value_usd"], [], [("snapshot_date", ">=", "1999-01-01")]).first()[0] is None


def test_grains_of_dates(w):
    got = w.model.query(w.c, ["ordered_units"], ["commit_date.quarter"]).columns
    assert got == ["commit_date_quarter", "ordered_units"]
    with pytest.raises(SemanticError):
        w.model.dimension("commit_date.week")


# --- unknown keys, text bounds

def test_an_unknown_key_is_a_group_of_its_own_in_labels_and_filters(w):
    c = replace(w.c, fct_po_line=w.c.fct_po_line.withColumn(
        "part_id", F.when(F.col("po_item") == 10, "M_ORPHAN").otherwise(F.col("part_id"))))
    by = {r.part_id: r[1] for r in w.model.query(c, ["total_goods_value_usd"], ["part_id"]).collect()}
    one = w.model.query(c, ["total_goods_value_usd"], ["part_id"], [("part_id", "==", "M_ORPHAN")]).collect()
    assert [(r.part_id, r[1]) for r in one] == [("M_ORPHAN", by["M_ORPHAN"])] and None not in by
    assert one[0][1] == c.fct_po_line.where("part_id = 'M_ORPHAN'").agg(F.sum("goods_value_usd")).first()[0]


@pytest.mark.parametrize("bounds", [("1998-01-01", "1998-07-01"), (dt.date(1998, 1, 1), dt.date(1998, 7, 1)), ("1998-01-01", dt.date(1998, 7, 1)),
                                    (dt.datetime(1998, 1, 1), dt.datetime(1998, 7, 1))])
def test_bounds_may_be_texts(w, bounds):
    df = w.model.query(w.c, ["due_po_lines"], [], [("confirmed_date", "range", bounds)])
    want = w.c.fct_po_line.where("confirmed_date >= date'1998-01-01' and confirmed_date < date'1998-07-01'").agg(F.sum("due_line_flag"))
    assert df.first()[0] == want.first()[0] and "anchor_year" in plan_of(df)


# --- goldens

def test_goldens_follow_the_table(spark, w):
    from truetally.plans.goldens import golden_values
    rows = [(g, m, s, json.dumps(q)) for g, m, s, q in [
        ("A", "supplier_otd", "all plants", {"period": "last_quarter"}), ("B", "total_goods_value_usd", "one tier", {"where": [["supplier_tier", "in", ["1", "Tier 1", "T1"]]]}),
        ("C", "avg_days_late", "late ones", {"where": [["po_days_late", ">", 0], ["plant_city", "==", "Chennai"]]}),
        ("D", "total_inventory_value_usd", "a quarter's end", {"where": [["snapshot_date", "<", "1999-12-01"]]}),
        ("E", "avg_transit_days", "by sea", {"where": [["transport_mode", "!=", "AIR"], ["plant_region", "!=", "x"]]}),
        ("F", "total_inventory_value_usd", "now", {})]]
    df = spark.createDataFrame([*rows, ("G", None, "nothing", None)], "golden_id string, metric_id string, scope string, query string")
    got = {r.golden_id: r for r in golden_values(w.c, df).collect()}
    assert sorted(got) == list("ABCDEF") and got["A"].scope == "all plants"
    for g, m, _, text in rows:
        q = json.loads(text)
        want = w.model.query(w.c, [m], [], [tuple(f) for f in q.get("where", [])], period=q.get("period")).first()[0]
        assert got[g].value == (None if want is None else pytest.approx(float(want), rel=1e-12)), g
    plan = plan_of(golden_values(w.c, df.where("golden_id in ('A', 'B', 'C')")))
    assert plan.count("Scan parquet") == 3  # the fact once, next to suppliers and plants


def test_a_golden_with_an_unknown_part_is_refused(spark, w):
    from truetally.plans.goldens import golden_values
    bad = spark.createDataFrame([("A", "supplier_otd", "s", '{"filter": []}')], "golden_id string, metric_id string, scope string, query string")
    with pytest.raises(SemanticError, match="unknown parts"):
        golden_values(w.c, bad)


def test_golden_answers_have_the_tables_scope(w):
    from truetally.plans.scorecard import canonical_scorecard, golden_answers
    got = {r.metric_id: (r.scope, r.value) for r in golden_answers(w.c).collect()}
    assert {m: s for m, (s, _) in got.items()} == {g[1]: g[2] for g in ref.GOLDENS if g[1]}
    assert {m: v for m, (_, v) in got.items()} == {r.metric_id: r.value for r in canonical_scorecard(w.c).collect()}


# --- audit log

AUDIT = "logged_at timestamp_ntz, persona string, question string, outcome string, test_id long"


def entries(spark, day, n):
    return spark.createDataFrame([(dt.datetime(2020, 1, day, i % 24), "P", f"q{i}", "PASS", i) for i in range(n)], AUDIT)


def test_a_repeated_run_adds_nothing(spark, tmp_path):
    from truetally.plans.audit import AuditLog
    log = AuditLog(spark, str(tmp_path / "audit"))
    assert log.read().count() == 0
    assert log.append(entries(spark, 1, 30), "monday") and not log.append(entries(spark, 1, 30), "monday")
    assert log.append(entries(spark, 2, 5), "tuesday / odd id") and AuditLog(spark, log.root).read().count() == 35
    day = log.read().where(F.col("day") == dt.date(2020, 1, 2))
    assert day.count() == 5 and "PartitionFilters: [isnotnull(day" in plan_of(day)
    assert log.append(spark.createDataFrame([(None, "P", "q", "PASS", 1)], AUDIT), "no time") and log.read().where("day is null").count() == 1


def test_a_run_lost_before_its_commit_is_not_read_and_can_be_repeated(spark, tmp_path, monkeypatch):
    from truetally.plans import audit
    log = audit.AuditLog(spark, str(tmp_path / "audit"))
    with monkeypatch.context() as m:
        m.setattr(audit, "put_if_absent", lambda *a: (_ for _ in ()).throw(OSError("lost driver")))
        with pytest.raises(OSError):
            log.append(entries(spark, 1, 30), "monday")
    assert log.read().count() == 0
    assert log.append(entries(spark, 1, 30), "monday") and log.read().count() == 30
    # another writer of the same run commits between the look-up and the commit
    with monkeypatch.context() as m:
        m.setattr(audit, "committed", lambda *a: [])
        assert not log.append(entries(spark, 1, 30), "monday")
    assert log.read().count() == 30


# --- catalogue

def test_catalogue_applies_every_policy(w):
    from truetally.plans.entitlement import Catalogue, RawAccessRefused
    cat = lambda role: Catalogue(w.c, w.raw, w.scope, role)
    view = cat("SC_LOGISTICS").view()
    allowed = {r.plant_id for r in w.scope.where("role_name = 'SC_LOGISTICS'").collect()}
    for fact in ("fct_po_line", "fct_order_line", "fct_shipment", "fct_inventory"):
        assert {r.plant_id for r in getattr(view, fact).select("plant_id").distinct().collect()} <= allowed
    assert view.fct_po_line.where("unit_price_usd is not null").isEmpty() and not view.fct_po_line.where("landed_cost_usd is not null").isEmpty()
    assert view.dim_part.count() == w.c.dim_part.count()
    for name, _ in w.raw.items():
        with pytest.raises(RawAccessRefused):
            cat("SC_LOGISTICS").table(name)
        assert cat(ref.STEWARD_ROLE).table(name) is not None
    assert cat("SC_NOBODY").table("fct_po_line").isEmpty()
    with pytest.raises(KeyError):
        cat(ref.STEWARD_ROLE).table("nothing")


def test_e04_fails_when_the_catalogue_is_broken(w, monkeypatch):
    from truetally.plans import entitlement
    monkeypatch.setattr(entitlement.Catalogue, "table", lambda self, name: getattr(self.conformed, name, None) if hasattr(self.conformed, name)
                        else getattr(self.raw, name))
    got = {r.test_id: r.status for r in entitlement.entitlement_tests(w.model, w.raw, w.c, w.scope, DEFAULT_AS_OF).collect()}
    assert got["E04"] == got["E02"] == "FAIL"


# --- glossary

def test_terms_are_found_wherever_they_overlap(spark):
    from truetally.plans.glossary import match_terms
    terms = spark.createDataFrame([("otd", "a", "1"), ("on time", "b", "2"), ("on time delivery", "c", "3"), ("time delivery rate", "d", "4"), ("otd", "e", "5")],
                                  "term string, kind string, target string")
    texts = spark.createDataFrame([(1, "On-time delivery rate, OTD and otd!"), (2, "on"), (3, None), (4, "on time"), (5, "x " * 50_000 + "on time delivery")],
                                  "i int, t string")
    got = {(r.i, r.term, r.kind): r.hits for r in match_terms(texts, ["i"], "t", terms).collect()}
    assert got == {(1, "otd", "a"): 2, (1, "otd", "e"): 2, (1, "on time", "b"): 1, (1, "on time delivery", "c"): 1, (1, "time delivery rate", "d"): 1,
                   (4, "on time", "b"): 1, (5, "on time", "b"): 1, (5, "on time delivery", "c"): 1}
    assert match_terms(texts, ["i"], "t", terms.limit(0)).collect() == []


# --- comments

def test_comments_are_read_back_from_the_written_files(spark, w, tmp_path):
    from truetally.plans.conform import COMMENTS, comments
    from truetally.plans.governance import GovernanceStore
    for table, texts in COMMENTS.items():
        df = getattr(w.c, table)
        assert set(texts) <= set(df.columns) and comments(df) == texts
        files = spark.read.parquet(df.inputFiles()[0])  # the schema that the file itself has
        assert comments(files) == {c: t for c, t in texts.items() if c in files.columns}
    assert comments(w.c.fct_po_line.where("is_due").select("is_due", "po_number")) == {"is_due": COMMENTS["fct_po_line"]["is_due"]}
    store = GovernanceStore(spark, str(tmp_path / "state"))
    store.create(w.c)
    assert comments(store.load(w.c).conformed.fct_po_line) == COMMENTS["fct_po_line"]
