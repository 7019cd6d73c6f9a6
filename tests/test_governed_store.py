"""The versioned store of governed changes: commits of several writers, shared files, dates, odd keys."""

import datetime as dt
import os
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from truetally.params import DEFAULT_AS_OF, DOI_WINDOW, EARLY, INSURANCE, LATE
from truetally.plans.conform import public
from truetally.plans.governance import FACTS, GovernanceStore, apply_metric_rules
from truetally.sources import reference_data as ref
from truetally.sources.commits import committed, put_if_absent, read_text


@pytest.fixture(scope="module")
def w(spark):
    from truetally.plans.keys import ctx
    return ctx(spark, "/root/testdata/sf0.001")


def files(root, fact):
    return {os.path.join(d, f) for d, _, names in os.walk(f"{root}/facts/{fact}") for f in names if f.startswith("part-")}


def same(a, b):
    a, b = public(a), public(b)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def change(store, w, name, value, **more):
    return store.change(w.c, name, value, "yearly review", "me", ref.STEWARD_ROLE, **more)


def test_only_one_of_many_writers_takes_a_name(spark, tmp_path):
    path = f"{tmp_path}/manifest/v1.json"
    with ThreadPoolExecutor(12) as pool:
        won = list(pool.map(lambda i: put_if_absent(spark, path, f"text {i}"), range(24)))
    assert sum(won) == 1 and read_text(spark, path) == f"text {won.index(True)}"
    assert committed(spark, f"{tmp_path}/manifest") == ["v1.json"] and committed(spark, f"{tmp_path}/none") == []


@pytest.mark.parametrize("other", [(INSURANCE, "1.0"), (LATE, "4"), (LATE, "3")])
def test_two_writers_between_load_and_commit(spark, w, tmp_path, monkeypatch, other):
    """B commits while A is between load and commit; A comes after it, or is told that nothing is left to change."""
    root = str(tmp_path / "state")
    a, b = GovernanceStore(spark, root), GovernanceStore(spark, root)
    a.create(w.c)
    commit, said = a._commit, []

    def late(manifest):
        if not said:
            said.append(change(b, w, *other)[1]["status"])
        return commit(manifest)

    monkeypatch.setattr(a, "_commit", late)
    state, result = change(a, w, LATE, "3")
    assert said == ["APPLIED"]
    log = [(r[3], r[5], r[6]) for r in state.change_log]
    if other == (LATE, "3"):
        assert result["status"] == "NO_CHANGE" and a.version() == 1 and log == [(LATE, Decimal(2), Decimal(3))]
    else:
        assert result["status"] == "APPLIED" and a.version() == 2 and len(log) == 2
        assert log[1][0] == LATE and log[1][1] == (4 if other[0] == LATE else 2)
    assert sorted(r.param_name for r in a.change_log().collect()) == sorted(x[0] for x in log)
    assert same(state.conformed.fct_po_line, apply_metric_rules(w.c, state.params).fct_po_line)
    # what the beaten try had staged is gone: every write folder is one that a manifest names
    assert len(os.listdir(f"{root}/versions")) == a.version() + 1


def test_a_writer_that_is_always_beaten_is_refused(spark, w, tmp_path, monkeypatch):
    store = GovernanceStore(spark, str(tmp_path / "state"), attempts=2)
    store.create(w.c)
    monkeypatch.setattr(store, "_commit", lambda manifest: False)
    state, result = change(store, w, LATE, 3)
    assert result["status"] == "REFUSED" and store.version() == 0 and state.change_log == ()


def test_a_change_writes_only_what_its_parameter_feeds(spark, w, tmp_path):
    root = str(tmp_path / "state")
    store = GovernanceStore(spark, root)
    store.create(w.c)
    first = {name: files(root, name) for name in FACTS}
    state, _ = change(store, w, LATE, 3)
    after = {name: files(root, name) for name in FACTS}
    assert after["fct_inventory"] == first["fct_inventory"] and after["fct_order_line"] == first["fct_order_line"]
    assert first["fct_po_line"] < after["fct_po_line"]
    # of the PO lines, the directories with a changed line and no other
    want = apply_metric_rules(w.c, state.params).fct_po_line
    moved = {(r.plant_id, r.y) for r in public(want).exceptAll(public(w.c.fct_po_line)).select(
        "plant_id", F.coalesce(F.year("confirmed_date"), F.lit(0)).alias("y")).collect()}
    parts = {tuple(x.split("=", 1)[1] for x in f.split("/")[-3:-1]) for f in after["fct_po_line"] - first["fct_po_line"]}
    assert parts == {(p, str(y)) for p, y in moved} and len(parts) < len({os.path.dirname(f) for f in first["fct_po_line"]})
    assert same(state.conformed.fct_po_line, want) and same(state.conformed.fct_inventory, w.c.fct_inventory)
    state, _ = change(store, w, DOI_WINDOW, 60)
    assert files(root, "fct_po_line") == after["fct_po_line"]
    assert same(state.conformed.fct_inventory, apply_metric_rules(w.c, state.params).fct_inventory)
    # earlier versions' files are still there, untouched
    assert first["fct_inventory"] < files(root, "fct_inventory")


def test_a_later_date_takes_along_the_facts_that_depend_on_it(spark, w, tmp_path):
    root = str(tmp_path / "state")
    store = GovernanceStore(spark, root)
    store.create(w.c)
    later = dt.date(2000, 3, 1)
    state, result = change(store, w, DOI_WINDOW, 120, as_of=later)
    want = apply_metric_rules(w.c, state.params, later)
    assert result["status"] == "APPLIED" and all(same(getattr(state.conformed, f), getattr(want, f)) for f in FACTS)


def test_a_change_that_moves_no_line_writes_no_fact(spark, w, tmp_path):
    root = str(tmp_path / "state")
    store = GovernanceStore(spark, root)
    from dataclasses import replace
    none = replace(w.c, fct_po_line=w.c.fct_po_line.where("false"))
    store.create(none)
    state, result = store.change(none, EARLY, 4, "yearly review", None, ref.STEWARD_ROLE)
    assert result["status"] == "APPLIED" and state.conformed.fct_po_line.isEmpty() and files(root, "fct_po_line") == set()


def test_directories_with_odd_names_are_found_again(spark, tmp_path):
    store = GovernanceStore(spark, str(tmp_path / "state"))
    days = [dt.date(2020, 1, 5), None]
    rows = [(p, d, 1) for p in ("a b", "x/y=z", "50%+1", "é*[?]", "0007", None) for d in days]
    df = spark.createDataFrame(rows, "plant_id string, confirmed_date date, n int")
    parts = store._stage("fct_po_line", df, "w1")
    back = store._fact("fct_po_line", {"schema": df.schema.jsonValue(), "parts": parts})
    assert sorted(map(repr, (tuple(r)[:3] for r in back.collect()))) == sorted(map(repr, rows)) and len(parts) == len(rows)


def test_as_of_of_the_build_is_the_first_version(spark, w, tmp_path):
    store = GovernanceStore(spark, str(tmp_path / "state"))
    store.create(w.c, as_of=DEFAULT_AS_OF)
    store.create(w.c)
    assert store.version() == 0
