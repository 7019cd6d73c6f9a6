"""Parts too many to be sent to every task: looked up for the orders, with the lines left where they are."""

import os
import re
import shutil

import pytest
from pyspark.sql import functions as F

from truetally.operators.keys import looked_up, with_looked_up
from truetally.params import Params
from truetally.plans import conform, entitlement, keys
from truetally.plans.conform import public
from truetally.plans.keys import AS_OF
from truetally.sources import driver

SF001 = "/root/testdata/sf0.001"


def layers(spark, sf, one_shuffle=False):
    raw = driver.raw_sources(spark, sf, AS_OF, one_shuffle=one_shuffle)
    return raw, conform.build(raw, Params(), AS_OF)


@pytest.fixture()
def many(monkeypatch):
    """Part tables count as many, whatever their rows; others as they are."""
    fits, small = driver.fits, conform.small_side
    monkeypatch.setattr(driver, "fits", lambda df, *a: "pk1" not in df.columns and fits(df, *a))
    monkeypatch.setattr(conform, "small_side", lambda df, *a: df if "part_id" in df.columns else small(df, *a))


def plan_of(spark, df):
    """The plan without reused shuffles' repeats; no join is broadcast for its size."""
    kept = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def shuffles(spark, df):
    return [re.sub(r"#\d+L?", "", m) for m in re.findall(r"- Exchange (hashpartitioning\(.*), \d+\)", plan_of(spark, df))]


@pytest.mark.parametrize("one_shuffle", [False, True])
def test_po_lines_go_to_their_parts_and_back_once(spark, many, one_shuffle):
    raw, c = layers(spark, SF001, one_shuffle)
    dealt = shuffles(spark, public(c.fct_po_line))
    # line items; gate reads; pairs and parts of both look-ups; both answers
    assert sum("concat(45" in s for s in dealt) == 1
    assert sum(s.startswith(("hashpartitioning(pk1", "hashpartitioning(matnr")) for s in dealt) == 4, dealt
    assert sum(s.startswith("hashpartitioning(ebeln") for s in dealt) == 2 and sum(s.startswith("hashpartitioning(_order") for s in dealt) == 1, dealt
    assert len([s for s in dealt if "po_ref" in s or "ebelp" in s or "lifnr" in s]) == 0, dealt


@pytest.mark.parametrize("name", ["fct_order_line", "fct_shipment", "fct_inventory"])
def test_sales_lines_stay_where_they_are(spark, many, name):
    raw, c = layers(spark, SF001, True)
    dealt = shuffles(spark, public(getattr(c, name)))
    assert sum("concat(45" in s for s in dealt) <= 2, dealt  # line items, orders
    # lines without an id alone are grouped by it
    dealt = [s for s in dealt if s != "hashpartitioning(order_line_id"]
    assert not [s for s in dealt if "snapshot_date" in s or "order_line" in s or "order_ref" in s or "posnr" in s], dealt


def test_facts_are_the_same_with_parts_unknown_and_repeated(spark, tmp_path, monkeypatch, request):
    sf = f"{tmp_path}/sf"
    shutil.copytree(SF001, sf, ignore=shutil.ignore_patterns("part.parquet", "lineitem.parquet"))
    os.chmod(sf, 0o755)
    part = spark.read.parquet(f"{SF001}/part.parquet")
    again = part.filter("p_partkey % 7 = 1").withColumn("p_retailprice", F.col("p_retailprice") + 1)
    odd = part.filter("p_partkey % 11 = 2").withColumns({"p_retailprice": F.lit(None).cast("double"), "p_size": F.lit(None).cast("int")})
    nokey = part.limit(1).withColumn("p_partkey", F.lit(None).cast("long"))
    part.filter("p_partkey % 5 > 0").unionByName(again).unionByName(odd).unionByName(nokey).write.parquet(f"{sf}/part.parquet")
    items = spark.read.parquet(f"{SF001}/lineitem.parquet").filter("l_orderkey % 3 = 0")
    key = F.when(F.col("l_orderkey") % 4 == 0, None).otherwise(F.col("l_partkey"))
    items.unionByName(items.withColumn("l_partkey", key)).unionByName(items.filter("l_orderkey % 9 = 0").withColumn("l_linenumber", F.lit(None).cast("int"))) \
        .unionByName(items.filter("l_orderkey % 2 = 0").withColumn("l_orderkey", F.lit(None).cast("long"))).write.parquet(f"{sf}/lineitem.parquet")
    few = layers(spark, sf)
    request.getfixturevalue("many")
    for one_shuffle in (False, True):
        raw, c = layers(spark, sf, one_shuffle)
        assert "_order" in raw.po_item.columns and "_order" in raw.so_item.columns
        for name in ("fct_po_line", "fct_shipment", "fct_order_line", "fct_inventory"):
            one, other = (public(getattr(f, name)).cache() for f in (few[1], c))
            assert one.schema == other.schema and one.count() == other.count() > 0, name
            if name == "fct_order_line":  # lines without an id are one group, which shows any one of them
                one, other = (f.filter("order_line_id is not null") for f in (one, other))
            assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), name
        for name in ("po_confirmation", "inbound_freight", "goods_receipt"):
            one, other = getattr(few[0], name), getattr(raw, name)
            assert one.exceptAll(other).isEmpty() and other.exceptAll(one).isEmpty(), name


def test_looked_up_equals_the_join(spark):
    rows = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("a", "y", 3), ("b", "x", 4), ("b", None, 5), ("b", "z", 6), ("b", "w", 7)],
                                 "dealt string, k string, n int")
    master = spark.createDataFrame([("x", 1, None), ("x", 2, "q"), ("w", None, None), (None, 3, "r"), ("v", 4, "s")], "k string, m int, o string")
    got = with_looked_up(rows, looked_up(rows, master, "k", "dealt"), "k", "dealt", ["m", "o"])
    want = rows.join(master, "k").select("dealt", "k", "n", "m", "o")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("key", ["gap_waterfall", "waterfall_check", "before_after"])
def test_legacy_queries_shuffle_line_items_once(spark, x, key):
    dealt = [s for s in shuffles(spark, keys.Q[key](x)) if "concat(" in s]
    assert len(dealt) == 1 and "concat(45" in dealt[0], dealt


def test_entitlement_tests_derive_the_po_lines_once(spark, x, monkeypatch):
    read = []
    kept = entitlement.entitlement_tests
    monkeypatch.setattr(entitlement, "entitlement_tests", lambda m, r, c, *a: read.append(c.fct_po_line) or kept(m, r, c, *a))
    got = keys.Q["entitlement_tests"](x)
    assert len(read) == 2 and {r.status for r in got.collect()} == {"PASS"}
    for po in read:
        assert not shuffles(spark, po) and po.count() == x.c.fct_po_line.count()
    whole = kept(x.model, x.raw, x.c, x.scope, AS_OF)
    assert sorted((r.test_id, r.observed, r.status) for r in got.collect()) == sorted((r.test_id, r.observed, r.status) for r in whole.collect())
