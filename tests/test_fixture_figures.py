"""Independent sanity figures for sf0.01 (FIXTURES.md section 6)."""

from truetally.plans.keys import ctx

SF01 = "/root/testdata/sf0.01"


def _counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_sf001_status_and_lineage_counts(spark):
    x = ctx(spark, SF01)
    assert _counts(x.c.fct_po_line, "delivery_status") == {
        "EARLY": 2026, "LATE": 15357, "NOT_YET_DUE": 9628, "ON_TIME": 15122, "OPEN_OVERDUE": 3699}
    src = _counts(x.c.fct_po_line, "arrival_source")
    assert (src["ERP_GR_POSTING"], src["MIXED"], src["IOT_GATE_IN"]) == (8215, 934, 27068)
    s = x.c.fct_shipment
    assert (s.count(), s.filter("source_uom = 'BOX'").count(), s.filter("delivered_ts_utc IS NULL").count()) == (
        49630, 6077, 54)
    assert _counts(x.c.fct_order_line, "line_status")["NOT_SHIPPED"] == 5


def test_sf001_chennai_targets(spark):
    x = ctx(spark, SF01)
    from truetally.plans.scorecard import canonical_scorecard
    v = {r.metric_id: r.value for r in canonical_scorecard(x.c).collect()}
    assert round(v["supplier_otd"], 4) == 0.5204 and round(v["unit_fill_rate"], 4) == 0.6385
    assert round(v["customer_otd"], 4) == 0.3727
