"""RAW -> CONFORMED: crosswalk, dimensions and the four facts.

Every rule (units, time zones, FX, tolerance window, due-ness, landed cost,
trailing COGS) is applied here once. All functions return lazy DataFrames;
:func:`build` wires them and :func:`build_materialized` writes them once
(parquet) so metric queries read facts instead of recomputing them.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from truetally.functions.calendar import fiscal_quarter_label, quarter_label
from truetally.functions.rules import classify_window, landed_cost_parts, order_line_rules
from truetally.functions.units import (hours_between, hours_to_days_2dp, local_to_utc, round_div_4dp, to_base_uom,
                                       utc_to_local)
from truetally.operators.allocate import proportional_allocate
from truetally.operators.keys import arg_latest, looked_up, small_side, with_looked_up
from truetally.operators.resolve import fx_convert, resolve_first
from truetally.operators.windows import trailing_window_sum
from truetally.params import DEFAULT_AS_OF, Params
from truetally.sources.driver import RawSources

D3, D2, D4 = "decimal(18,3)", "decimal(18,2)", "decimal(18,4)"


# --------------------------------------------------------------- master data
def supplier_id_of(lifnr) -> F.Column:
    return F.concat(F.lit("SUP-"), F.substring(lifnr, 3, 1 << 20))


def build_crosswalk(vendor: DataFrame, portal: DataFrame) -> DataFrame:
    """Every source identifier -> one golden supplier_id via the PRIMARY record
    sharing its tax id (ERP duplicates by self join; portal ids by tax id)."""
    pr = vendor.filter(F.col("ktokk") == "PRIMARY").select(F.col("stcd1").alias("_tax"),
                                                            supplier_id_of(F.col("lifnr")).alias("supplier_id"))
    erp = vendor.join(pr, vendor.stcd1 == pr._tax).select(
        F.lit("ERP").alias("source_system"), F.col("lifnr").alias("source_key"), F.col("name1").alias("source_name"),
        "supplier_id",
        F.when(F.col("ktokk") == "PRIMARY", "ERP_PRIMARY_RECORD").otherwise("ERP_DUPLICATE_SAME_TAX_ID")
        .alias("match_rule"))
    prt = portal.join(pr, portal.tax_registration == pr._tax).select(
        F.lit("SUPPLIER_PORTAL").alias("source_system"), F.col("portal_vendor_id").alias("source_key"),
        F.col("vendor_display_name").alias("source_name"), "supplier_id", F.lit("TAX_ID_MATCH").alias("match_rule"))
    return erp.unionByName(prt)


def build_dim_supplier(vendor: DataFrame, xref: DataFrame) -> DataFrame:
    counts = xref.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("_cnt"))
    v = vendor.filter(F.col("ktokk") == "PRIMARY").select(
        supplier_id_of(F.col("lifnr")).alias("supplier_id"), F.col("name1").alias("supplier_name"),
        F.col("land1").alias("supplier_country"), F.col("zz_tier").alias("supplier_tier"),
        F.col("stcd1").alias("tax_id"))
    return (v.join(counts, "supplier_id", "left")
            .withColumn("source_record_count", F.coalesce("_cnt", F.lit(0)).cast("int")).drop("_cnt"))


def multi_source(xref: DataFrame, min_ids: int = 3) -> DataFrame:
    """Crosswalk rows of suppliers with at least ``min_ids`` source ids (IN-subquery with HAVING -> semi join)."""
    hot = xref.groupBy("supplier_id").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_ids)
    return xref.join(hot.select("supplier_id"), "supplier_id", "left_semi")


def dim_part(raw: RawSources) -> DataFrame:
    m = raw.material
    return m.select(F.col("matnr").alias("part_id"), F.col("maktx").alias("part_name"),
                    F.col("zz_commodity").alias("commodity"), F.col("zz_category").alias("part_category"),
                    F.col("stprs_usd").alias("std_cost_usd"), F.col("brgew_kg").alias("unit_weight_kg"),
                    "pack_qty", F.col("meins").alias("base_uom"))


def dim_plant(raw: RawSources) -> DataFrame:
    p = raw.plant
    return p.select(F.col("werks").alias("plant_id"), "plant_name", F.col("city").alias("plant_city"),
                    F.col("country_code").alias("plant_country"), F.col("region").alias("plant_region"),
                    "time_zone", "local_currency", "handling_usd_per_kg")


def dim_customer(raw: RawSources) -> DataFrame:
    c = raw.customer
    return c.select(F.col("kunnr").alias("customer_id"), F.col("name1").alias("customer_name"),
                    F.col("land1").alias("customer_country"), F.col("kdgrp").alias("customer_segment"))


def dim_carrier(raw: RawSources) -> DataFrame:
    return raw.carrier.select(F.col("carrier_code").alias("carrier_id"), "carrier_name", "transport_mode")


# --------------------------------------------------------------- shipments
def order_line_id(vbeln, posnr) -> F.Column:
    return F.concat(F.col(vbeln), F.lit("-"), F.lpad(F.col(posnr).cast("string"), 6, "0"))


def dealt_by(sales: DataFrame, number: str) -> F.Column:
    """The number by which a sales table's rows are dealt: the one that they carry for it, else the order's own."""
    return F.col("_dealt" if "_dealt" in sales.columns else number)


def with_parts(lines: DataFrame, item: DataFrame, parts: DataFrame, columns: list[str]) -> DataFrame:
    """``lines`` of the RAW table ``item`` with ``columns`` of their part ``matnr``.

    Where ``item`` carries ``_order``, parts are too many to be sent to every task: they are looked up for its orders
    once for all that read the lines, which stay where they are."""
    parts = parts.select(F.col("part_id").alias("matnr"), *columns)
    if "_order" not in item.columns:
        return lines.join(parts, "matnr")
    return with_looked_up(lines, looked_up(item, parts, "matnr", "_order"), "matnr", "_order", columns)


def build_shipments(raw: RawSources, parts: DataFrame, plants: DataFrame) -> DataFrame:
    """FCT_SHIPMENT: legs in EA, zones normalised, freight in USD at the ship month's rate."""
    so = with_parts(raw.so_item, raw.so_item, parts, ["pack_qty", "std_cost_usd"])
    so = so.select("vbeln", "posnr", "kunnr", "matnr", "werks", "pack_qty", "std_cost_usd", dealt_by(so, "vbeln").alias("_so_dealt"))
    legs = raw.shipment.withColumn("_order_ref", dealt_by(raw.shipment, "order_ref"))
    s = legs.join(so, (F.col("_order_ref") == F.col("_so_dealt")) & (F.col("order_ref") == F.col("vbeln"))
                  & (F.col("order_line_ref") == F.col("posnr")))
    s = s.join(plants.select(F.col("plant_id").alias("_pl"), "time_zone"), F.col("werks") == F.col("_pl"))
    s = fx_convert(s, F.broadcast(raw.fx_rate), "freight_currency", F.to_date("ship_ts_local"))  # months x currencies
    ea = to_base_uom("qty_shipped", "qty_uom", "pack_qty")
    ship_utc = local_to_utc("ship_ts_local", "time_zone")
    return s.select(
        "_order_ref", "shipment_id", order_line_id("order_ref", "order_line_ref").alias("order_line_id"),
        F.col("kunnr").alias("customer_id"), F.col("matnr").alias("part_id"), F.col("werks").alias("plant_id"),
        F.col("carrier_code").alias("carrier_id"), ea.alias("shipped_qty_ea"), F.col("qty_uom").alias("source_uom"),
        "ship_ts_local", ship_utc.alias("ship_ts_utc"), F.to_date("ship_ts_local").alias("ship_date"),
        F.trunc(F.to_date("ship_ts_local"), "month").alias("ship_month"), "delivered_ts_utc",
        F.to_date(utc_to_local("delivered_ts_utc", "time_zone")).alias("delivery_date"),
        hours_to_days_2dp(hours_between(ship_utc, F.col("delivered_ts_utc"))).alias("transit_days"),
        "gross_weight_kg",
        F.round(F.col("freight_amount") * F.col("usd_per_unit"), 2).cast(D2).alias("freight_cost_usd"),
        F.round(ea * F.col("std_cost_usd"), 2).cast(D2).alias("cogs_usd"),
        F.when(F.col("delivered_ts_utc").isNull(), "IN_TRANSIT").otherwise("DELIVERED").alias("shipment_status"))


# --------------------------------------------------------------- order lines
def order_line_fill(so_item: DataFrame, shipments: DataFrame, carry: list[str] = ()) -> DataFrame:
    """Per sales line: shipped, shipped by commit, delivered by commit (EA) and
    the carrier of the earliest leg (tie-break ship time, shipment id).

    Legs are first summed per (line, ship date, delivery date), map-side
    combined, so a line with very many legs meets the join as a row per pair of
    days. ``carry`` columns of the sales line (one value per line) ride along,
    so the fact needs no second join. The order's number, which the line's id
    begins with, is a key of its own where the shipments have it, so that rows
    dealt by order stay where they are."""
    order = ["_order_ref"] if "_order_ref" in shipments.columns else []
    so = so_item.select(*[dealt_by(so_item, "vbeln").alias(c) for c in order], order_line_id("vbeln", "posnr").alias("order_line_id"), "edatu", *carry)
    days = shipments.groupBy(*order, "order_line_id", "ship_date", "delivery_date").agg(
        F.sum("shipped_qty_ea").alias("day_qty"),
        F.min(F.struct("ship_ts_local", "shipment_id", "carrier_id")).alias("first_leg"))
    zero = F.lit(0).cast(D3)
    qty = F.col("day_qty")

    def total(counted) -> F.Column:
        return F.coalesce(F.sum(F.when(counted, qty).otherwise(zero)), zero).cast(D3)

    def per_line(rows, keys):
        return rows.groupBy(*keys).agg(
            F.coalesce(F.sum(qty), zero).cast(D3).alias("shipped_qty_ea"),
            total(F.col("ship_date") <= F.col("edatu")).alias("shipped_by_commit_qty_ea"),
            total(F.col("delivery_date") <= F.col("edatu")).alias("delivered_by_commit_qty_ea"),
            F.min("first_leg")["carrier_id"].alias("primary_carrier_id"),
            *([F.first("edatu").alias("edatu")] if carry else []), *[F.first(c).alias(c) for c in carry]).drop(*order)

    if not order:
        return per_line(so.join(days, "order_line_id", "left"), ["order_line_id"])
    # lines without an id match no leg and are one group, whatever their orders
    unknown = so.filter(F.col("order_line_id").isNull()).withColumns(
        {c: F.lit(None).cast(days.schema[c].dataType) for c in ("ship_date", "delivery_date", "day_qty", "first_leg")})
    known = so.filter(F.col("order_line_id").isNotNull()).join(days, [*order, "order_line_id"], "left")
    return per_line(known, [*order, "order_line_id"]).unionByName(per_line(unknown, ["order_line_id"]))


def build_order_lines(raw: RawSources, shipments: DataFrame, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    carry = ["vbeln", "kunnr", "matnr", "werks", "audat", "kwmeng", "netpr_usd"]
    base = order_line_fill(raw.so_item, shipments, carry)
    rules = order_line_rules("edatu", "kwmeng", "shipped_qty_ea", "shipped_by_commit_qty_ea",
                             "delivered_by_commit_qty_ea", as_of)
    return base.select(
        "order_line_id", F.col("vbeln").alias("sales_order_number"), F.col("kunnr").alias("customer_id"),
        F.col("matnr").alias("part_id"), F.col("werks").alias("plant_id"), "primary_carrier_id",
        F.col("audat").alias("order_date"), F.col("edatu").alias("commit_date"),
        F.trunc("edatu", "month").alias("commit_month"), quarter_label("edatu").alias("commit_quarter"),
        fiscal_quarter_label("edatu").alias("commit_fiscal_quarter"),
        F.col("kwmeng").alias("order_qty_ea"), "shipped_qty_ea", "shipped_by_commit_qty_ea",
        "delivered_by_commit_qty_ea",
        *[rules[k].alias(k) for k in ("is_due", "due_line_flag", "due_order_qty_ea", "due_shipped_by_commit_qty_ea",
                                      "due_line_filled_flag", "due_line_on_time_flag")],
        F.round(F.col("kwmeng") * F.col("netpr_usd"), 2).cast(D2).alias("order_value_usd"),
        rules["line_status"].alias("line_status"))


# --------------------------------------------------------------- PO lines
def po_base(raw: RawSources, xref: DataFrame, suppliers: DataFrame, plants: DataFrame,
            parts: DataFrame) -> DataFrame:
    """PO items resolved to golden supplier, plant and part (inner joins: an
    unmapped vendor drops the line -- counted by dq_row_loss)."""
    x = xref.filter(F.col("source_system") == "ERP").select(F.col("source_key").alias("_lifnr"), "supplier_id")
    i = raw.po_item.join(x, F.col("lifnr") == F.col("_lifnr")).drop("_lifnr")
    i = i.join(suppliers.select("supplier_id", "supplier_country"), "supplier_id")
    i = i.join(plants.select(F.col("plant_id").alias("werks"), "time_zone", "plant_country", "handling_usd_per_kg"),
               "werks")
    i = with_parts(i, raw.po_item, parts, ["unit_weight_kg", "commodity"])
    return i.withColumn("po_line_id", F.concat(F.col("ebeln"), F.lit("-"),
                                               F.lpad(F.col("ebelp").cast("string"), 5, "0")))


def latest_confirmation(confirmations: DataFrame) -> DataFrame:
    """Latest supplier confirmation per PO line (tie-break: confirmed date)."""
    return arg_latest(confirmations, ["po_ref", "line_ref"], "confirmed_delivery_date",
                      ["confirmed_at", "confirmed_delivery_date"], out="confirmed_delivery_date")


def arrival_resolution(goods_receipt: DataFrame, gate_event: DataFrame, po: DataFrame) -> DataFrame:
    """One row per goods receipt: arrival = plant-local date of the gate-in
    read for its ASN, else the GR posting date, with the source recorded.

    Gate reads are reduced to the earliest GATE_IN per ASN, so duplicate reads
    can never multiply a receipt; the ASN reference is split into its parts, so
    both joins run on the natural key, and the reads are dealt by PO number, as
    the receipts are. The ordered quantity rides along."""
    part = lambda i: F.split_part("asn_ref", F.lit("-"), F.lit(i))
    gate = (gate_event.filter(F.col("event_type") == "GATE_IN")
            .select(part(1).alias("ebeln"), F.expr("try_cast(split_part(asn_ref, '-', 2) as int)").alias("ebelp"),
                    F.expr("try_cast(split_part(asn_ref, '-', 3) as int)").alias("receipt_seq"), "event_ts_utc")
            .repartition("ebeln").groupBy("ebeln", "ebelp", "receipt_seq").agg(F.min("event_ts_utc").alias("gate_ts_utc")))
    lines = po.select("ebeln", "ebelp", "time_zone", F.col("menge").alias("ordered_qty"))
    found = goods_receipt.join(lines, ["ebeln", "ebelp"]).join(gate, ["ebeln", "ebelp", "receipt_seq"], "left")
    found = found.withColumn("gate_date", F.to_date(utc_to_local("gate_ts_utc", "time_zone")))
    found = resolve_first(found, [("gate_date", "IOT_GATE_IN"), ("budat", "ERP_GR_POSTING")], "arrival_date")
    return found.select("ebeln", "ebelp", "receipt_seq", F.col("menge").alias("gr_qty"), "arrival_date",
                        F.when(F.col("gate_ts_utc").isNull(), "ERP_GR_POSTING").otherwise("IOT_GATE_IN")
                        .alias("arrival_source"), "ordered_qty")


def daily_receipts(receipts: DataFrame) -> DataFrame:
    """Receipts per (PO line, arrival date) with the running quantity through
    that date (window over at most one row per line and day)."""
    daily = receipts.groupBy("ebeln", "ebelp", "arrival_date").agg(
        F.sum("gr_qty").alias("day_qty"), F.count(F.lit(1)).alias("day_receipts"),
        F.count_if(F.col("arrival_source") == "IOT_GATE_IN").alias("day_iot"), F.first("ordered_qty").alias("ordered_qty"))
    w = (Window.partitionBy("ebeln", "ebelp").orderBy("arrival_date")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return daily.withColumn("cum_qty", F.sum("day_qty").over(w))


def receipt_rollup(receipts: DataFrame) -> DataFrame:
    """Per PO line: received qty, first/last arrival, full-receipt date (first
    arrival at which the running qty reaches the ordered qty), receipt count
    and arrival source (IOT_GATE_IN / ERP_GR_POSTING / MIXED)."""
    per_line = daily_receipts(receipts).groupBy("ebeln", "ebelp").agg(
        F.sum("day_qty").cast(D3).alias("received_qty_ea"), F.min("arrival_date").alias("first_arrival_date"),
        F.max("arrival_date").alias("last_arrival_date"),
        F.min(F.when(F.col("cum_qty") >= F.col("ordered_qty"), F.col("arrival_date"))).alias("full_receipt_date"),
        F.sum("day_receipts").cast("int").alias("receipt_count"), F.sum("day_iot").alias("_gate"))
    source = (F.when(F.col("_gate") == F.col("receipt_count"), "IOT_GATE_IN").when(F.col("_gate") == 0, "ERP_GR_POSTING")
              .otherwise("MIXED"))
    return per_line.withColumn("arrival_source", source).drop("_gate")


def po_freight(raw: RawSources, as_of: dt.date) -> DataFrame:
    """Inbound freight per PO in USD at the as-of month's rate."""
    # one month of rates: a row per currency, whatever the data's size
    rate = F.broadcast(raw.fx_rate.filter(F.col("month_start") == F.trunc(F.lit(as_of), "month"))
                       .select("currency", "usd_per_unit"))
    return (raw.inbound_freight.join(rate, "currency")
            .groupBy("po_ref").agg(F.sum(F.col("freight_amount") * F.col("usd_per_unit")).alias("po_freight_usd")))


def po_totals(po: DataFrame, freight: DataFrame) -> DataFrame:
    """Per PO: total line weight and freight (USD) -- the allocation base."""
    w = po.groupBy("ebeln").agg(F.sum(F.col("menge") * F.col("unit_weight_kg")).alias("po_weight_kg"))
    return w.join(freight.select(F.col("po_ref").alias("ebeln"), "po_freight_usd"), "ebeln", "left")


def allocated_freight(received_qty, line_weight, po_weight, po_freight) -> F.Column:
    """round(freight * line weight / PO weight, 2); 0 for lines with no
    receipt (their share is not redistributed). Share computed as double
    (a*b/c) then DECIMAL(18,8) -- the oracle uses the same order."""
    share = (F.coalesce(po_freight, F.lit(0)).cast("double") * line_weight.cast("double")
             / F.when(po_weight == 0, None).otherwise(po_weight).cast("double")).cast("decimal(18,8)")
    return F.round(F.when(received_qty > 0, F.coalesce(share, F.lit(0))).otherwise(F.lit(0)), 2).cast(D2)


def freight_allocation(po: DataFrame, freight: DataFrame, rcv: DataFrame) -> DataFrame:
    """Per PO line: freight share by weight, zero when the line has no receipt."""
    lines = (po.select("ebeln", "ebelp", (F.col("menge") * F.col("unit_weight_kg")).alias("line_weight_kg"))
             .join(rcv.select("ebeln", "ebelp", "received_qty_ea"), ["ebeln", "ebelp"], "left")
             .withColumn("_eligible", F.coalesce(F.col("received_qty_ea"), F.lit(0)) > 0))
    totals = freight.select(F.col("po_ref").alias("ebeln"), "po_freight_usd")
    a = proportional_allocate(lines, totals, "ebeln", "line_weight_kg", "po_freight_usd", "freight_alloc_usd",
                              eligible="_eligible")
    return a.select("ebeln", "ebelp", F.round("freight_alloc_usd", 2).cast(D2).alias("freight_usd"))


def build_po_lines(raw: RawSources, xref: DataFrame, suppliers: DataFrame, plants: DataFrame, parts: DataFrame,
                   params: Params, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    po = po_base(raw, xref, suppliers, plants, parts)
    return po_lines_from_base(raw, po, params, as_of)


def po_lines_from_base(raw: RawSources, po: DataFrame, params: Params, as_of: dt.date = DEFAULT_AS_OF) -> DataFrame:
    conf = latest_confirmation(raw.po_confirmation)
    rcv = receipt_rollup(arrival_resolution(raw.goods_receipt, raw.gate_event, po))
    totals = po_totals(po, po_freight(raw, as_of))
    b = po.join(conf, (F.col("ebeln") == F.col("po_ref")) & (F.col("ebelp") == F.col("line_ref")), "left")
    b = resolve_first(b, [("confirmed_delivery_date", "SUPPLIER_PORTAL"), ("eindt", "REQUESTED_DATE_FALLBACK")],
                      "confirmed_date", "confirmed_date_source")
    b = fx_convert(b, F.broadcast(raw.fx_rate), "waers", "bedat")
    b = b.join(rcv, ["ebeln", "ebelp"], "left").join(totals, "ebeln", "left")
    duty = raw.duty_rate.select(F.col("origin_country").alias("supplier_country"),
                                F.col("dest_country").alias("plant_country"), "commodity", "duty_pct")
    b = b.join(duty, ["supplier_country", "plant_country", "commodity"], "left")
    rq = F.coalesce(F.col("received_qty_ea"), F.lit(0).cast(D3))
    b = b.withColumns({
        "price_usd": F.round(F.col("netpr") * F.col("usd_per_unit"), 4).cast(D4),
        "received_qty": rq.cast(D3),
        "duty_pct": F.coalesce(F.col("duty_pct"), F.lit(0).cast("decimal(6,2)")),
        "freight_usd": allocated_freight(rq, F.col("menge") * F.col("unit_weight_kg"), F.col("po_weight_kg"),
                                         F.col("po_freight_usd")),
    })
    b = b.withColumns({
        "goods_value_usd": F.round(F.col("received_qty") * F.col("price_usd"), 2).cast(D2),
        "handling_usd": F.round(F.col("received_qty").cast("decimal(15,3)") * F.col("unit_weight_kg").cast(
            "decimal(9,3)") * F.col("handling_usd_per_kg"), 2).cast(D2),
    })
    return finish_po_lines(b, params, as_of)


def finish_po_lines(b: DataFrame, params: Params, as_of: dt.date) -> DataFrame:
    """Rule-dependent PO columns (tolerance window, due-ness, insurance,
    landed cost) -- shared by the build and by the governed re-apply."""
    win = classify_window("full_receipt_date", "confirmed_date", params.early_tol, params.late_tol, as_of)
    costs = landed_cost_parts("goods_value_usd", "duty_pct", params.insurance_pct)
    b = b.withColumns({"duty_usd": costs["duty_usd"], "insurance_usd": costs["insurance_usd"]})
    landed = (F.col("goods_value_usd") + F.col("freight_usd") + F.col("duty_usd") + F.col("insurance_usd")
              + F.col("handling_usd")).cast(D2)
    return b.select(
        "po_line_id", F.col("ebeln").alias("po_number"), F.col("ebelp").alias("po_item"), "supplier_id",
        F.col("lifnr").alias("source_vendor_code"), F.col("matnr").alias("part_id"), F.col("werks").alias("plant_id"),
        F.col("menge").alias("order_qty_ea"), F.col("netpr").cast("decimal(38,4)").alias("unit_price_local"),
        F.col("waers").alias("currency"), F.col("price_usd").cast("decimal(38,4)").alias("unit_price_usd"),
        F.col("bedat").alias("po_date"), F.col("eindt").alias("requested_date"), "confirmed_date",
        "confirmed_date_source", F.trunc("confirmed_date", "month").alias("confirmed_month"),
        quarter_label("confirmed_date").alias("confirmed_quarter"),
        fiscal_quarter_label("confirmed_date").alias("confirmed_fiscal_quarter"),
        F.col("received_qty").alias("received_qty_ea"), "first_arrival_date",
        F.col("last_arrival_date").alias("receipt_date"), quarter_label("last_arrival_date").alias("receipt_quarter"),
        "full_receipt_date", F.coalesce(F.col("receipt_count"), F.lit(0)).cast("int").alias("receipt_count"),
        "arrival_source", win["days_late"].alias("days_late"), win["is_due"].alias("is_due"),
        F.when(win["is_due"], 1).otherwise(0).alias("due_line_flag"),
        F.when(win["is_due"] & win["within_window"], 1).otherwise(0).alias("on_time_line_flag"),
        win["delivery_status"].alias("delivery_status"),
        "goods_value_usd", "freight_usd", "duty_usd", "insurance_usd", "handling_usd",
        landed.alias("landed_cost_usd"))


# --------------------------------------------------------------- inventory
def trailing_cogs(inv: DataFrame, shipments: DataFrame, window_days: int) -> DataFrame:
    """COGS of shipments per (plant, part) in (snapshot - W, snapshot]."""
    return trailing_window_sum(inv, shipments.select("plant_id", "part_id", "ship_date", "cogs_usd"),
                               ["plant_id", "part_id"], "snapshot_date", "ship_date", "cogs_usd", window_days,
                               "cogs_window_usd", dealt=["part_id"])


def build_inventory(raw: RawSources, parts: DataFrame, shipments: DataFrame, params: Params) -> DataFrame:
    inv = raw.inventory_snapshot.select("snapshot_date", F.col("site_code").alias("plant_id"),
                                        F.col("sku").alias("part_id"), "on_hand_qty", "in_transit_qty")
    inv = inv.join(parts.select("part_id", "std_cost_usd"), "part_id")
    newest = inv.agg(F.max("snapshot_date").alias("_newest"))  # one row, combined map-side
    inv = (inv.crossJoin(F.broadcast(newest))
           .withColumn("is_latest_snapshot", F.col("snapshot_date") == F.col("_newest")).drop("_newest"))
    inv = trailing_cogs(inv, shipments, params.doi_window)
    return finish_inventory(inv, params)


def finish_inventory(inv: DataFrame, params: Params) -> DataFrame:
    return inv.select(
        F.concat_ws("|", F.col("snapshot_date").cast("string"), "plant_id", "part_id").alias("inventory_position_id"),
        "snapshot_date", F.trunc("snapshot_date", "month").alias("snapshot_month"), "plant_id", "part_id",
        F.col("on_hand_qty").alias("on_hand_qty_ea"), F.col("in_transit_qty").alias("in_transit_qty_ea"),
        F.round(F.col("on_hand_qty") * F.col("std_cost_usd"), 2).cast(D2).alias("inventory_value_usd"),
        F.round(F.col("in_transit_qty") * F.col("std_cost_usd"), 2).cast(D2).alias("in_transit_value_usd"),
        F.col("cogs_window_usd").cast(D2).alias("cogs_window_usd"),
        round_div_4dp(F.col("cogs_window_usd"), params.doi_window).alias("avg_daily_cogs_usd"),
        "is_latest_snapshot")


# --------------------------------------------------------------- all
@dataclass
class Conformed:
    xref_supplier: DataFrame
    dim_supplier: DataFrame
    dim_part: DataFrame
    dim_plant: DataFrame
    dim_customer: DataFrame
    dim_carrier: DataFrame
    fct_shipment: DataFrame
    fct_order_line: DataFrame
    fct_po_line: DataFrame
    fct_inventory: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


# Time anchor each fact is filtered on most (period filters prune row groups).
SORT_ANCHOR = {"fct_shipment": "ship_date", "fct_order_line": "commit_date", "fct_po_line": "confirmed_date",
               "fct_inventory": "snapshot_date"}


def _day(bound) -> dt.date | None:
    """A bound as a date; None if it isn't one (the comparison itself stays Spark's)."""
    if isinstance(bound, str):
        try:
            return dt.date.fromisoformat(bound.strip()[:10])
        except ValueError:
            return None
    return bound if isinstance(bound, dt.date) else None


def in_years(df: DataFrame, lo, hi) -> DataFrame:
    """Prune a written fact's year directories to a period of its anchor (the anchor's own filter stays needed).
    Bounds are dates, or texts of dates; with any other bound nothing is pruned."""
    lo, hi = _day(lo), _day(hi)
    if "anchor_year" not in df.columns or lo is None or hi is None:
        return df
    return df.filter(F.col("anchor_year").between(lo.year, hi.year))


def public(df: DataFrame) -> DataFrame:
    """A fact without the column of its directories and the shipments' order number."""
    return df.drop("anchor_year", "_order_ref")


#: What columns of the conformed layer mean; kept as field metadata ``comment`` in the written files.
COMMENTS = {
    "dim_supplier": {"supplier_id": "One id per real-world supplier, whatever codes the sources use"},
    "dim_part": {"part_id": "Material number of the ERP", "pack_qty": "Pieces in a box"},
    "dim_plant": {"plant_id": "ERP plant code", "plant_city": "City by which plants are asked for"},
    "fct_po_line": {
        "confirmed_date": "Date promised by the supplier, else the requested one", "confirmed_date_source": "Where the confirmed date comes from",
        "arrival_source": "Gate read in plant time, else the posting", "full_receipt_date": "First day on which all ordered pieces were there",
        "days_late": "Full receipt minus confirmed date, negative when early", "is_due": "Past the confirmed date and the late tolerance",
        "on_time_line_flag": "1 for a due line received in full inside the window", "landed_cost_usd": "Goods, freight, duty, insurance and handling"},
    "fct_order_line": {
        "commit_date": "Date promised to the customer", "shipped_by_commit_qty_ea": "Pieces shipped by the promise, plant time",
        "due_line_filled_flag": "1 for a due line shipped in full by the promise", "due_line_on_time_flag": "1 for a due line delivered in full by the promise"},
    "fct_shipment": {"ship_ts_local": "Departure in plant time", "shipped_qty_ea": "Pieces, boxes converted"},
    "fct_inventory": {"snapshot_date": "Month end", "avg_daily_cogs_usd": "Cost of goods shipped per day over the trailing window",
                      "is_latest_snapshot": "Belongs to the newest month end of all"},
}


def commented(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the comments of its table as field metadata, which projections and files carry along."""
    for column, text in COMMENTS.get(table, {}).items():
        if column in df.columns:
            df = df.withMetadata(column, {**df.schema[column].metadata, "comment": text})
    return df


def comments(df: DataFrame) -> dict[str, str]:
    """Comments of the columns of a frame."""
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write once and read back under the written schema."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def write_fact(df: DataFrame, path: str, anchor: str) -> DataFrame:
    """Write a fact partitioned by plant and anchor year, sorted by the anchor.

    One shuffle brings the rows of a (plant, year) together; its partitions are
    rebalanced by their sizes, so a large directory is dealt to as many tasks
    (files) as it has advisory partition sizes, and small ones share a task.
    Read back under the written schema: a plant code such as 0001 stays text.
    ``anchor_year`` is a directory only; period filters on the anchor prune it
    (see semantic.py) and row groups.
    """
    columns = df.columns
    (df.withColumn("anchor_year", F.coalesce(F.year(anchor), F.lit(0)))
     .hint("rebalance", "plant_id", "anchor_year")
     .sortWithinPartitions("plant_id", "anchor_year", anchor)
     .write.mode("overwrite").partitionBy("plant_id", "anchor_year").parquet(path))
    schema = StructType([*df.schema.fields, StructField("anchor_year", IntegerType())])
    return df.sparkSession.read.schema(schema).parquet(path).select(*columns, "anchor_year")


def build_materialized(spark: SparkSession, raw: RawSources, path: str, params: Params | None = None,
                       as_of: dt.date = DEFAULT_AS_OF, parallel: int = 4) -> Conformed:
    """Build and write the conformed layer in dependency order: each table is
    computed from already-written parents (crosswalk before suppliers and PO
    lines, shipments before order lines and inventory), so nothing upstream is
    recomputed and every written table cuts the lineage. Independent tables
    of one level are written by concurrent jobs from ``parallel`` threads."""
    params = params or Params()

    def save(name, df, part=False):
        df = commented(df, name)
        return write_fact(df, f"{path}/{name}", SORT_ANCHOR[name]) if part else write_table(df, f"{path}/{name}")

    def level(jobs):
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            futures = {name: pool.submit(fn) for name, fn in jobs.items()}
            return {name: f.result() for name, f in futures.items()}

    xref = save("xref_supplier", build_crosswalk(raw.vendor, raw.portal_vendor))
    d = level({"dim_supplier": lambda: save("dim_supplier", build_dim_supplier(raw.vendor, xref)),
               "dim_part": lambda: save("dim_part", dim_part(raw)),
               "dim_plant": lambda: save("dim_plant", dim_plant(raw)),
               "dim_customer": lambda: save("dim_customer", dim_customer(raw)),
               "dim_carrier": lambda: save("dim_carrier", dim_carrier(raw))})
    shp = save("fct_shipment", public(build_shipments(raw, d["dim_part"], d["dim_plant"])), True)

    def po_lines():
        po = save("stage_po_base", po_base(raw, xref, d["dim_supplier"], d["dim_plant"], d["dim_part"]))
        return save("fct_po_line", po_lines_from_base(raw, po, params, as_of), True)

    f = level({"fct_order_line": lambda: save("fct_order_line", build_order_lines(raw, shp, as_of), True),
               "fct_po_line": po_lines,
               "fct_inventory": lambda: save("fct_inventory", build_inventory(raw, d["dim_part"], shp, params), True)})
    return Conformed(xref_supplier=xref, dim_supplier=d["dim_supplier"], dim_part=d["dim_part"],
                     dim_plant=d["dim_plant"], dim_customer=d["dim_customer"], dim_carrier=d["dim_carrier"],
                     fct_shipment=shp, fct_order_line=f["fct_order_line"], fct_po_line=f["fct_po_line"],
                     fct_inventory=f["fct_inventory"])


def build(raw: RawSources, params: Params | None = None, as_of: dt.date = DEFAULT_AS_OF) -> Conformed:
    params = params or Params()
    xref = small_side(build_crosswalk(raw.vendor, raw.portal_vendor))
    sup = small_side(build_dim_supplier(raw.vendor, xref))
    parts, plants = small_side(dim_part(raw)), F.broadcast(dim_plant(raw))  # five plants
    shp = build_shipments(raw, parts, plants)
    c = Conformed(
        xref_supplier=xref, dim_supplier=sup, dim_part=parts, dim_plant=plants, dim_customer=dim_customer(raw),
        dim_carrier=dim_carrier(raw), fct_shipment=shp, fct_order_line=build_order_lines(raw, shp, as_of),
        fct_po_line=build_po_lines(raw, xref, sup, plants, parts, params, as_of),
        fct_inventory=build_inventory(raw, parts, shp, params))
    return Conformed(**{name: commented(df, name) for name, df in c.items()})
