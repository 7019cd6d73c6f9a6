"""Adapter: driver tables (TPC-H-like parquet) -> the 16 RAW source shapes.

This is test/benchmark wiring, not library logic. Each RAW table is a lazy
DataFrame derived from the driver tables, so every query built on it scales
with ``lineitem``. Rows sharing ``(l_orderkey, l_linenumber)`` become the
partial receipts / shipment legs of one order line.

Mapping (ok = l_orderkey, ln = l_linenumber, pk/sk = part/supplier key,
q = l_quantity, seq = row number inside (ok, ln), fs = first ship date of the
line, p = ok % 5 = plant index) follows FIXTURES.md section 6.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from truetally.functions.calendar import month_end_spine
from truetally.functions.units import local_to_utc
from truetally.operators.keys import fits, looked_up, small_side, with_looked_up
from truetally.params import DEFAULT_AS_OF
from truetally.sources import reference_data as ref

SNAPSHOT_MONTHS = 12


@dataclass
class RawSources:
    plant: DataFrame
    fx_rate: DataFrame
    vendor: DataFrame
    portal_vendor: DataFrame
    material: DataFrame
    customer: DataFrame
    carrier: DataFrame
    duty_rate: DataFrame
    po_item: DataFrame
    po_confirmation: DataFrame
    goods_receipt: DataFrame
    gate_event: DataFrame
    inbound_freight: DataFrame
    shipment: DataFrame
    so_item: DataFrame
    inventory_snapshot: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]

    def materialize(self, spark: SparkSession, path: str, parallel: int = 4) -> "RawSources":
        """Write each RAW table once (parquet) and read it back: later plans
        start from files instead of re-deriving the adapter, and lineage is cut.
        The tables are independent, so their jobs are submitted concurrently
        from ``parallel`` driver threads (Spark runs concurrent jobs of one
        application side by side)."""
        def save(item):
            name, df = item
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            return name, spark.read.schema(df.schema).parquet(f"{path}/{name}").select(*df.columns)
        with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
            return RawSources(**dict(pool.map(save, self.items())))


def read_driver(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """Read one driver table, projecting only ``cols`` (column pruning at the scan)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def _pad(c: Column, n: int = 9) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _pick(values: list[str], idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx + 1).cast("int"))


def _days(c: Column) -> Column:
    return c.cast("int")


def _ntz(d: Column, hour: Column | int, minute: Column | int) -> Column:
    h = F.lit(hour) if isinstance(hour, int) else hour
    m = F.lit(minute) if isinstance(minute, int) else minute
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), h, m, F.lit(0))


#: Bits of a line item's word, from the highest.
WORD = {"pk": 24, "sk": 20, "day": 15, "ln": 4}


def packed(items: DataFrame) -> DataFrame:
    """Line items with part, supplier, ship day and line number in one long, ``word``, for the way through a shuffle.

    A row has a word if all four are known and within their bits and the day is without a time. Any other row has no
    word and keeps its columns in the struct ``plain``, so nothing is lost whatever the values. The order of the
    columns is the one in which rows compress best: bytes that are mostly zero lie together."""
    day = F.to_date("l_shipdate")
    values = {"pk": F.col("pk"), "sk": F.col("sk"), "day": F.unix_date(day), "ln": F.col("ln")}
    fits, word = F.col("l_shipdate") == day, F.lit(0).cast("long")
    for name, bits in WORD.items():
        fits = fits & values[name].between(0, (1 << bits) - 1)
        word = F.shiftleft(word, bits).bitwiseOR(values[name].cast("long"))
    plain = F.when(F.coalesce(fits, F.lit(False)), None).otherwise(F.struct("pk", "sk", "ln", "l_shipdate"))
    return items.select(plain.alias("plain"), "l_quantity", F.when(fits, word).alias("word"), "ok")


def unpacked(rows: DataFrame) -> DataFrame:
    """The columns of :func:`packed` line items as they were."""
    rest, values = F.col("word"), {}
    for name, bits in reversed(WORD.items()):
        values[name], rest = rest.bitwiseAND(F.lit((1 << bits) - 1)), F.shiftright(rest, bits)
    values["l_shipdate"] = F.date_from_unix_date(values.pop("day").cast("int"))
    kinds = {f.name: f.dataType for f in rows.schema["plain"].dataType.fields}
    return rows.select("ok", "l_quantity", *[
        F.when(F.col("word").isNull(), F.col(f"plain.{c}")).otherwise(v.cast(kinds[c])).alias(c) for c, v in values.items()])


def fx_rates(spark: SparkSession, dates: DataFrame, as_of: dt.date) -> DataFrame:
    """Monthly USD-per-unit rates; USD is exactly 1.

    The months run from a year before the first to a year after the last of
    ``dates`` (column ``day``) and cover ``as_of``, so no dated row lacks a rate
    (derived dates lie within weeks of the line's own).
    """
    ends = dates.agg(F.least(F.min("day"), F.lit(as_of)).alias("lo"), F.greatest(F.max("day"), F.lit(as_of)).alias("hi"))
    ends = ends.select(F.coalesce("lo", F.lit(as_of)).alias("lo"), F.coalesce("hi", F.lit(as_of)).alias("hi"))
    months = ends.select(F.explode(F.sequence(F.trunc(F.add_months("lo", -12), "month"), F.trunc(F.add_months("hi", 12), "month"),
                                              F.expr("interval 1 month"))).alias("month_start"))
    cur = spark.createDataFrame([("USD", "1.0", 0)] + [(c, str(b), j + 1) for j, (c, b) in enumerate(ref.FX_BASES)],
                                "currency string, base string, j int")
    ym = F.year("month_start") * 12 + F.month("month_start")
    factor = (F.lit(1000) + F.pmod(ym * (F.col("j") + 1), F.lit(61)) - 30).cast("decimal(6,0)")
    rate = F.when(F.col("currency") == "USD", F.lit(1).cast("decimal(18,6)")).otherwise(
        F.round(F.col("base").cast("decimal(18,6)") * factor * F.lit(0.001).cast("decimal(4,3)"), 6))
    return months.crossJoin(cur).select("month_start", "currency", rate.cast("decimal(18,6)").alias("usd_per_unit"))


def raw_sources(spark: SparkSession, sf_dir: str, as_of: dt.date = DEFAULT_AS_OF,
                stage_dir: str | None = None, one_shuffle: bool = False) -> RawSources:
    """Lazy RAW tables. With ``stage_dir`` (a shared folder, e.g. under
    spark.checkpoint.dir) the per-row and per-line derivations of lineitem are
    written there once and read back, so the 16 RAW tables do not each
    re-run the lineitem window when they are materialised.

    Without it nothing is written: line items are dealt once by PO number for
    the purchasing tables and once by sales order number for the sales tables.
    All tables of a side read the same shuffle (Spark reuses equal exchanges),
    and joins of them on the order or on order and line need no other. So the
    derived columns that callers filter by (plant, line reference, order) come
    out of the window or the aggregation: a filter pushed below the shuffle
    would give each table a shuffle of its own.

    Line items go through the shuffle :func:`packed`. Where parts are too many to be sent to every task, the parts of
    each order are looked up (:func:`looked_up`) once for all tables of a side, whose lines stay where they are.
    Purchasing and sales lines then carry ``_order``, the number by which they are dealt, never null, so that parts
    can be looked up for them in the same way.

    With ``one_shuffle`` the sales tables read the purchasing tables' shuffle
    too, for queries over both sides. Their rows then carry ``_dealt``, the
    number by which they are dealt: one to one with the sales order number, so
    a join or a grouping on both has the rows of one on the order number."""
    asof = F.lit(as_of)
    plant = ref.plants_df(spark)
    carrier = ref.carriers_df(spark)
    plant_b = F.broadcast(plant.select("plant_idx", "werks", "time_zone", "local_currency", "country_code"))  # five plants

    part = read_driver(spark, sf_dir, "part", "p_partkey", "p_name", "p_type", "p_brand", "p_size", "p_retailprice")
    material = part.select(
        F.concat(F.lit("M"), _pad(F.col("p_partkey"))).alias("matnr"),
        F.col("p_name").alias("maktx"), F.col("p_type").alias("zz_commodity"), F.col("p_brand").alias("zz_category"),
        F.col("p_retailprice").cast("decimal(18,4)").alias("stprs_usd"),
        (F.col("p_size").cast("decimal(18,3)") * F.lit(0.1).cast("decimal(2,1)")).cast("decimal(18,3)").alias("brgew_kg"),
        F.lit(10).alias("pack_qty"), F.lit("EA").alias("meins"))
    part_cost = part.select(F.col("p_partkey").alias("pk1"),
                            F.col("p_retailprice").cast("decimal(18,4)").alias("cost"),
                            (F.col("p_size").cast("decimal(18,3)") * F.lit(0.1).cast("decimal(2,1)"))
                            .cast("decimal(18,3)").alias("wt"))
    few_parts = fits(part_cost)
    if few_parts:
        part_cost = F.broadcast(part_cost)

    sup = read_driver(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    tax = F.concat(F.lit("TAX"), F.lpad((F.col("s_suppkey") * 7919 % 1000003).cast("string"), 7, "0"))
    land = _pick(ref.SUPPLIER_COUNTRIES, F.pmod(F.col("s_nationkey"), F.lit(8)))
    tier = F.when(F.col("s_suppkey") % 4 == 0, "TIER_2").otherwise("TIER_1")
    primary = sup.select(F.concat(F.lit("V1"), _pad(F.col("s_suppkey"))).alias("lifnr"), F.col("s_name").alias("name1"),
                         land.alias("land1"), tax.alias("stcd1"), F.lit("PRIMARY").alias("ktokk"), tier.alias("zz_tier"))
    alt = sup.filter(F.col("s_suppkey") % 8 == 3).select(
        F.concat(F.lit("V9"), _pad(F.col("s_suppkey"))).alias("lifnr"),
        F.concat(F.col("s_name"), F.lit(" - Pay Addr 2")).alias("name1"), land.alias("land1"), tax.alias("stcd1"),
        F.lit("ALT_PAYEE").alias("ktokk"), tier.alias("zz_tier"))
    vendor = primary.unionByName(alt)
    portal_vendor = sup.select(
        F.concat(F.lit("PV-"), _pad(F.lit(1000) + F.col("s_suppkey") * 13)).alias("portal_vendor_id"),
        F.upper("s_name").alias("vendor_display_name"), tax.alias("tax_registration"),
        F.lit("ACTIVE").alias("onboarding_status"))

    cust = read_driver(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    customer = cust.select(F.concat(F.lit("C"), _pad(F.col("c_custkey"))).alias("kunnr"), F.col("c_name").alias("name1"),
                           _pick(ref.CUSTOMER_COUNTRIES, F.pmod(F.col("c_nationkey"), F.lit(8))).alias("land1"),
                           F.col("c_mktsegment").alias("kdgrp"))

    # Duty grid: 8 origins x 5 plant countries x distinct commodity (bounded vocabulary).
    # origin x destination lane grid: 8 x 5 fixed values, built as one VALUES relation
    lanes = spark.createDataFrame([(oi, o, di, p[3]) for oi, o in enumerate(ref.SUPPLIER_COUNTRIES)
                                   for di, p in enumerate(ref.PLANTS)],
                                  "oi int, origin_country string, di int, dest_country string")
    commodities = part.select(F.col("p_type").alias("commodity")).distinct()
    duty = F.when(F.col("origin_country") == F.col("dest_country"), F.lit(0)).otherwise(
        (F.pmod(7 * F.col("oi") + 11 * F.col("di") + 3 * F.length("commodity"), F.lit(96)) + 25)
        .cast("decimal(6,0)") * F.lit(0.1).cast("decimal(2,1)"))
    duty_rate = (commodities.crossJoin(F.broadcast(lanes))
                 .select("origin_country", "dest_country", "commodity", duty.cast("decimal(6,2)").alias("duty_pct")))
    duty_rate = small_side(duty_rate)

    # ---- line items: one shuffle by the order number gives seq, first ship date, line part/supplier
    items = read_driver(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                        "l_quantity", "l_shipdate")
    items = items.select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
                         F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"), "l_quantity", "l_shipdate")
    numbers = {"ebeln": F.concat(F.lit("45"), _pad(F.col("ok"))), "vbeln": F.concat(F.lit("10"), _pad(F.col("ok")))}

    def held(c: Column) -> Column:
        """``c`` as a value of the numbered row, by which no filter gets below the numbering and its shuffle."""
        return F.when(F.col("seq") > 0, c)

    def dealt_items(number: str) -> DataFrame:
        return unpacked(packed(items).repartition(numbers[number])).withColumn(number, numbers[number])

    def line_rows(number: str) -> DataFrame:
        """Line items dealt by the order number ``number``, with what their line gives them: one sort, one window."""
        li = dealt_items(number)
        # rows equal in all of these are equal in every column used, so no further column (the price) need break ties
        w_seq = Window.partitionBy("ok", "ln", number).orderBy("l_shipdate", "pk", "sk", "l_quantity")
        whole = w_seq.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        li = li.withColumn("q", F.col("l_quantity").cast("decimal(18,3)"))
        li = li.withColumns({
            "seq": F.row_number().over(w_seq), "fs": F.min(F.to_date("l_shipdate")).over(whole),
            "pk1": F.first("pk").over(whole), "sk1": F.first("sk").over(whole),
            "sumq": F.sum("q").over(whole).cast("decimal(18,3)")})
        li = li.withColumns({
            "p": held(F.pmod(F.col("ok"), F.lit(5)).cast("int")),
            "ebelp" if number == "ebeln" else "posnr": held((F.col("ln") * 10).cast("int")),
            "ship_date": F.date_add("fs", _days((F.col("seq") - 1) * (3 + F.col("sk") % 10))),
            "arrival": F.date_add("fs", _days((F.col("seq") - 1) * (4 + F.col("pk") % 12))),
        }).withColumn("budat", F.date_add("arrival", _days(F.col("sk") % 4)))
        return li.withColumns({
            "gi_qty": F.sum(F.when(F.col("ship_date") < asof, F.col("q")).otherwise(F.lit(0).cast("decimal(18,3)")))
            .over(whole).cast("decimal(18,3)"),
            "has_receipt": F.max(F.col("budat") < asof).over(whole)})

    def costed(rows: DataFrame, key: str, number: str, columns: list[str]) -> DataFrame:
        """``rows`` with ``columns`` of the part ``key``; many parts are looked up for the orders ``number``."""
        if few_parts or stage_dir:
            return rows.join(part_cost.select(F.col("pk1").alias(key), *columns), key)
        if number not in found:
            # a mark of every column holds the part, so the shuffle read is that of the lines and none of its own
            mark = F.bit_xor(F.xxhash64("ok", "ln", "sk", "l_quantity", "l_shipdate"))
            known = dealt_items(number).filter(F.col(number).isNotNull()).groupBy(number, "pk").agg(mark.alias("mark"))
            known = known.select(number, F.when(F.col("mark").isNotNull(), F.col("pk")).alias("pk1"))
            found[number] = looked_up(known, part_cost, "pk1", number)
        return with_looked_up(rows, found[number], key, number, columns, "pk1")

    found: dict[str, DataFrame] = {}

    def line_totals(li: DataFrame, number: str) -> DataFrame:
        """A row per line, its first, with the line's quantity, part, supplier and plant; no line of an unknown order."""
        lines = li.filter(F.col("seq") < 2).withColumns({"ok": held(F.col("ok")), "ln": held(F.col("ln"))})
        lines = lines.withColumns({
            "menge": (F.col("sumq") + F.when((F.col("ok") + F.col("ln")) % 10 == 0, 5).otherwise(0))
            .cast("decimal(18,3)"),
            "cb": F.date_add("fs", _days(F.pmod(7 * F.col("ok") + 3 * F.col("ln"), F.lit(9)) - 4)),
            "cm": F.date_add("fs", _days(F.pmod(5 * F.col("ok") + F.col("ln"), F.lit(8)) - 2)),
            "matnr": F.concat(F.lit("M"), _pad(F.col("pk1"))),
        })
        return costed(lines.join(plant_b, lines.p == plant_b.plant_idx), "pk1", number, ["cost", "wt"])

    side, dealt = ("ebeln", ["_dealt"]) if one_shuffle else ("vbeln", [])  # the number by which the sales rows are dealt
    if stage_dir:
        line_rows("ebeln").write.mode("overwrite").parquet(f"{stage_dir}/line_rows")
        li = spark.read.parquet(f"{stage_dir}/line_rows")
        line_totals(li, "ebeln").write.mode("overwrite").parquet(f"{stage_dir}/lines")
        lines = spark.read.parquet(f"{stage_dir}/lines")
        sold, so_lines = (df.withColumns({"vbeln": numbers["vbeln"], "posnr": F.col("ebelp")}) for df in (li, lines))
    else:
        li = line_rows("ebeln")
        sold = (li.withColumns({"vbeln": held(numbers["vbeln"]), "posnr": F.col("ebelp"), "_dealt": F.col("ebeln")})
                if one_shuffle else line_rows("vbeln"))
        # rows of unknown orders reach no joined table; left out here, all tables have the same shuffle
        lines = line_totals(li.filter(F.col("ebeln").isNotNull()), "ebeln")
        so_lines = line_totals(sold.filter(F.col(side).isNotNull()), side)

    far = not (few_parts or stage_dir)
    po_item = lines.select(
        "ebeln", "ebelp", *([F.col("ebeln").alias("_order")] if far else []),
        F.concat(F.when((F.col("sk1") % 8 == 3) & (F.col("ok") % 3 == 0), "V9").otherwise("V1"),
                 _pad(F.col("sk1"))).alias("lifnr"),
        "matnr", "werks", "menge", F.lit("EA").alias("meins"),
        F.round(F.col("cost") * (F.lit(90) + F.col("ok") % 21).cast("decimal(5,0)")
                * F.lit(0.01).cast("decimal(3,2)"), 2).cast("decimal(18,4)").alias("netpr"),
        F.col("local_currency").alias("waers"),
        F.date_sub("cb", _days(20 + F.col("ok") % 60)).alias("bedat"),
        F.date_add("cb", _days(F.col("ok") % 5 - 2)).alias("eindt"))

    conf_src = lines.filter(F.col("ok") % 10 != 7).select(
        "ok", "ln", "ebeln", "ebelp", "cb", "sk1", F.date_sub("cb", _days(20 + F.col("ok") % 60)).alias("bedat"))
    pv_id = F.concat(F.lit("PV-"), _pad(F.lit(1000) + F.col("sk1") * 13))
    # a line's confirmations side by side: its first promise (of first lines alone) and the later one
    said = F.filter(F.array(F.struct(F.col("cb").alias("day"), F.date_add("bedat", 2).cast("timestamp_ntz").alias("at")),
                            F.when(F.col("ln") == 1, F.struct(F.date_sub("cb", 6).alias("day"),
                                                              F.date_add("bedat", 1).cast("timestamp_ntz").alias("at")))),
                    lambda s: s.isNotNull())
    po_confirmation = conf_src.select(pv_id.alias("portal_vendor_id"), F.col("ebeln").alias("po_ref"),
                                      F.col("ebelp").alias("line_ref"), F.explode(said).alias("said")).select(
        "portal_vendor_id", "po_ref", "line_ref", F.col("said.day").alias("confirmed_delivery_date"),
        F.col("said.at").alias("confirmed_at"))

    gr_rows = li.filter(F.col("budat") < asof)
    goods_receipt = gr_rows.select(
        F.concat(F.lit("GR"), F.col("ok").cast("string"), F.lit("-"), F.col("ln").cast("string"), F.lit("-"),
                 F.col("seq").cast("string")).alias("mblnr"),
        "ebeln", "ebelp", F.col("seq").cast("int").alias("receipt_seq"), "budat",
        F.col("q").alias("menge"), F.lit("EA").alias("meins"))

    gate_rows = (gr_rows.filter(F.col("ebeln").isNotNull() & (F.col("p") != 4) & (F.col("pk") % 20 != 0))
                 .join(plant_b, F.col("p") == F.col("plant_idx")))
    ts_in = _ntz(F.col("arrival"), (6 + F.col("pk") % 15).cast("int"), (F.col("sk") % 60).cast("int"))
    asn = F.concat_ws("-", F.col("ebeln"), F.col("ebelp").cast("string"), F.col("seq").cast("string"))
    eid = F.concat(F.lit("EV"), F.col("ok").cast("string"), F.lit("-"), F.col("ln").cast("string"), F.lit("-"),
                   F.col("seq").cast("string"))
    gate_in = gate_rows.select(F.concat(eid, F.lit("-IN")).alias("event_id"), F.col("werks").alias("site_code"),
                               F.concat(F.col("werks"), F.lit("-G1")).alias("reader_id"),
                               F.lit("GATE_IN").alias("event_type"), asn.alias("asn_ref"),
                               local_to_utc(ts_in, F.col("time_zone")).alias("event_ts_utc"))
    gate_out = gate_rows.filter(F.col("pk") % 50 == 1).select(
        F.concat(eid, F.lit("-OUT")).alias("event_id"), F.col("werks").alias("site_code"),
        F.concat(F.col("werks"), F.lit("-G1")).alias("reader_id"), F.lit("GATE_OUT").alias("event_type"),
        asn.alias("asn_ref"),
        local_to_utc(ts_in + F.expr("INTERVAL 5 HOURS"), F.col("time_zone")).alias("event_ts_utc"))
    gate_event = gate_in.unionByName(gate_out)

    po_weight = lines.groupBy("ok", "ebeln").agg(
        F.sum((F.col("menge") * F.col("wt")).cast("decimal(28,6)")).cast("decimal(28,6)").alias("w"),
        F.max("has_receipt").alias("has_receipt"))
    inbound_freight = po_weight.filter("has_receipt").select(
        F.concat(F.lit("FI"), _pad(F.col("ok"))).alias("freight_invoice_no"), F.col("ebeln").alias("po_ref"),
        F.round(F.col("w") * F.when(F.col("ok") % 4 == 0, F.lit(0.18)).otherwise(F.lit(0.85)).cast("decimal(3,2)"), 2)
        .cast("decimal(18,2)").alias("freight_amount"),
        F.lit("USD").alias("currency"), F.lit("FCA").alias("incoterm"))

    shp_rows = (sold.filter(F.col(side).isNotNull() & (F.col("ship_date") < asof))
                .join(plant_b, F.col("p") == F.col("plant_idx")))
    shp_rows = costed(shp_rows, "pk", side, ["wt"]).withColumnRenamed("wt", "row_wt")
    is_box = F.col("p").isin(1, 2) & (F.col("pk") % 10 < 3)
    deliv_date = F.date_add("ship_date", _days(1 + F.col("sk") % 4))
    shipment = shp_rows.select(
        F.concat(F.lit("SH"), F.col("ok").cast("string"), F.lit("-"), F.col("ln").cast("string"), F.lit("-"),
                 F.col("seq").cast("string")).alias("shipment_id"),
        F.col("vbeln").alias("order_ref"), F.col("posnr").alias("order_line_ref"),
        _pick([c[0] for c in ref.CARRIERS], F.col("sk") % 8).alias("carrier_code"),
        F.col("werks").alias("origin_site"),
        _ntz(F.col("ship_date"), (8 + F.col("pk") % 16).cast("int"), 15).alias("ship_ts_local"),
        F.when(deliv_date >= asof, F.lit(None).cast("timestamp_ntz"))
        .otherwise(local_to_utc(_ntz(deliv_date, 10, 30), F.col("time_zone"))).alias("delivered_ts_utc"),
        F.when(is_box, F.col("q") * F.lit(0.1).cast("decimal(2,1)")).otherwise(F.col("q"))
        .cast("decimal(18,3)").alias("qty_shipped"),
        F.when(is_box, "BOX").otherwise("EA").alias("qty_uom"),
        F.round(F.col("q") * F.col("row_wt"), 2).cast("decimal(18,2)").alias("gross_weight_kg"),
        F.round(F.col("q") * F.col("row_wt") * (5 + F.col("ok") % 30).cast("decimal(4,0)"), 2)
        .cast("decimal(18,2)").alias("freight_amount"),
        F.col("local_currency").alias("freight_currency"),
        F.when(deliv_date >= asof, "PENDING").otherwise("POD").alias("pod_status"), *dealt)

    orders = read_driver(spark, sf_dir, "orders", "o_orderkey", "o_custkey")
    orders = orders.withColumn("o_number", F.concat(F.lit("45" if one_shuffle else "10"), _pad(F.col("o_orderkey"))))
    so_item = so_lines.join(orders, (F.col(side) == F.col("o_number")) & (F.col("ok") == F.col("o_orderkey"))).select(
        "vbeln", "posnr",
        F.concat(F.lit("C"), _pad(F.col("o_custkey"))).alias("kunnr"), "matnr", "werks",
        F.col("menge").alias("kwmeng"), F.lit("EA").alias("vrkme"),
        F.round(F.col("cost") * F.lit(1.35).cast("decimal(3,2)"), 2).cast("decimal(18,4)").alias("netpr_usd"),
        F.date_sub("cm", _days(5 + F.col("ok") % 17)).alias("audat"), F.col("cm").alias("edatu"), "gi_qty",
        *dealt, *([F.col(side).alias("_order")] if far else []))

    # Month-end stock for every (plant, part) pair that shipped: spine x pairs.
    # Pairs are dealt by part before they multiply, so joins and windows over it leave the snapshots where they are.
    pairs = (sold.filter(F.col(side).isNotNull() & (F.col("ship_date") < asof)).select("p", "pk1").distinct()
             .join(plant_b, F.col("p") == F.col("plant_idx"))
             .select(F.col("werks").alias("site_code"), F.concat(F.lit("M"), _pad(F.col("pk1"))).alias("sku"), "p", "pk1")
             .repartition("sku"))
    snaps = month_end_spine(spark, as_of, SNAPSHOT_MONTHS)
    mon = F.month("snapshot_date")
    inventory_snapshot = pairs.crossJoin(F.broadcast(snaps)).select(
        "snapshot_date", "site_code", "sku",
        F.pmod(13 * F.col("pk1") + 7 * mon + F.col("p"), F.lit(50)).cast("decimal(18,3)").alias("on_hand_qty"),
        F.pmod(5 * F.col("pk1") + mon, F.lit(31)).cast("decimal(18,3)").alias("in_transit_qty"),
        F.lit("EA").alias("uom"))

    return RawSources(plant=plant.drop("plant_idx"), fx_rate=fx_rates(spark, read_driver(spark, sf_dir, "lineitem", "l_shipdate").select(F.to_date("l_shipdate").alias("day")), as_of), vendor=vendor,
                      portal_vendor=portal_vendor, material=material, customer=customer,
                      carrier=carrier.drop("carrier_idx"), duty_rate=duty_rate, po_item=po_item,
                      po_confirmation=po_confirmation, goods_receipt=goods_receipt, gate_event=gate_event,
                      inbound_freight=inbound_freight, shipment=shipment, so_item=so_item,
                      inventory_snapshot=inventory_snapshot)
