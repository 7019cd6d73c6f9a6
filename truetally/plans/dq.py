"""Data-quality checks: sanity counts and row loss."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truetally.plans.conform import Conformed
from truetally.sources.driver import RawSources


def _n(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("check_name"), "n")


def dq_checks(raw: RawSources, conformed: Conformed) -> DataFrame:
    """(check_name, n): multi-id suppliers, unmapped PO lines, row counts,
    converted BOX legs and RAW table counts. Each is one partial count."""
    parts = [
        _n(conformed.dim_supplier.filter(F.col("source_record_count") > 2), "suppliers with >2 source ids"),
        dq_row_loss(raw, conformed).filter(F.col("check_name") == "po lines unmapped to golden supplier"),
        _n(conformed.fct_order_line, "order lines"),
        _n(conformed.fct_shipment.filter(F.col("source_uom") == "BOX"), "BOX shipments converted"),
    ] + [_n(df, f"raw rows: {name}") for name, df in raw.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def dq_row_loss(raw: RawSources, conformed: Conformed) -> DataFrame:
    """Rows dropped by inner joins (unmapped supplier, missing FX month)."""
    def loss(a, b, name):
        return (a.agg(F.count(F.lit(1)).alias("a")).crossJoin(b.agg(F.count(F.lit(1)).alias("b")))
                .select(F.lit(name).alias("check_name"), (F.col("a") - F.col("b")).alias("n")))
    return (loss(raw.po_item, conformed.fct_po_line, "po lines unmapped to golden supplier")
            .unionByName(loss(raw.shipment, conformed.fct_shipment, "shipment legs without FX or master data")))
