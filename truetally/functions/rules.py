"""Business-rule expressions applied once in the conformed layer."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def classify_window(actual, promised, early: int, late: int, as_of: dt.date) -> dict[str, Column]:
    """Tolerance-window classification of a full-receipt date.

    due      : promised + late < as_of (strict)
    in_window: actual in [promised - early, promised + late] (closed)
    status   : NOT_YET_DUE | ON_TIME | OPEN_OVERDUE | EARLY | LATE
    days_late: actual - promised (null when never complete)
    """
    a, p = _col(actual), _col(promised)
    lo, hi = F.date_sub(p, early), F.date_add(p, late)
    due = hi < F.lit(as_of)
    within = a.isNotNull() & a.between(lo, hi)
    status = (F.when(~due, "NOT_YET_DUE").when(within, "ON_TIME").when(a.isNull(), "OPEN_OVERDUE")
              .when(a < lo, "EARLY").otherwise("LATE"))
    return {"is_due": due, "within_window": within, "delivery_status": status,
            "days_late": F.datediff(a, p)}


def order_line_rules(commit, order_qty, shipped, shipped_by_commit, delivered_by_commit,
                     as_of: dt.date) -> dict[str, Column]:
    """Due flags, capped due units and the 5-way line status of a sales line."""
    c, q = _col(commit), _col(order_qty)
    s, sbc, dbc = _col(shipped), _col(shipped_by_commit), _col(delivered_by_commit)
    due = c < F.lit(as_of)
    zero = F.lit(0).cast("decimal(18,3)")
    return {
        "is_due": due,
        "due_line_flag": F.when(due, 1).otherwise(0),
        "due_order_qty_ea": F.when(due, q).otherwise(zero).cast("decimal(18,3)"),
        "due_shipped_by_commit_qty_ea": F.when(due, F.least(sbc, q)).otherwise(zero).cast("decimal(18,3)"),
        "due_line_filled_flag": F.when(due & (sbc >= q), 1).otherwise(0),
        "due_line_on_time_flag": F.when(due & (dbc >= q), 1).otherwise(0),
        "line_status": (F.when(~due, "NOT_YET_DUE").when(dbc >= q, "DELIVERED_ON_TIME")
                        .when(s == 0, "NOT_SHIPPED").when(s < q, "SHORT_OR_PARTIAL").otherwise("DELIVERED_LATE")),
    }


def landed_cost_parts(goods_usd, duty_pct, insurance_pct) -> dict[str, Column]:
    """Duty and insurance, each rounded to cents from goods value (exact decimals)."""
    g = _col(goods_usd)
    pct = F.lit(0.01).cast("decimal(3,2)")
    return {
        "duty_usd": F.round(g * _col(duty_pct) * pct, 2).cast("decimal(18,2)"),
        "insurance_usd": F.round(g * F.lit(insurance_pct).cast("decimal(18,4)") * pct, 2).cast("decimal(18,2)"),
    }
