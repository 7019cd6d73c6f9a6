"""Calendar spines, quarter bounds and labels."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quarter_start(d: dt.date) -> dt.date:
    return dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)


def add_months(d: dt.date, n: int) -> dt.date:
    m = d.year * 12 + (d.month - 1) + n
    return dt.date(m // 12, m % 12 + 1, 1)


def quarter_bounds(as_of: dt.date, offset: int = -1) -> tuple[dt.date, dt.date]:
    """Half-open [start, end) of the calendar quarter ``offset`` quarters from
    the one containing ``as_of``. ``offset=-1`` is the last complete quarter."""
    start = add_months(quarter_start(as_of), 3 * offset)
    return start, add_months(start, 3)


def period_bounds(period: str, as_of: dt.date) -> tuple[dt.date, dt.date]:
    if period in ("last_quarter", "previous_quarter"):
        return quarter_bounds(as_of, -1)
    if period == "this_quarter":
        return quarter_bounds(as_of, 0)
    raise ValueError(f"unknown period {period!r}")


def month_spine(spark: SparkSession, start, end) -> DataFrame:
    """First-of-month dates from month(start) to month(end), inclusive.

    ``start``/``end`` may be Python dates or Columns of a one-row frame."""
    s = F.lit(start) if isinstance(start, dt.date) else start
    e = F.lit(end) if isinstance(end, dt.date) else end
    return spark.range(1).select(F.explode(F.sequence(F.trunc(s, "month"), F.trunc(e, "month"),
                                                      F.expr("interval 1 month"))).alias("month_start"))


def month_spine_from(df: DataFrame, date_col: str) -> DataFrame:
    """Month spine covering the range of ``date_col`` in ``df`` (one global
    min/max aggregate, then an explode of a bounded sequence)."""
    b = df.agg(F.min(F.to_date(date_col)).alias("lo"), F.max(F.to_date(date_col)).alias("hi"))
    return b.select(F.explode(F.sequence(F.trunc("lo", "month"), F.trunc("hi", "month"),
                                         F.expr("interval 1 month"))).alias("month_start"))


def month_end_spine(spark: SparkSession, as_of: dt.date, n: int) -> DataFrame:
    """The last ``n`` month-ends strictly before the month of ``as_of``."""
    first = add_months(dt.date(as_of.year, as_of.month, 1), -n)
    last = add_months(dt.date(as_of.year, as_of.month, 1), -1)
    return month_spine(spark, first, last).select(F.last_day("month_start").alias("snapshot_date"))


def quarter_label(c) -> Column:
    """``YYYY-Qn``; null when the date is null (concat propagates nulls)."""
    c = _col(c)
    return F.concat(F.year(c).cast("string"), F.lit("-Q"), F.quarter(c).cast("string"))


def fiscal_quarter_label(c, fiscal_start_month: int = 4) -> Column:
    """``FYyyyy-Qn`` where the fiscal year starts in ``fiscal_start_month``
    and is named after the calendar year of (date - (start-1) months)."""
    shifted = F.add_months(_col(c), -(fiscal_start_month - 1))
    return F.concat(F.lit("FY"), F.year(shifted).cast("string"), F.lit("-Q"), F.quarter(shifted).cast("string"))


def with_calendar_labels(df: DataFrame, date_col: str, prefix: str, fiscal_start_month: int = 4) -> DataFrame:
    return df.withColumns({
        f"{prefix}_month": F.trunc(date_col, "month"),
        f"{prefix}_quarter": quarter_label(date_col),
        f"{prefix}_fiscal_quarter": fiscal_quarter_label(date_col, fiscal_start_month),
    })
