"""Running totals and the first date a running total reaches a target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """SUM(value) OVER (PARTITION BY keys ORDER BY order ROWS UNBOUNDED PRECEDING)."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(value).over(w))


def first_reach_date(events: DataFrame, keys: Sequence[str], date: str, qty: str, targets: DataFrame,
                     target: str, out: str) -> DataFrame:
    """First ``date`` at which the running sum of ``qty`` per key reaches ``target``.

    Equal to ``MIN(IFF(cum >= target, date, NULL))`` over a row-level running sum
    ordered by (date, any tie-break) when quantities are non-negative: the
    running sum is monotone, so only its value at the end of each date matters.
    Events are therefore pre-aggregated per (key, date) first (map-side
    combine), and the window runs over at most one row per key and day -- a
    key holding a third of all rows still yields only one row per day.

    Returns ``keys + [out]`` for keys present in ``events`` (null when never reached).
    """
    daily = events.groupBy(*keys, date).agg(F.sum(qty).alias("_day_qty"))
    w = Window.partitionBy(*keys).orderBy(date).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cum = daily.withColumn("_cum", F.sum("_day_qty").over(w))
    j = cum.join(targets.select(*keys, target), list(keys))
    return j.groupBy(*keys).agg(F.min(F.when(F.col("_cum") >= F.col(target), F.col(date))).alias(out))
