"""Trailing-window sums (range join) and latest-date flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def trailing_window_sum(anchors: DataFrame, events: DataFrame, keys: Sequence[str], anchor_date: str,
                        event_date: str, value: str, days: int, out: str, dealt: Sequence[str] = ()) -> DataFrame:
    """For each anchor row: SUM(value) of events with the same keys and
    ``anchor - days < event_date <= anchor`` (0 when none).

    Events are pre-aggregated per (keys, day) -- map-side combine, so a hot key
    shrinks to one row per day -- then unioned with the anchor rows (which
    keep all their columns) and one sliding RANGE frame of ``days`` days over
    the day number gives the window sum at every anchor. The daily rows are
    dealt by ``keys``, or those of them in ``dealt``; anchors that are dealt so already stay where they are. No
    join back, no probe pairs; each key's window holds at most #days + #anchors
    rows. Events before the first anchor's window or after the last anchor count
    nowhere and are left out before they are shuffled (days unknown are kept).
    Equals :func:`trailing_window_sum_join`.
    """
    if days < 1:
        raise ValueError("days must be >= 1")
    keys = list(keys)
    ends = anchors.agg(F.date_sub(F.min(anchor_date), days).alias("_lo"), F.max(anchor_date).alias("_hi"))  # one row
    day = F.col(event_date)
    near = events.crossJoin(F.broadcast(ends)).filter(((day > F.col("_lo")) & (day <= F.col("_hi"))) | day.isNull())
    daily = near.groupBy(*keys, day.alias("_d")).agg(F.sum(value).alias("_v")).repartition(*(dealt or keys))
    anc = anchors.withColumns({"_d": F.col(anchor_date), "_v": F.lit(None).cast(daily.schema["_v"].dataType),
                               "_anchor": F.lit(True)})
    rows = anc.unionByName(daily.withColumn("_anchor", F.lit(False)), allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy(F.unix_date("_d")).rangeBetween(-(days - 1), 0)
    return (rows.withColumn(out, F.coalesce(F.sum("_v").over(w), F.lit(0).cast(daily.schema["_v"].dataType)))
            .filter(F.col("_anchor")).drop("_d", "_v", "_anchor"))


def trailing_window_sum_join(anchors: DataFrame, events: DataFrame, keys: Sequence[str], anchor_date: str,
                             event_date: str, value: str, days: int, out: str) -> DataFrame:
    """Same result as :func:`trailing_window_sum`, written as the reference's
    left range join (equi keys + date range), with events pre-aggregated per
    day. Kept as the simple form for tests and comparison."""
    keys = list(keys)
    daily = events.groupBy(*keys, F.col(event_date).alias("_d")).agg(F.sum(value).alias("_v"))
    a = anchors.select(*keys, anchor_date).distinct().alias("a")
    cond = [F.col(f"a.{k}") == F.col(f"e.{k}") for k in keys] + [
        F.col("e._d") > F.date_sub(F.col(f"a.{anchor_date}"), days), F.col("e._d") <= F.col(f"a.{anchor_date}")]
    per_anchor = (a.join(daily.alias("e"), cond, "left")
                  .groupBy(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{anchor_date}").alias(anchor_date))
                  .agg(F.coalesce(F.sum("e._v"), F.lit(0)).alias(out)))
    return anchors.join(per_anchor, keys + [anchor_date], "left").select(*anchors.columns, out)


def mark_latest(df: DataFrame, date_col: str, out: str) -> DataFrame:
    """``out = date_col = MAX(date_col)`` over the whole frame.

    A global MAX is a scalar aggregate (partial per task, one tiny final row)
    cross-joined back by broadcast -- not an unpartitioned window, which would
    pull every row into one task."""
    mx = df.agg(F.max(date_col).alias("_max_d"))
    return (df.crossJoin(F.broadcast(mx)).withColumn(out, F.col(date_col) == F.col("_max_d"))
            .drop("_max_d"))
