"""Proportional allocation of a header amount to lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def proportional_allocate(lines: DataFrame, totals: DataFrame, key: Sequence[str] | str, weight: str, amount: str,
                          out: str, eligible: str | None = None) -> DataFrame:
    """``out = amount * weight / sum(weight per key)``, unrounded, as DECIMAL(18,8).

    ``totals`` holds one ``amount`` per key (pre-aggregated header rows). The
    share is computed in double (a*b/c, same order as the oracle) and cast to
    DECIMAL(18,8); callers round it. Lines with ``eligible`` false get 0 --
    their share is *not* redistributed (the reference behaviour). The weight
    sum is a grouped aggregate joined back on the key (skew-safe), never a
    window over the key.
    """
    keys = [key] if isinstance(key, str) else list(key)
    wsum = lines.groupBy(*keys).agg(F.sum(weight).alias("_wsum"))
    j = lines.join(wsum, keys, "left").join(totals.select(*keys, amount), keys, "left")
    share = (F.coalesce(F.col(amount), F.lit(0)).cast("double") * F.col(weight).cast("double")
             / F.when(F.col("_wsum") == 0, None).otherwise(F.col("_wsum")).cast("double")).cast("decimal(18,8)")
    if eligible is not None:
        share = F.when(F.col(eligible), F.coalesce(share, F.lit(0))).otherwise(F.lit(0)).cast("decimal(18,8)")
    return j.withColumn(out, share).drop("_wsum", amount)
