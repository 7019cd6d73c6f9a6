"""Value resolution with lineage, and FX conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def resolve_first(df: DataFrame, candidates: Sequence[tuple[Column | str, str]], out: str,
                  source_out: str | None = None) -> DataFrame:
    """``out`` = first non-null candidate; ``source_out`` = its label.

    e.g. confirmed date = portal confirmation else requested date, or arrival =
    gate read else goods-receipt posting."""
    cols = [F.col(c) if isinstance(c, str) else c for c, _ in candidates]
    df = df.withColumn(out, F.coalesce(*cols))
    if source_out:
        label = None
        for c, (_, name) in reversed(list(zip(cols, candidates))):
            label = F.when(c.isNotNull(), F.lit(name)) if label is None else F.when(c.isNotNull(), F.lit(name)).otherwise(label)
        df = df.withColumn(source_out, label)
    return df


def fx_convert(df: DataFrame, rates: DataFrame, currency: str, date: Column | str, out_rate: str = "usd_per_unit",
               how: str = "inner") -> DataFrame:
    """Join the monthly USD rate of ``date``'s month for ``currency``.

    Spark sizes the rate table and broadcasts it while it is small. With
    ``how='inner'`` a missing month drops the row (the reference behaviour,
    counted by ``dq_row_loss``)."""
    d = F.col(date) if isinstance(date, str) else date
    r = rates.select(F.col("currency").alias("_fx_cur"), F.col("month_start").alias("_fx_month"),
                     F.col("usd_per_unit").alias(out_rate))
    return (df.join(r, (F.col(currency) == F.col("_fx_cur")) & (F.trunc(d, "month") == F.col("_fx_month")),
                    how).drop("_fx_cur", "_fx_month"))
