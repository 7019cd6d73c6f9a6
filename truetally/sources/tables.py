"""Typed tables: empty-with-schema, schema evolution, appends, defaults."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """CREATE TABLE IF NOT EXISTS ...: an empty frame with the declared schema."""
    return spark.createDataFrame([], schema)


def ensure_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """ADD COLUMN IF NOT EXISTS for every field of ``schema`` (typed NULLs),
    then order and cast the columns as declared. Extra columns are kept last."""
    have = set(df.columns)
    add = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}
    df = df.withColumns(add) if add else df
    declared = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    return df.select(*declared, *[c for c in df.columns if c not in {f.name for f in schema.fields}])


def with_defaults(df: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """Column defaults (e.g. current_timestamp(), the calling user) for rows
    that arrive without them."""
    return df.withColumns({c: F.coalesce(F.col(c), v) if c in df.columns else v for c, v in defaults.items()})


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """DELETE WHERE as a new version: rows for which ``predicate`` is true go; unknown (NULL) rows stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def append(df: DataFrame, path: str, schema: StructType | None = None) -> None:
    """INSERT INTO: append rows (schema-aligned when ``schema`` is given)."""
    (ensure_columns(df, schema).select(*[f.name for f in schema.fields]) if schema else df) \
        .write.mode("append").parquet(path)
