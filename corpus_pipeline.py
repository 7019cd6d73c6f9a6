"""Training-data pipeline: quality rules, line dedup, near-dedup, decontamination, tokenisation.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the result is
written as Parquet and read back as the next stage's ``docs``. All stages but
the last return the columns of ``docs``. Null texts fail the quality rules;
empty tables pass through; documents whose lines are all boilerplate stay with
an empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from truetally.llm.bpe import encode_documents
from truetally.llm.common import fresh, scratch, text_key
from truetally.llm.decontaminate import leaks
from truetally.llm.line_dedup import remove_boilerplate
from truetally.llm.near_dup import near_groups
from truetally.llm.quality import judge
from truetally.llm.queries import vocabulary


def _having(docs: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose key is among ``keys`` (or isn't)."""
    (key,) = fresh(docs, "_key")
    chosen = keys.select(F.col("_key").alias(key)).distinct()
    return docs.withColumn(key, text_key("doc_id", "text")).join(chosen, key, how).select(docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that it rejects go."""
    return _having(docs, judge(docs).where("kept"), "left_semi")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: boilerplate lines go from the texts; ``n_chars`` follows."""
    lines, removed = fresh(docs, "_n_lines", "_n_removed")
    out = remove_boilerplate(docs, counts=(lines, removed))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each near-duplicate group the document with the smallest id stays, once."""
    kept = _having(docs, near_groups(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id"))), "left_semi")
    key, row = fresh(docs, "_key", "_row")
    once = Window.partitionBy(key).orderBy(key)
    return (kept.withColumn(key, text_key("doc_id", "text")).withColumn(row, F.row_number().over(once))
            .where(F.col(row) == 1).select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents that overlap with a benchmark item go."""
    return _having(docs, leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), "left_anti")


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: token counts and digests of ids and decoded bytes."""
    return encode_documents(docs, vocabulary())


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("minhash_near_dedup", near_dedup),
          ("benchmark_decontamination", decontamination), ("byte_bpe", byte_bpe)]

#: The robust outlier rule isn't expressible in SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents`` of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
