"""Operator 10: cross-site boilerplate lines by distinct-site spread.

A line is boilerplate when it stands on at least ``min_sites`` distinct sites.
Spread is estimated with one HyperLogLog sketch per line hash; sketches are
partial aggregates, so a line that a third of all documents share costs one
sketch per task. Lines whose estimate lies near the threshold are counted
exactly. Boilerplate is removed everywhere but in the document with the
smallest id that holds it, so no text vanishes from the corpus.

Defined cases: lines are split at ``\\n`` and compared exactly; a line without
anything but spaces is never removed; a null text has no lines and stays null;
a null site counts as one site of its own; documents with a null id never are
the first holder, and where only such documents hold a line it stays; rows that
repeat id and text are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from truetally.llm.common import fresh, small_side, text_key, written

MIN_SITES = 5
LG_K = 12
#: Lines near the threshold that are broadcast at most (32 bytes each).
UNSURE_ROWS = 100_000


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _line_key(line: Column) -> list[Column]:
    """128 bits: two hashes with different seeds."""
    return [F.xxhash64(line).alias("_l1"), F.xxhash64(F.lit("line"), line).alias("_l2")]


def boilerplate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                      min_sites: int = MIN_SITES, lg_k: int = LG_K, near: float = 0.25) -> DataFrame:
    """(_l1, _l2, _first, _sites) of every line on at least ``min_sites`` sites.

    ``near``: estimates within this share of the threshold (at least 2 sites)
    are replaced by exact distinct counts.
    """
    each = (docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("_site"),
                        F.explode(_lines(F.col(text_col))).alias("_line"))
            .where(F.trim("_line") != "")
            .select("_id", "_site", *_line_key(F.col("_line"))))
    gap = max(2.0, near * min_sites)
    spread = (each.groupBy("_l1", "_l2")
              .agg(F.hll_sketch_agg("_site", F.lit(lg_k)).alias("_sketch"), F.min("_id").alias("_first"))
              .withColumn("_est", F.hll_sketch_estimate("_sketch")).drop("_sketch")
              .where(F.col("_est") >= min_sites - gap))
    spread = written(spread, "line-spread")
    sure = spread.where(F.col("_est") > min_sites + gap).select("_l1", "_l2", "_first", F.col("_est").alias("_sites"))
    unsure = spread.where(F.col("_est") <= min_sites + gap).select("_l1", "_l2", "_first")
    pairs, few = each.select("_l1", "_l2", "_site"), small_side(unsure, UNSURE_ROWS)
    # few unsure lines go to the lines; else a line's sites are made distinct before they meet at its key
    sites = pairs.join(few, ["_l1", "_l2"]) if few is not unsure else pairs.distinct().join(unsure, ["_l1", "_l2"])
    exact = (sites.groupBy("_l1", "_l2", "_first", "_site").agg(F.lit(1).alias("_one"))
             .groupBy("_l1", "_l2", "_first").agg(F.count("_site").alias("_sites"))
             .where(F.col("_sites") >= min_sites))
    return written(sure.unionByName(exact), "boilerplate-lines")


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                       min_sites: int = MIN_SITES, counts: tuple[str, str] = ("_n_lines", "_n_removed")) -> DataFrame:
    """``docs`` with boilerplate lines cut from the text, plus the columns ``counts``: lines, and removed ones.

    All columns of ``docs`` are kept under their names; one that is called like
    a count is replaced by it.
    """
    marked = boilerplate_lines(docs, id_col, text_col, site_col, min_sites)
    lines = _lines(F.col(text_col))
    key, cut_, all_, edges_ = fresh(docs, "_key", "_cut", "_all", "_edges")
    hits = (docs.select(text_key(id_col, text_col).alias(key), F.col(id_col).alias("_id"),
                        F.posexplode(lines).alias("_pos", "_line"))
            .where(F.trim("_line") != "")
            .select(key, "_id", "_pos", *_line_key(F.col("_line")))
            .join(marked, ["_l1", "_l2"])
            .where(~F.col("_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull())
            .groupBy(key).agg(F.sort_array(F.collect_set("_pos")).alias(cut_)))
    # A cursor over the sorted cut positions would need state; a map of runs is linear:
    # the text is rebuilt from the slices between consecutive cuts.
    cut, every = F.col(cut_), F.col(all_)
    edges = F.concat(F.array(F.lit(-1)), cut, F.array(F.size(every)))
    kept = F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(cut)),
        lambda i: F.slice(every, F.get(edges_, i) + 2, F.get(edges_, i + 1) - F.get(edges_, i) - 1)))
    joined = docs.withColumn(key, text_key(id_col, text_col)).join(hits, key, "left").withColumn(all_, lines)
    return (joined.withColumn(edges_, F.when(cut.isNotNull(), edges))
            .withColumn(text_col, F.when(cut.isNotNull(), F.array_join(kept, "\n")).otherwise(F.col(text_col)))
            .withColumn(counts[0], F.when(every.isNull(), F.lit(0)).otherwise(F.size(every)).cast("long"))
            .withColumn(counts[1], F.when(cut.isNull(), F.lit(0)).otherwise(F.size(cut)).cast("long"))
            .drop(key, cut_, all_, edges_))
