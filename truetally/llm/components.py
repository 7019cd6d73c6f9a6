"""Connected components of an edge table, entirely as joins and aggregations.

Hook and contract: every node that is the larger end of an edge hooks to its
smallest neighbour; hooks strictly decrease, so they form trees, which pointer
doubling flattens; then the edges are contracted to the roots. Each round is
written to the shared folder, so lineage stays short.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from truetally.llm.common import written, written_counting


def _flatten(parent: DataFrame) -> DataFrame:
    """(node, root) from (node, root) hooks whose targets may hook on, by pointer doubling."""
    moved = 1
    while moved:
        up = parent.select(F.col("node").alias("root"), F.col("root").alias("above"))
        parent, moved = written_counting(
            parent.join(up, "root", "left").select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")),
            "hooks", F.col("moved"))
        parent = parent.drop("moved")
    return parent


def _follow(df: DataFrame, hooks: DataFrame, *columns: str) -> DataFrame:
    """``df`` with nodes in ``columns`` replaced by their roots."""
    for c in columns:
        up = hooks.select(F.col("node").alias(c), F.col("root").alias("_above"))
        df = df.join(up, c, "left").withColumn(c, F.coalesce("_above", c)).drop("_above")
    return df


def components(edges: DataFrame, a: str = "a", b: str = "b", known: DataFrame | None = None) -> DataFrame:
    """(node, root) for every node of ``edges``; the root is the smallest node that can be reached.

    ``known``: components (node, root) of earlier edges, which these edges are
    added to; then only the contracted edges are worked on. Self-loops and
    repeated edges are allowed; nulls are ignored.
    """
    pairs = edges.select(F.col(a).alias("x"), F.col(b).alias("y"))
    nodes = pairs.select(F.col("x").alias("node")).unionByName(pairs.select(F.col("y").alias("node"))).where("node is not null")
    roots = nodes.distinct().select("node", F.col("node").alias("root"))
    if known is not None:
        fresh = nodes.distinct().join(known.select("node"), "node", "left_anti")
        roots = known.unionByName(fresh.select("node", F.col("node").alias("root")))
        pairs = _follow(pairs, known, "x", "y")
    lower = lambda df: (df.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
                        .where("x < y").distinct())
    live, left = written_counting(lower(pairs), "edges")
    while left:
        hooks = _flatten(written(live.groupBy(F.col("y").alias("node")).agg(F.min("x").alias("root")), "hooks"))
        roots = written(_follow(roots, hooks, "root"), "roots")
        live, left = written_counting(lower(_follow(live, hooks, "x", "y")), "edges")
    return roots.select("node", "root")
