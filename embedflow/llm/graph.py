"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(u, v)``; root is the component's smallest node.

    Each round joins every node's smallest neighbour to its edges (aggregates and equi-joins only, so a
    hub is combined before the shuffle and split by the skew join) and is cut by a reliable checkpoint.
    Rounds grow with the logarithm of the component size; it ends when a round changes no edge.  Null
    ends and loops carry no link and are dropped; an empty table gives an empty table.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    high, low = F.greatest("u", "v"), F.least("u", "v")
    now = edges.where("u <> v").select(high.alias("u"), low.alias("v")).distinct().checkpoint()
    seen = _mark(now)
    while seen[0]:
        now = _small_star(_large_star(now)).distinct().checkpoint()
        mark = _mark(now)
        if mark == seen:
            break
        seen = mark
    roots = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free sum of their hashes."""
    return tuple(edges.agg(F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v"))
