"""Hierarchical reconciliation: two tables are compared by a tree of digests, and row by row only where it differs.

Every row belongs to a leaf, a hash bucket of its id.  A leaf's digest is the row count and the sums of four
64-bit parts of the rows' digests (id, every vector bit, metadata): additive, so tasks add up their own rows
and one aggregate per side yields all leaves, whatever order rows come in.  A node's digest is the sum of its
children's.  Equal roots settle the whole table; otherwise only children of differing nodes are compared, and
the rows of differing leaves alone are read again and joined, vectors and all, by ``reconcile``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.digest import with_row_digests
from ..session import scratch_path
from .reconcile import reconcile

LEAVES, FANOUT = 4096, 16
_PARTS = [f"s{i}" for i in range(4)]
_NODE = ["n", *_PARTS]
#: Differing leaves whose numbers are broadcast; beyond that they are joined by a shuffle.
MAX_BROADCAST_LEAVES = 100_000


def leaf_of(leaves: int):
    return F.pmod(F.xxhash64("id"), F.lit(leaves)).cast("int")


def leaf_digests(df: DataFrame, leaves: int = LEAVES) -> DataFrame:
    """``leaf, n, s0..s3`` of the leaves that have rows; ``df`` has id, vector and metadata.

    A null id is an id like any other.  The sums are 64-bit parts as decimals, so they don't overflow.
    """
    rows = df.select("id", "vector", "metadata").withColumn("leaf", leaf_of(leaves))
    digests = with_row_digests(rows, ["leaf"], out="rd")
    part = lambda i: F.conv(F.substring("rd", 16 * i + 1, 16), 16, 10).cast("decimal(20,0)")
    return digests.groupBy("leaf").agg(F.count("*").alias("n"), *[F.sum(part(i)).alias(f"s{i}") for i in range(4)])


@dataclass
class DigestTree:
    """A table's leaves, written once, and the levels above them, which are sums of the leaves."""

    leaf_table: DataFrame
    leaves: int
    fanout: int = FANOUT

    @classmethod
    def build(cls, df: DataFrame, leaves: int = LEAVES, fanout: int = FANOUT) -> "DigestTree":
        spark = df.sparkSession
        made, path = leaf_digests(df, leaves), scratch_path(spark, "digest-leaves")
        made.write.parquet(path)
        return cls(spark.read.schema(made.schema).parquet(path), leaves, fanout)

    def levels(self) -> list[int]:
        """Leaves under a node of each level, from the root's children down to 1."""
        out = [1]
        while out[-1] * self.fanout < self.leaves:
            out.append(out[-1] * self.fanout)
        return out[::-1]

    def nodes(self, width: int, under: DataFrame | None = None) -> DataFrame:
        """``node, n, s0..s3`` of the nodes that are ``width`` leaves wide, of those below ``under(leaf)``'s only."""
        rows = self.leaf_table
        if under is not None:
            rows = rows.join(F.broadcast(under), "leaf", "left_semi")  # bounded by the number of leaves
        return rows.groupBy(F.floor(F.col("leaf") / width).cast("int").alias("node")).agg(*[F.sum(c).alias(c) for c in _NODE])


def differing_leaves(a: DigestTree, b: DigestTree) -> tuple[list[int], list[int]]:
    """Numbers of the leaves that differ, and how many nodes were compared on each level on the way down.

    What comes to the driver are the numbers of differing nodes, at most the number of leaves.
    """
    if (a.leaves, a.fanout) != (b.leaves, b.fanout):
        raise ValueError("trees of different shapes can't be compared")
    spark = a.leaf_table.sparkSession
    differing, compared, width_above = [0], [1], a.leaves
    root = [t.leaf_table.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _NODE]).first() for t in (a, b)]
    if tuple(root[0]) == tuple(root[1]):
        return [], compared
    for width in a.levels():
        children = width_above // width if width_above < a.leaves else -(-a.leaves // width)
        below = [c for d in differing for c in range(d * children, (d + 1) * children) if c * width < a.leaves]
        under = None
        if len(below) * width < a.leaves:
            leaves = spark.createDataFrame([(leaf,) for c in below for leaf in range(c * width, min((c + 1) * width, a.leaves))], "leaf int")
            under = leaves
        left, right = (t.nodes(width, under) for t in (a, b))
        on = left.alias("x").join(right.alias("y"), "node", "full_outer")
        same = F.lit(True)
        for c in _NODE:
            same = same & F.col(f"x.{c}").eqNullSafe(F.col(f"y.{c}"))
        differing = sorted(r["node"] for r in on.where(~same).select("node").collect())
        compared.append(len(below))
        width_above = width
    return differing, compared


@dataclass
class TreeReport:
    """What a comparison took."""

    leaves: int
    differing: int
    compared: list[int]


def tree_reconcile(source: DataFrame, target: DataFrame, leaves: int = LEAVES, fanout: int = FANOUT, atol: float = 0.0, rtol: float = 0.0) -> tuple[DataFrame, TreeReport]:
    """The statuses of :func:`reconcile`, and how much of the tree was looked at.

    Rows of equal leaves match, or are duplicates where the source repeats their id: that takes a count of
    ids, no vectors.  Vectors that are equal bit for bit match, NaN among them (``reconcile`` calls NaN
    different); -0.0 and 0.0, and what a tolerance allows, are told apart by digests and then found equal row
    by row.
    """
    trees = [DigestTree.build(df, leaves, fanout) for df in (source, target)]
    differing, compared = differing_leaves(*trees)
    spark = source.sparkSession
    named = spark.createDataFrame([(x,) for x in differing], "leaf int")
    small = F.broadcast(named) if len(differing) <= MAX_BROADCAST_LEAVES else named
    inside = lambda df: df.select("id", "vector", "metadata").withColumn("leaf", leaf_of(leaves)).join(small, "leaf", "left_semi").drop("leaf")
    rows = reconcile(inside(source), inside(target), atol, rtol)
    equal = source.select("id").withColumn("leaf", leaf_of(leaves)).join(small, "leaf", "left_anti")
    counted = equal.groupBy("id").agg(F.count("*").alias("n"))
    settled = counted.select("id", F.when(F.col("n") > 1, "duplicate").otherwise("match").alias("status"))
    return rows.unionByName(settled), TreeReport(leaves, len(differing), compared)


