"""Which dimension of one table is which of the other: recovery of a shuffled dimension order.

A dimension's signature is the count and the sum of hashes of (id, value) over all rows, which needs no
order and adds up in every task.  Two tables with the same rows under a permutation of dimensions have the
same signatures, permuted; a one-to-one match of signatures is that permutation.  Equal dimensions (such as
ones that are zero everywhere) are interchangeable and matched in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .joins import null_safe_join


def dimension_signatures(df: DataFrame, vector: str = "vector", id_col: str = "id") -> DataFrame:
    """``dim, n, sig_a, sig_b``: a row per dimension, from one aggregate over (id, value) pairs.

    Values count by their float bits, but -0.0 as 0.0; null elements count as a value of their own.
    """
    value = F.col("x") + F.lit(0.0).cast("float")
    each = df.select(F.col(id_col).alias("id"), F.posexplode(F.col(vector).cast("array<float>")).alias("dim", "x")).select("id", "dim", value.alias("x"))
    part = lambda seed: F.sum(F.xxhash64(F.lit(seed), "id", "x").cast("decimal(20,0)"))
    return each.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), part(1).alias("sig_a"), part(2).alias("sig_b"))


def recover_dimension_order(source: DataFrame, target: DataFrame, common_ids: bool = True) -> DataFrame:
    """``source_dim, target_dim, verdict``: the permutation, or one row without dimensions and with ``none``.

    verdict is ``same`` if every dimension stands where it stood, else ``permuted``.  ``none``: some dimension
    of either side has no partner, as with unrelated vectors, other lengths, or values that differ in any
    bit.  With ``common_ids`` only ids that both sides have are compared.  Null ids are one id.  Two empty
    tables give no rows but ``none``.
    """
    if common_ids:
        s_ids, t_ids = source.select("id").distinct(), target.select("id").distinct()
        source, target = null_safe_join(source, t_ids, ["id"], "left_semi"), null_safe_join(target, s_ids, ["id"], "left_semi")
    sig = ["n", "sig_a", "sig_b"]
    # Rows of a signature are as many as dimensions share it; all of them together are one row a dimension.
    ranked = lambda df, name: dimension_signatures(df).withColumn("nth", F.row_number().over(Window.partitionBy(*sig).orderBy("dim"))).withColumnRenamed("dim", name)
    met = ranked(source, "source_dim").join(ranked(target, "target_dim"), [*sig, "nth"], "full_outer")
    one = met.agg(
        F.sort_array(F.collect_list(F.struct("source_dim", "target_dim"))).alias("pairs"),
        F.coalesce(F.bool_and(F.col("source_dim").isNotNull() & F.col("target_dim").isNotNull()), F.lit(False)).alias("whole"),
        F.coalesce(F.bool_and(F.col("source_dim") == F.col("target_dim")), F.lit(False)).alias("same"),
    )
    none = F.array(F.struct(F.lit(None).cast("int").alias("source_dim"), F.lit(None).cast("int").alias("target_dim")))
    verdict = F.when(~F.col("whole"), "none").when(F.col("same"), "same").otherwise("permuted")
    chosen = F.when(F.col("whole"), F.col("pairs")).otherwise(none)
    return one.select(verdict.alias("verdict"), F.explode(chosen).alias("p")).select("p.source_dim", "p.target_dim", "verdict")


def reorder(target: DataFrame, order: DataFrame, vector: str = "vector") -> DataFrame:
    """``target`` with its dimensions back in the source's order, by a recovered permutation (a row per dimension)."""
    rows = sorted((r["source_dim"], r["target_dim"]) for r in order.collect() if r["source_dim"] is not None)
    if not rows:
        raise ValueError("there is no permutation to undo")
    at = F.array(*[F.lit(t + 1) for _, t in rows])
    return target.withColumn(vector, F.transform(at, lambda k: F.element_at(F.col(vector), k)))
