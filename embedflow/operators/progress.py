"""Running totals, latest state and exact nearest-rank percentiles that scale with hot groups.

* ``running_sum`` is a two-level prefix sum: totals per (group, chunk of the
  order key) → a prefix over chunks (1/chunk of the rows) → a window inside
  each (group, chunk), which holds at most ``chunk`` rows.  A job with a
  third of all batches is spread over many tasks.
* ``latest`` is max_by over a struct: a partial aggregate.
* ``nearest_rank`` numbers rows with operators.batching.number_rows (range
  partitioning, no single-task window), so the k-th value of a hot group is
  found without sorting that group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .batching import number_rows
from .joins import null_safe_join


def running_sum(df: DataFrame, group: str, order: str, values: list[str], chunk: int = 4096) -> DataFrame:
    """Adds ``cum_<v>`` = sum of v over rows of the group with order <= this row's (order must be unique in a group).

    A null group is a group, and a null order comes first in it.
    """
    c = df.withColumn("_chunk", F.floor(F.col(order) / F.lit(chunk)))
    per_chunk = c.groupBy(group, "_chunk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    before = Window.partitionBy(group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_chunk.select(
        group, "_chunk", *[F.coalesce(F.sum(f"_t_{v}").over(before), F.lit(0)).alias(f"_o_{v}") for v in values]
    )
    inside = Window.partitionBy(group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    out = null_safe_join(c, offsets, [group, "_chunk"])
    for v in values:
        out = out.withColumn(f"cum_{v}", F.col(f"_o_{v}") + F.sum(v).over(inside))
    return out.drop("_chunk", *[f"_o_{v}" for v in values])


def latest(df: DataFrame, group: str, by: list[str]) -> DataFrame:
    """The row with the largest ``by`` per group (last write wins)."""
    cols = [c for c in df.columns if c != group]
    picked = df.groupBy(group).agg(F.max_by(F.struct(*cols), F.struct(*[F.col(b) for b in by])).alias("_r"))
    return picked.select(group, *[F.col(f"_r.{c}").alias(c) for c in cols])


def nearest_rank(df: DataFrame, group: str, value: str, percents: list[float], tie: str | None = None) -> DataFrame:
    """group, n, p<pct> = sorted[min(floor(n·pct/100), n-1)] per group (0-based), exact.

    Rows are numbered in (group, value, tie) order without a per-group sort;
    each group's target row numbers (start + k, one per percentile) are then
    joined on rn, so only the selected rows travel further.  A null group is a
    group; null values come first in theirs.
    """
    order = [group, value] + ([tie] if tie else [])
    numbered = number_rows(df.select(*dict.fromkeys(order)), order)
    starts = numbered.groupBy(group).agg(F.min("rn").alias("_start"), F.count("*").alias("n"))
    targets = starts.select(
        group,
        "n",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(f"p{p:g}").alias("pct"),
                        (F.col("_start") + F.least(F.floor(F.col("n") * F.lit(p) / F.lit(100.0)), F.col("n") - 1)).alias("_rn"),
                    )
                    for p in percents
                ]
            )
        ).alias("t"),
    ).select(group, "n", "t.pct", F.col("t._rn").alias("rn"))
    picked = targets.join(numbered.select("rn", value), "rn")
    return picked.groupBy(group, "n").agg(*[F.max(F.when(F.col("pct") == f"p{p:g}", F.col(value))).alias(f"p{p:g}") for p in percents])
