"""Fixed-size batches in key order without a global single-partition window.

Plan (``number_rows``):
  1. rows: repartitionByRange(n, order) + sortWithinPartitions; the
     partition id and the index inside the partition (low 33 bits of
     monotonically_increasing_id) are attached and the rows are written
     once to the shared scratch folder.  Spark's range sample is seeded by
     RDD id, so without writing a second pass could draw other boundaries;
     the table also survives executor loss.
  2. rows per partition (n rows) → first row number of each partition.
  3. rn = first + index, joined by partition id (a broadcast of n rows).

Row and number stay together throughout, so repeated or null keys keep
their rows; ties are in no particular order.  Select only the columns you
need before numbering: all of them are written and shuffled once.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def _n_ranges(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def number_rows(df: DataFrame, order: list[str], n_ranges: int | None = None, stats: dict | None = None) -> DataFrame:
    """Add ``rn`` (0-based BIGINT) = position of the row in ``order``.

    ``stats``, if given, receives {"rows": total, "ranges": n}.
    """
    spark, n = df.sparkSession, _n_ranges(df, n_ranges)
    keys = [F.col(c) for c in order]
    pid = F.spark_partition_id()
    ranged = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_pid", pid)
        .withColumn("_local", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33))
    )
    path = scratch_path(spark, "numbered")
    ranged.write.parquet(path)
    pinned = spark.read.schema(ranged.schema).parquet(path)
    first, run = [], 0
    for r in sorted(pinned.groupBy("_pid").count().collect(), key=lambda r: r["_pid"]):  # one row per range
        first.append((r["_pid"], run))
        run += r["count"]
    if stats is not None:
        stats.update(rows=run, ranges=n)
    pids, firsts = zip(*first) if first else ((), ())  # an Arrow table: of a list, createDataFrame makes a job in Python workers
    starts = spark.createDataFrame(pa.table({"_pid": pa.array(pids, pa.int32()), "_first": pa.array(firsts, pa.int64())}))
    numbered = pinned.join(F.broadcast(starts), "_pid")  # n_ranges rows
    return numbered.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_first") + F.col("_local")).alias("rn"))


def number_keys(df: DataFrame, order: list[str], n_ranges: int | None = None, stats: dict | None = None) -> DataFrame:
    """``number_rows`` of the order columns alone."""
    return number_rows(df.select(*order), order, n_ranges, stats)


def assign_batches(
    df: DataFrame,
    batch_size: int,
    order: list[str] | None = None,
    n_ranges: int | None = None,
    group: str | None = None,
    stats: dict | None = None,
) -> DataFrame:
    """Add ``batch_id`` and ``pos`` (position inside the batch) in ``order`` (default id).

    With ``group``, batches restart in every group (e.g. one job per
    namespace): rows are numbered in (group, order) and each group's first
    row number (one row per group) is subtracted.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    order = order or ["id"]
    if group is None:
        numbered = number_rows(df, order, n_ranges, stats)
    else:
        numbered = number_rows(df, [group] + order, n_ranges, stats)
        starts = numbered.groupBy(F.col(group).alias("_group")).agg(F.min("rn").alias("_start"))
        numbered = numbered.join(starts, F.col(group).eqNullSafe(F.col("_group")))  # a null group is one, too
        numbered = numbered.withColumn("rn", F.col("rn") - F.col("_start")).drop("_group", "_start")
    return (
        numbered.withColumn("batch_id", F.floor(F.col("rn") / F.lit(batch_size)).cast("bigint"))
        .withColumn("pos", (F.col("rn") % F.lit(batch_size)).cast("bigint"))
    )


def hash_batches(df: DataFrame, n_batches: int, key: str = "id") -> DataFrame:
    """Content-based batch_id = pmod(xxhash64(key), n_batches): stable across retries and re-runs."""
    return df.withColumn("batch_id", F.pmod(F.xxhash64(F.col(key)), F.lit(n_batches)).cast("bigint"))
