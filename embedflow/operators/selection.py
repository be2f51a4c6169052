"""Exact order statistics by selection: histograms over the bits of the value, refined where the rank lies.

A value's bits, flipped so that they order as the value does, are read 16 at a time.  One pass counts the
rows per group and digit; the digit whose cumulative count reaches a rank is the next part of that rank's
value, and the next pass counts only rows that begin with the digits known so far.  Four passes settle 64
bits.  Nothing is sorted, numbered or written: a pass is a scan and a partial aggregate, so a hot group costs
no more than its digits' counts.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .joins import null_safe_join

DIGIT_BITS, DIGITS = 16, 4
#: Groups times percentiles whose known digits are broadcast; more are joined by a shuffle.
MAX_BROADCAST_TARGETS = 200_000
#: The bits that stand for every NaN.
NAN_KEY = 0x7FF8000000000000
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


@F.pandas_udf(T.LongType())
def _double_bits(v: pd.Series) -> pd.Series:
    """Bits of a double as a whole number of the same order; -0.0 as 0.0, every NaN as the largest."""
    x = v.to_numpy(dtype=np.float64, na_value=np.nan) + 0.0
    bits = np.where(np.isnan(x), np.float64("nan"), x).view(np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits))


@F.pandas_udf(T.DoubleType())
def _bits_double(key: pd.Series) -> pd.Series:
    bits = key.to_numpy(dtype=np.int64)
    return pd.Series(np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits).view(np.float64))


def _encoded(kind: T.DataType, value: Column) -> Column:
    if isinstance(kind, _WHOLE):
        return value.cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_bits(value.cast("double"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    raise ValueError(f"values of type {kind.simpleString()} can't be selected by their bits")


def _decoded(kind: T.DataType, key: Column) -> Column:
    if isinstance(kind, _WHOLE):
        return key.cast(kind)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(key)
    # a NaN that a pandas function returns would be a null
    return F.when(key == NAN_KEY, F.lit(float("nan"))).otherwise(_bits_double(key)).cast(kind)


def _digit(key: Column, at: int) -> Column:
    """The ``at``-th digit from the top, 0 to 2^16 - 1; the sign bit is flipped so that digits order as keys do."""
    top = DIGIT_BITS * (DIGITS - 1 - at)
    digit = F.shiftrightunsigned(key, top).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1))
    return (digit.bitwiseXOR(F.lit(1 << (DIGIT_BITS - 1))) if at == 0 else digit).cast("int")


def select_ranks(df: DataFrame, group: str, value: str, percents: list[float]) -> DataFrame:
    """``group, n, p<pct>`` = sorted[min(floor(n·pct/100), n-1)] per group (0-based), exact.

    A null group is a group.  Null values come first in theirs, NaN last, as Spark orders them; a rank that
    falls on a null is null.  An empty table gives an empty one.
    """
    kind = df.schema[value].dataType
    if kind.simpleString() == "timestamp_ntz":
        raise ValueError("cast timestamp_ntz to timestamp first")
    rows = df.select(F.col(group).alias("g"), F.when(F.col(value).isNotNull(), _encoded(kind, F.col(value))).alias("key"))
    sizes = rows.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("key").isNull()).alias("nulls"))
    wanted = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(percents)]))
    rank = F.least(F.floor(F.col("n") * F.col("w.p") / F.lit(100.0)), F.col("n") - 1) - F.col("nulls")
    targets = sizes.select("g", "n", "nulls", wanted.alias("w")).select("g", "n", F.col("w.i").alias("i"), rank.alias("rank"))
    spark = df.sparkSession
    known = _kept(spark, targets.withColumn("prefix", F.lit(0).cast("bigint")))
    for at in range(DIGITS):
        searched = known.where("rank >= 0").select("g", "prefix").distinct()
        few = searched.count() <= MAX_BROADCAST_TARGETS
        # The digits read so far, with the first one's sign flip undone by reading them the same way on both sides.
        head = F.lit(0).cast("bigint")
        for d in range(at):
            head = F.shiftleft(head, DIGIT_BITS) + _digit(F.col("key"), d)
        here = rows.where("key IS NOT NULL").select("g", head.alias("prefix"), _digit(F.col("key"), at).alias("digit"))
        here = null_safe_join(here, F.broadcast(searched) if few else searched, ["g", "prefix"], "left_semi")
        histogram = here.groupBy("g", "prefix", "digit").agg(F.count(F.lit(1)).alias("c"))
        # At most 2^16 digits a searched prefix: gathered per prefix, ordered there.
        bars = histogram.groupBy("g", "prefix").agg(F.array_sort(F.collect_list(F.struct("digit", "c"))).alias("bars"))
        met = null_safe_join(known, bars, ["g", "prefix"], "left")
        start = F.struct(F.col("rank").alias("left"), F.lit(-1).alias("digit"))
        step = lambda acc, b: F.when(acc["digit"] >= 0, acc).when(acc["left"] < b["c"], F.struct(acc["left"].alias("left"), b["digit"].alias("digit"))).otherwise(F.struct((acc["left"] - b["c"]).alias("left"), acc["digit"].alias("digit")))
        found = met.withColumn("f", F.when(F.col("rank") >= 0, F.aggregate("bars", start, step)))
        prefix = F.shiftleft(F.col("prefix"), DIGIT_BITS) + F.col("f.digit")
        known = _kept(spark, found.select("g", "n", "i", F.coalesce("f.left", "rank").alias("rank"), F.coalesce(prefix, "prefix").alias("prefix")))
    key = F.when(F.col("rank") >= 0, F.col("prefix").bitwiseXOR(F.lit(-(2**63))))
    result = known.select("g", "n", "i", key.alias("key"))
    decoded = result.select("g", "n", "i", F.when(F.col("key").isNotNull(), _decoded(kind, F.coalesce("key", F.lit(0).cast("bigint")))).alias("v"))
    out = decoded.groupBy("g", "n").agg(*[F.max(F.when(F.col("i") == i, F.col("v"))).alias(f"p{p:g}") for i, p in enumerate(percents)])
    return out.withColumnRenamed("g", group)


def _kept(spark, df: DataFrame) -> DataFrame:
    """A few rows per group, written so that the next pass doesn't count again what led to them."""
    from ..session import scratch_path

    path = scratch_path(spark, "ranks")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
