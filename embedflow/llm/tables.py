"""Reading the tables of a data folder, and tables written between steps."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back.

    It cuts the lineage like a reliable checkpoint, at Parquet's size: a lost executor costs at most the
    tasks that were running, and later steps don't recompute what stands above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Totals up to so many rows are broadcast whole; beyond that those of keys with this share of all rows or more.
SMALL_TOTALS, HOT_SHARE = 50_000, 1e-3


def join_totals(rows: DataFrame, totals: DataFrame, keys: list[str], n: str, small: int = SMALL_TOTALS) -> DataFrame:
    """``rows`` with the other columns of ``totals``, which has one row per key; null keys match, too.

    ``n`` is the totals' column with the number of rows of the key.  Totals beyond ``small`` rows are joined by
    a shuffle but for hot keys, of which there are ``1 / HOT_SHARE`` at most: these are broadcast, so no key
    brings more than that share of the rows to one task.  Rows without totals get nulls.  ``rows`` is read
    twice then; give a written table.
    """
    totals = written(totals, "totals")
    held = {k: f"__{k}" for k in keys}
    named = totals.withColumnsRenamed(held)
    on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(h)) for k, h in held.items()])
    size, every = totals.agg(F.count(F.lit(1)), F.sum(n)).first()
    if size <= small:
        return rows.join(F.broadcast(named), on, "left").drop(*held.values())
    hot = F.broadcast(named.where(F.col(n) >= HOT_SHARE * every))
    cold = rows.join(hot, on, "left_anti").join(named.where(F.col(n) < HOT_SHARE * every).hint("shuffle_merge"), on, "left")
    return rows.join(hot, on).unionByName(cold).drop(*held.values())
