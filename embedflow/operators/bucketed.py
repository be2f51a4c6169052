"""A target that lies in buckets by id: upsert, resume and reconcile join to it without shuffling it.

The table is bucketed and sorted by ``key``, a text form of the id that is never null (so a null id is an id
like any other and joins are plain equi-joins).  A source is dealt into the same number of buckets, once; the
target's side of every join is read as it lies, and what an upsert writes is already dealt out, so the new
version costs no shuffle of the target either.  Versions are folders of their own; the catalog table points
at one of them, and a reader that has planned on the old one keeps it.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CANONICAL_COLUMNS
from .reconcile import reconcile_status, one_row_per_id

KEY = "key"


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn(KEY, F.coalesce(F.concat(F.lit("="), F.col("id")), F.lit("")))


class BucketedTarget:
    """A catalog table ``name`` under ``location`` with ``buckets`` buckets."""

    def __init__(self, spark: SparkSession, name: str, location: str, buckets: int):
        self.spark, self.name, self.location, self.buckets = spark, name, location, buckets

    def table(self) -> DataFrame:
        """The current version, with its key."""
        return self.spark.table(self.name)

    def rows(self) -> DataFrame:
        return self.table().select(*CANONICAL_COLUMNS)

    def _publish(self, keyed: DataFrame) -> None:
        """Write a version that is dealt out by key already, then point the table at it."""
        path = os.path.join(self.location, f"v-{uuid.uuid4().hex[:12]}")
        version = f"{self.name}_{uuid.uuid4().hex[:12]}"
        keyed.write.bucketBy(self.buckets, KEY).sortBy(KEY).option("path", path).saveAsTable(version)
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # an external table's files stay
        self.spark.sql(f"ALTER TABLE {version} RENAME TO {self.name}")

    def create(self, df: DataFrame) -> None:
        """Write the first version: one shuffle, by key.  Repeated ids are reduced to one row, as upserts do."""
        once = with_key(one_row_per_id(df.select(*CANONICAL_COLUMNS)).drop("n_rows"))
        self._publish(once.repartition(self.buckets, KEY))

    def _dealt(self, source: DataFrame, columns: list[str]) -> DataFrame:
        """The source in the target's buckets: its one shuffle."""
        return with_key(source).select(KEY, *columns).repartition(self.buckets, KEY)

    def merged(self, source: DataFrame, vector_only: bool = False) -> DataFrame:
        """What an upsert leaves: the source's rows, and the target's whose id it doesn't have.

        With ``vector_only`` a row that both have takes only the source's vector.  The source is reduced to
        one row per id first.
        """
        new = self._dealt(one_row_per_id(source.select(*CANONICAL_COLUMNS)).drop("n_rows"), CANONICAL_COLUMNS)
        t = self.table().select(F.col(KEY), F.struct(*CANONICAL_COLUMNS).alias("t"))
        s = new.select(F.col(KEY), F.struct(*CANONICAL_COLUMNS).alias("s"))
        both = t.join(s.hint("merge"), KEY, "full_outer")
        mine = lambda c: F.when(F.col("s").isNotNull() & (F.col("t").isNull() | F.lit(c == "vector" or not vector_only)), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c)
        return both.select(KEY, *[mine(c) for c in CANONICAL_COLUMNS])

    def upsert(self, source: DataFrame, vector_only: bool = False) -> None:
        """Publish the merged version; the target isn't shuffled to write it."""
        self._publish(self.merged(source, vector_only))

    def remaining(self, source: DataFrame) -> DataFrame:
        """Rows of ``source`` whose id the target doesn't have."""
        mine = with_key(source)  # the join deals it out
        return mine.join(self.table().select(KEY).hint("merge"), KEY, "left_anti").drop(KEY)

    def reconcile(self, source: DataFrame, atol: float = 0.0, rtol: float = 0.0) -> DataFrame:
        """``id, status`` as ``operators.reconcile.reconcile``; the target holds every id once."""
        once = one_row_per_id(source.select("id", "vector", "metadata"))
        s = self._dealt(once, ["id", "vector", "metadata", "n_rows"]).select(KEY, F.col("id").alias("sid"), F.col("vector").alias("sv"), F.col("metadata").alias("sm"), F.col("n_rows").alias("_s"))
        t = self.table().select(KEY, F.col("id").alias("tid"), F.col("vector").alias("tv"), F.col("metadata").alias("tm"), F.lit(1).alias("_t"))
        both = t.join(s.hint("merge"), KEY, "full_outer")
        return both.select(F.coalesce("sid", "tid").alias("id"), reconcile_status(atol, rtol).alias("status"))
