"""A lasting dictionary from string ids to 64-bit point ids, without collisions.

``stable_point_id`` alone can give two ids one number.  The dictionary keeps what it once gave: a run adds
only ids that it doesn't know.  New ids propose numbers in turn (their own digits or hash first, then further
hashes); a number goes to the smallest id that proposes it, digits before hashes, unless the dictionary has
it already.  Losers propose again, until none is left.  So the outcome follows from the dictionary and the
set of new ids alone, not from partitions or order.

Entries lie in folders that a commit file names; a commit is published whole and once, and a writer whose
number was taken by another one reads the dictionary again and starts over.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..functions.hashing import stable_point_id
from .joins import null_safe_join

SCHEMA = "id string, point_id bigint, run bigint"


def candidate(id_col: Column, attempt: int) -> Column:
    """The number that an id proposes at its ``attempt``-th turn: its stable id, then hashes of id and turn."""
    if attempt == 0:
        return stable_point_id(id_col)
    text = F.concat_ws(":", F.lit(str(attempt)), id_col)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


class IdDictionary:
    def __init__(self, spark: SparkSession, path: str, propose: Callable[[Column, int], Column] = candidate):
        self.spark, self.path, self.propose = spark, path, propose

    def _commits(self) -> list[str]:
        """Folders of the committed runs: one control file a run."""
        out = []
        while (text := storage.read_text(self.spark, self._commit_path(len(out)))) is not None:
            out.append(json.loads(text)["folder"])
        return out

    def _commit_path(self, run: int) -> str:
        return os.path.join(self.path, "_commits", f"{run:012d}.json")

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(*[os.path.join(self.path, f) for f in folders])

    def entries(self) -> DataFrame:
        """``id, point_id, run``: every id once, every number once."""
        return self._read(self._commits())

    def _written(self, df: DataFrame, schema: str | None = None) -> DataFrame:
        path = os.path.join(self.path, "_work", uuid.uuid4().hex)
        df.write.parquet(path)
        return self.spark.read.schema(schema or df.schema).parquet(path)

    def extend(self, ids: DataFrame, id_col: str = "id") -> int:
        """Add the ids that aren't known; returns their number.

        Repeated ids count once.  Null ids get no number: they are left out.  An empty table adds nothing.
        """
        wanted = ids.select(F.col(id_col).cast("string").alias("id")).where("id IS NOT NULL").distinct()
        while True:
            folders = self._commits()
            run, known = len(folders), self._read(folders)
            left = self._written(wanted.join(known.select("id"), "id", "left_anti"))
            taken, n, folder = known.select("point_id"), left.count(), f"entries-{uuid.uuid4().hex}"
            if n == 0:
                return 0
            attempt, remaining = 0, n
            target = os.path.join(self.path, folder)
            while remaining:
                turn = left.select("id", self.propose(F.col("id"), attempt).alias("point_id"))
                free = turn.join(taken, "point_id", "left_anti")  # numbers of earlier runs and turns
                first = F.struct((~F.col("id").rlike("^[0-9]{1,18}$")).alias("hashed"), F.col("id"))
                won = free.groupBy("point_id").agg(F.min(first).alias("w")).select(F.col("w.id").alias("id"), "point_id", F.lit(run).cast("bigint").alias("run"))
                won.write.mode("append").parquet(target)
                mine = self.spark.read.schema(SCHEMA).parquet(target)
                taken = known.select("point_id").unionByName(mine.select("point_id"))
                left = self._written(left.join(mine.select("id"), "id", "left_anti"))
                remaining, attempt = left.count(), attempt + 1
            if storage.publish(self.spark, self._commit_path(run), json.dumps({"folder": folder, "n": n})):
                return n

    def lookup(self, rows: DataFrame, id_col: str = "id") -> DataFrame:
        """``rows`` with ``point_id``: original and generated id side by side; null where the id isn't known."""
        named = self.entries().select(F.col("id").alias(id_col), "point_id")
        return null_safe_join(rows, named, [id_col], "left")
