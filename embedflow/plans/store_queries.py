"""Queries through the paged store's data source and the change feed's state (S15, X3, K3, S11, ST1, ST3)."""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import paged_store as P
from ..streaming import state
from .common import source
from .record_queries import CANON_SQL, W, canon_out
from .registry import query
from .sync_queries import LATEST_SQL, feed

NAMESPACE, FROM_ID = "ns3", "2"


@query("store_read_pushdown", f"{W} SELECT {CANON_SQL} FROM src WHERE namespace = '{NAMESPACE}' AND id >= '{FROM_ID}'")
def store_read_pushdown(spark, sf_dir):
    """Pages of all records, clustered by namespace and id, read back with both filters pushed to the source."""
    path = scratch_path(spark, "pages")
    P.write_pages(source(spark, sf_dir), path, ["namespace", "id"], page_rows=16)
    return canon_out(P.read_pages(spark, path).where((F.col("namespace") == NAMESPACE) & (F.col("id") >= FROM_ID)))


@query(
    "store_write_commits",
    f"{W} SELECT {CANON_SQL}, CASE WHEN label < 5 THEN 'first' ELSE 'second' END AS job FROM src",
)
def store_write_commits(spark, sf_dir):
    """An overwriting job and an appending one, each delivered twice under its job id; what came before is gone."""
    path = scratch_path(spark, "commits")
    src = source(spark, sf_dir)
    half = F.col("metadata")["label"].cast("int") < 5
    P.write_pages(src.withColumn("job", F.lit("before")), path, ["namespace", "id"])
    for job, rows, mode in (("first", src.where(half), "overwrite"), ("second", src.where(~half), "append")):
        for _ in range(2):
            P.write_pages(rows.withColumn("job", F.lit(job)), path, ["namespace", "id"], mode=mode, job_id=f"{job}-job")
    stored = P.read_pages(spark, path)
    return canon_out(stored, "job")


# ── the change feed ──────────────────────────────────────────────────────────

#: Days of events that one commit of the feed holds.
SLICE_DAYS = 10


def _commit_slices(spark, sf_dir, path: str) -> None:
    """The events as a feed: a commit per ten days, in order, with its rows in order of (updated_at, seq)."""
    changes = feed(spark, sf_dir).withColumn("slice", F.floor(F.unix_timestamp("updated_at") / F.lit(SLICE_DAYS * 86400)))
    staged = scratch_path(spark, "slices")
    changes.write.partitionBy("slice").parquet(staged)
    slices = sorted(r["slice"] for r in spark.read.parquet(staged).select("slice").distinct().collect())  # folders
    for k in slices:
        rows = spark.read.schema(changes.drop("slice").schema).parquet(os.path.join(staged, f"slice={k}"))
        P.write_pages(rows, path, ["updated_at", "seq"], job_id=f"slice-{k}", page_rows=256)


def drain(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Run a stream into a Parquet folder until its source has nothing more."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime="0 seconds").start()
    try:
        q.processAllAvailable()
    finally:
        deadline = time.time() + 30
        while q.status.get("isTriggerActive") and time.time() < deadline:  # let an empty trigger finish
            time.sleep(0.05)
        q.stop()
    if q.exception() is not None:
        raise q.exception()


@query("store_feed_stream", "SELECT CAST(user_id AS VARCHAR) AS id, event_id AS seq, epoch_us(ts) AS updated_us, event_type, value FROM events")
def store_feed_stream(spark, sf_dir):
    """The whole feed through the stream source, in triggers of some thousand rows that end between equal timestamps."""
    path, out = scratch_path(spark, "feed-store"), scratch_path(spark, "feed-rows")
    _commit_slices(spark, sf_dir, path)
    checkpoint = out + "-checkpoint"
    n = max(1, feed(spark, sf_dir).count() // 8)
    stream = P.read_feed(spark, path, os.path.join(checkpoint, "position.json"), max_rows=n)
    drain(stream, out, checkpoint)
    rows = spark.read.schema(stream.schema).parquet(out)
    return rows.select("id", "seq", F.unix_micros("updated_at").alias("updated_us"), "event_type", "value")


def _classified(spark, sf_dir, again: str | None = None) -> DataFrame:
    """Classes of the feed's changes, a commit per trigger; the changes of one type are delivered once more at the end."""
    path, out = scratch_path(spark, "state-store"), scratch_path(spark, "state-rows")
    _commit_slices(spark, sf_dir, path)
    if again:
        P.write_pages(feed(spark, sf_dir).where(F.col("event_type") == again), path, ["updated_at", "seq"], job_id="again")
    checkpoint = out + "-checkpoint"
    stream = P.read_feed(spark, path, os.path.join(checkpoint, "position.json"), max_commits=1)
    found = state.classify_changes(stream, "id", "updated_at", "seq")
    drain(found, out, checkpoint)
    return spark.read.schema(found.schema).parquet(out)


CLASSES_SQL = f"""
WITH e AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, CAST(floor(epoch(ts) / {SLICE_DAYS * 86400}) AS BIGINT) ORDER BY ts DESC, event_id DESC) AS r,
         dense_rank() OVER (PARTITION BY user_id ORDER BY CAST(floor(epoch(ts) / {SLICE_DAYS * 86400}) AS BIGINT)) AS nth FROM events
), c AS (
  SELECT event_type, CASE WHEN r > 1 THEN 'stale' WHEN nth = 1 THEN 'insert' ELSE 'update' END AS change FROM e
  UNION ALL SELECT event_type, 'stale' FROM events WHERE event_type = 'view'
)
SELECT event_type, change, CAST(count(*) AS BIGINT) AS n FROM c GROUP BY event_type, change
"""


@query("sync_change_classes", CLASSES_SQL)
def sync_change_classes(spark, sf_dir):
    return _classified(spark, sf_dir, again="view").groupBy("event_type", "change").agg(F.count("*").alias("n"))


@query("sync_stateful_upserts", LATEST_SQL)
def sync_stateful_upserts(spark, sf_dir):
    """The final rows from inserts and updates alone: the last one that each key let through."""
    kept = _classified(spark, sf_dir, again="view").where(F.col("change") != state.STALE)
    last = kept.groupBy("id").agg(F.max_by(F.struct("seq", "updated_at", "value"), F.struct("updated_at", "seq")).alias("r"))
    return last.select("id", F.col("r.seq").alias("seq"), F.unix_micros("r.updated_at").alias("updated_us"), F.col("r.value").alias("value"))
