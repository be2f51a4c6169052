"""Sync queries on the ``events`` change feed (ST1-ST5).

Change feed: id = user_id, updated_at = ts, seq = event_id (tie-break).
The streaming queries read feed files that Spark derives from ``events``
into the shared folder, five days per file, appended in time order.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ..streaming import sync
from .common import table
from .registry import query

T0 = "2024-01-15 00:00:00"
FEED_SCHEMA = "id string, seq bigint, updated_at timestamp, event_type string, value double"

LATEST_SQL = (
    "SELECT CAST(user_id AS VARCHAR) AS id, event_id AS seq, epoch_us(ts) AS updated_us, value FROM ("
    "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"
)


def feed(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("updated_at"),
        "event_type",
        "value",
    )


def write_feed_files(spark, sf_dir, days_per_file: int = 5) -> str:
    """Feed files in the shared folder, written in one job: a folder per time slice, as many files as tasks hold rows of it."""
    path = scratch_path(spark, "feed")
    slices = F.floor(F.unix_timestamp("updated_at") / F.lit(days_per_file * 86400))
    feed(spark, sf_dir).withColumn("slice", slices).write.partitionBy("slice").parquet(path)
    return path


def _out(df: DataFrame) -> DataFrame:
    return df.select("id", "seq", F.unix_micros("updated_at").alias("updated_us"), "value")


@query("sync_latest_per_id", LATEST_SQL)
def sync_latest_per_id(spark, sf_dir):
    return _out(sync.latest_per_key(feed(spark, sf_dir), "id", "updated_at", "seq"))


@query("sync_incremental", LATEST_SQL)
def sync_incremental(spark, sf_dir):
    """Initial load up to T0, one catch-up pass from the stored high-water mark, then compaction."""
    target = sync.SyncTarget(scratch_path(spark, "sync-incremental"), "id", "updated_at", "seq")
    f = feed(spark, sf_dir)
    sync.sync_once(spark, target, f.where(F.col("updated_at") <= F.lit(T0).cast("timestamp")))
    sync.sync_once(spark, target, f)
    sync.compact(spark, target)
    return _out(target.current(spark))


def _run_stream(spark, sf_dir, trigger, name):
    files = write_feed_files(spark, sf_dir)
    target = sync.SyncTarget(scratch_path(spark, name), "id", "updated_at", "seq")
    stream = spark.readStream.schema(FEED_SCHEMA).option("maxFilesPerTrigger", 2).parquet(files).drop("slice")
    q = sync.start_sync_stream(stream, target, os.path.join(target.root, "_checkpoint"), trigger, compact_every=2)
    if "availableNow" in trigger:
        q.awaitTermination()
    else:
        q.processAllAvailable()
        deadline = time.time() + 30
        while q.status.get("isTriggerActive") and time.time() < deadline:  # let an empty trigger finish
            time.sleep(0.1)
        q.stop()
    if q.exception() is not None:
        raise q.exception()
    return target


@query("sync_live", LATEST_SQL)
def sync_live(spark, sf_dir):
    """Continuous form: processing-time trigger, drained and stopped for the check."""
    target = _run_stream(spark, sf_dir, {"processingTime": "1 second"}, "sync-live")
    return _out(target.current(spark))


@query(
    "sync_batch_ledger",
    "WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(floor(epoch(ts) / 864000) AS BIGINT) ORDER BY ts DESC, event_id DESC) AS r, "
    "CAST(floor(epoch(ts) / 864000) AS BIGINT) AS slice FROM events) SELECT row_number() OVER (ORDER BY slice) - 1 AS epoch, "
    "count(*) AS n_changes, epoch_us(max(ts)) AS hw_us, (list(event_id ORDER BY ts DESC, event_id DESC))[1] AS hw_seq FROM e WHERE r = 1 GROUP BY slice",
)
def sync_batch_ledger(spark, sf_dir):
    """The ledger of a feed that comes in slices of ten days, one epoch each: its keys and its high-water mark."""
    f = feed(spark, sf_dir)
    target = sync.SyncTarget(scratch_path(spark, "sync-ledger"), "id", "updated_at", "seq")
    files = write_feed_files(spark, sf_dir, days_per_file=10)
    slices = sorted(r["slice"] for r in spark.read.parquet(files).select("slice").distinct().collect())  # folders
    for epoch, k in enumerate(slices):
        part = spark.read.schema(f.schema).parquet(os.path.join(files, f"slice={k}"))
        for _ in range(2):  # every epoch is delivered twice and commits once
            sync.apply_changes(spark, target, part, epoch, "feed")
    return target.ledger(spark).select("epoch", "n_changes", F.unix_micros("hw_ts").alias("hw_us"), "hw_seq")


@query("sync_dedup_late", "SELECT event_id AS seq, CAST(user_id AS VARCHAR) AS id FROM events")
def sync_dedup_late(spark, sf_dir):
    """A feed together with a second delivery of its 'view' changes: the watermark's state drops what came before."""
    first = write_feed_files(spark, sf_dir)
    again = scratch_path(spark, "feed-again")
    feed(spark, sf_dir).where(F.col("event_type") == "view").write.parquet(again)
    read = lambda path: spark.readStream.schema(FEED_SCHEMA).parquet(path).select("id", "seq", "updated_at")
    out = scratch_path(spark, "dedup-out")
    deduped = sync.dedup_late(read(first).unionByName(read(again)), ["seq"], "updated_at", "2 days")
    q = (
        deduped.select("seq", "id")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", out + "-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()
    return spark.read.schema("seq bigint, id string").parquet(out)
