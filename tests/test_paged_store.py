"""The paged store's data source: pruning, two-phase commit, and the feed's positions."""

import datetime as dt
import json
import os
import time
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringStartsWith

from embedflow.plans.store_queries import drain
from embedflow.session import scratch_path
from embedflow.sources import paged_store as P
from tests.conftest import make_records

ROWS = T.StructType([T.StructField("namespace", T.StringType()), T.StructField("id", T.StringType()), T.StructField("n", T.LongType())])


@pytest.fixture
def store(spark):
    """Three namespaces and null, two hundred ids each, in pages of ten."""
    path = scratch_path(spark, "t-pages")
    rows = [(ns, f"v{i:03d}", i) for ns in ("a", "b", "c", None) for i in range(200)]
    P.write_pages(spark.createDataFrame(rows, ROWS), path, ["namespace", "id"], page_rows=10, ranges=4)
    return path, rows


FILTERS = [
    ([EqualTo(("namespace",), "b")], "namespace = 'b'"),
    ([EqualTo(("namespace",), "b"), LessThan(("id",), "v050")], "namespace = 'b' AND id < 'v050'"),
    ([GreaterThanOrEqual(("id",), "v190")], "id >= 'v190'"),
    ([GreaterThan(("id",), "v190"), LessThanOrEqual(("id",), "v195")], "id > 'v190' AND id <= 'v195'"),
    ([In(("namespace",), ("a", "zz"))], "namespace IN ('a', 'zz')"),
    ([IsNull(("namespace",))], "namespace IS NULL"),
    ([EqualNullSafe(("namespace",), None)], "namespace <=> NULL"),
    ([IsNotNull(("namespace",)), StringStartsWith(("id",), "v01")], "namespace IS NOT NULL AND id LIKE 'v01%'"),
    ([EqualTo(("namespace",), "none")], "namespace = 'none'"),
]


@pytest.mark.parametrize("filters,sql", FILTERS, ids=[s for _, s in FILTERS])
def test_pushed_filters_open_fewer_pages_and_lose_no_row(spark, store, filters, sql):
    path, rows = store
    everything = spark.createDataFrame(rows, ROWS)
    want = sorted(map(str, everything.where(sql).collect()))
    df = P.read_pages(spark, path).where(sql)
    assert sorted(map(str, df.collect())) == want
    reader = P.PagesReader({"path": path, "pagesPerPartition": "3"})
    assert len(list(reader.pushFilters(filters))) == len(filters)  # Spark still applies them to rows
    every = P.PagesReader({"path": path})
    total = sum(p["pages"] for p in every.parts())
    opened = sum(len(reader.wanted(x)) for x in reader.partitions())
    held = sum(b.num_rows for x in reader.partitions() for b in reader.read(x))
    assert total == 80 and opened < total and held == 10 * opened >= len(want)
    assert opened <= -(-len(want) // 10) + 8  # at most the borders' pages beyond the rows wanted


def test_filters_reach_the_source_through_spark(spark, store):
    path, _ = store
    every = P.read_pages(spark, path)
    assert spark.conf.get("spark.sql.python.filterPushdown.enabled") == "true"
    assert sum(len(m["parts"]) for m in P.manifests(path)) == 4
    assert every.where("namespace = 'b'").count() == 200 and every.where("namespace = 'none'").count() == 0
    assert every.where("n = 7").count() == 4  # not a key column


def test_a_filter_that_pages_cannot_answer_keeps_them_all(store):
    path, _ = store
    reader = P.PagesReader({"path": path})
    assert list(reader.pushFilters([StringContains(("id",), "9"), EqualTo(("n",), 3)]))
    assert sum(len(reader.wanted(x)) for x in reader.partitions()) == 80


def test_records_with_vectors_and_metadata_round_trip(spark):
    src, _ = make_records(spark, 40, 8, 0, namespace="x")
    path = scratch_path(spark, "t-records")
    P.write_pages(src, path, ["namespace", "id"], page_rows=7)
    back = P.read_pages(spark, path)
    assert back.schema.simpleString() == src.schema.simpleString()
    as_rows = lambda df: sorted((r["id"], tuple(r["vector"]), tuple(sorted(r["metadata"].items())), r["namespace"]) for r in df.collect())
    assert as_rows(back) == as_rows(src)


def counts(spark, path):
    return {r["job"]: r["count"] for r in P.read_pages(spark, path).groupBy("job").count().collect()}


def jobs(spark, name, n=20):
    return spark.range(n).select(F.lit(name).alias("job"), F.col("id"))


def test_overwrite_append_and_repeated_jobs(spark):
    path = scratch_path(spark, "t-jobs")
    P.write_pages(jobs(spark, "old"), path, ["id"])
    P.write_pages(jobs(spark, "new"), path, ["id"], mode="overwrite", job_id="j1")
    P.write_pages(jobs(spark, "more", 7), path, ["id"], job_id="j2")
    for _ in range(2):  # replays, of the overwriting job, too, change nothing
        P.write_pages(jobs(spark, "new"), path, ["id"], mode="overwrite", job_id="j1")
        P.write_pages(jobs(spark, "more", 7), path, ["id"], job_id="j2")
    assert counts(spark, path) == {"new": 20, "more": 7}
    named = {p["file"] for m in P.manifests(path) for p in m["parts"]}
    there = {os.path.relpath(os.path.join(d, f), path) for d, _, fs in os.walk(os.path.join(path, "pages")) for f in fs if f.endswith(".arrow")}
    assert there == named  # what the replays staged is withdrawn
    P.write_pages(jobs(spark, "none", 0), path, ["id"], mode="overwrite")
    assert counts(spark, path) == {}


def test_a_failing_task_withdraws_the_job(spark):
    path = scratch_path(spark, "t-fail")
    P.write_pages(jobs(spark, "good"), path, ["id"])
    broken = spark.range(0, 4000, 1, 4).select(F.lit("bad").alias("job"), F.when(F.col("id") == 3999, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).cast("bigint").alias("id"))
    P.register(spark)
    with pytest.raises(Exception):
        broken.write.format("paged_store").option("path", path).option("keys", "id").option("pageRows", "100").mode("append").save()
    assert counts(spark, path) == {"good": 20} and len(P.manifests(path)) == 1
    named = {p["file"].split("/")[1] for m in P.manifests(path) for p in m["parts"]}
    assert set(os.listdir(os.path.join(path, "pages"))) == named


def batches(values):
    return iter([pa.RecordBatch.from_arrays([pa.array(values, pa.int64())], names=["n"])])


def writer(path, job=None, overwrite=False):
    options = {"path": path, "keys": "n", "pageRows": "4"} | ({"jobId": job} if job else {})
    return P.PagesWriter(options, T.StructType([T.StructField("n", T.LongType())]), overwrite)


def stored(path):
    reader = P.PagesReader({"path": path})
    return sorted(v for x in reader.partitions() for b in reader.read(x) for v in b.column(0).to_pylist())


def test_a_retried_task_counts_once(tmp_path):
    """The first attempt of a task staged its pages, or some of them, and was lost: its message never comes."""
    path = str(tmp_path)
    w = writer(path)

    def dies():
        yield from batches(range(10))
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        w.write(dies())
    w.write(batches(range(10)))
    w.commit([w.write(batches(range(10))), w.write(batches(range(10, 15))), w.write(iter([])), None])
    assert stored(path) == list(range(15))


def test_writers_that_commit_together_take_their_own_numbers(tmp_path):
    path = str(tmp_path)

    def job(k):
        w = writer(path, f"job-{k % 8}")  # every job twice
        w.commit([w.write(batches([100 * (k % 8) + i for i in range(5)]))])

    with ThreadPoolExecutor(8) as pool:
        list(pool.map(job, [*range(8), *range(8)]))
    found = P.manifests(path)
    assert [m["number"] for m in found] == list(range(len(found)))
    assert sorted({m["job"] for m in found}) == [f"job-{k}" for k in range(8)]


def test_abort_leaves_nothing(tmp_path):
    w = writer(str(tmp_path))
    w.abort([w.write(batches(range(9))), None])
    assert P.manifests(str(tmp_path)) == [] and os.listdir(tmp_path / "pages") == []


def test_bad_options(tmp_path, spark):
    with pytest.raises(ValueError, match="path"):
        P.PagesReader({})
    with pytest.raises(ValueError, match="mounted"):
        P.PagesReader({"path": "s3://bucket/x"})
    with pytest.raises(ValueError, match="not in the data"):
        P.PagesWriter({"path": str(tmp_path)}, T.StructType([T.StructField("n", T.LongType())]), False)
    with pytest.raises(ValueError, match="positionPath"):
        P.FeedReader({"path": str(tmp_path), "maxRowsPerTrigger": "5"})
    with pytest.raises(Exception, match="nothing is committed"):
        P.read_pages(spark, str(tmp_path)).count()
    assert P.read_pages(spark, str(tmp_path), "n bigint").count() == 0


# ── feed ─────────────────────────────────────────────────────────────────────

FEED = "id string, seq bigint, updated_at timestamp"
T0 = dt.datetime(2024, 1, 1)


def changes(spark, rows):
    return spark.createDataFrame([(f"k{s % 7}", s, t) for s, t in rows], FEED)


def test_positions_cover_every_row_once(spark):
    """Ranges between consecutive positions part the rows, whatever the limit; equal and null times included."""
    path = scratch_path(spark, "t-ranges")
    first = [(s, T0 + dt.timedelta(hours=s // 40)) for s in range(200)] + [(1000 + s, None) for s in range(5)]
    P.write_pages(changes(spark, first), path, ["updated_at", "seq"], page_rows=9, ranges=3)
    P.write_pages(changes(spark, [(300 + s, T0) for s in range(30)]), path, ["updated_at", "seq"], page_rows=9, ranges=2)  # late
    want = sorted([s for s, _ in first] + [300 + s for s in range(30)])
    for limit in ("1", "10", "50", "10000"):
        reader = P.FeedReader({"path": path, "maxRowsPerTrigger": limit, "positionPath": f"{path}/../{os.path.basename(path)}-pos-{limit}"})
        at, got, steps = reader.initialOffset(), [], 0
        while (end := reader.latestOffset()) != at:
            ranges = reader.partitions(at, end)
            rows = [v for x in ranges for b in reader.read(x) for v in b.column("seq").to_pylist()]
            again = [v for x in reader.partitions(at, end) for b in reader.read(x) for v in b.column("seq").to_pylist()]
            assert sorted(rows) == sorted(again)
            got, at, steps = got + rows, end, steps + 1
        assert sorted(got) == want
        assert reader.partitions(at, at) == []
        assert steps >= len(want) // max(int(limit), 9 * 3) // 2
        restarted = P.FeedReader({"path": path, "maxRowsPerTrigger": limit, "positionPath": reader.position_path})
        assert restarted.latestOffset() == at
        with pytest.raises(ValueError, match="positionPath"):
            restarted.partitions(at, reader.initialOffset())
    whole = P.FeedReader({"path": path})
    end = whole.latestOffset()
    assert json.loads(end["keys"]) and sum(b.num_rows for x in whole.partitions(whole.initialOffset(), end) for b in whole.read(x)) == len(want)


def run_some(stream, out, checkpoint, triggers):
    """Run until that many triggers are done, then stop in between."""
    q = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    deadline = time.time() + 60
    while time.time() < deadline and (q.lastProgress is None or q.lastProgress["batchId"] < triggers - 1):
        time.sleep(0.05)
    q.stop()
    assert q.exception() is None


def test_a_restart_between_triggers_loses_and_repeats_nothing(spark):
    path, out = scratch_path(spark, "t-feed"), scratch_path(spark, "t-feed-out")
    checkpoint = out + "-checkpoint"
    rows = [(s, T0 + dt.timedelta(minutes=s // 50)) for s in range(400)]  # fifty changes a minute share a time
    P.write_pages(changes(spark, rows[:300]), path, ["updated_at", "seq"], page_rows=10)
    feed = lambda: P.read_feed(spark, path, os.path.join(checkpoint, "position.json"), max_rows=35)
    run_some(feed(), out, checkpoint, 2)
    seen = spark.read.schema(FEED).parquet(out).count()
    assert 0 < seen < 300
    P.write_pages(changes(spark, rows[300:]), path, ["updated_at", "seq"], page_rows=10)
    run_some(feed(), out, checkpoint, 6)
    drain(feed(), out, checkpoint)
    drain(feed(), out, checkpoint)  # nothing new
    got = sorted((r["seq"], r["updated_at"]) for r in spark.read.schema(FEED).parquet(out).collect())
    assert got == rows


# ── per-key state ────────────────────────────────────────────────────────────


def classified(spark, path, out):
    from embedflow.streaming import state

    checkpoint = out + "-checkpoint"
    feed = P.read_feed(spark, path, os.path.join(checkpoint, "position.json"), max_commits=1)
    found = state.classify_changes(feed, "id", "updated_at", "seq")
    drain(found, out, checkpoint)
    return sorted((r["id"] or "", r["seq"], r["change"]) for r in spark.read.schema(found.schema).parquet(out).collect())


def keyed(spark, rows):
    return spark.createDataFrame(rows, FEED)


def test_state_tells_inserts_updates_and_stale_rows_over_a_restart(spark):
    path, out = scratch_path(spark, "t-state"), scratch_path(spark, "t-state-out")
    hour = dt.timedelta(hours=1)
    P.write_pages(keyed(spark, [("a", 1, T0), ("a", 3, T0), ("a", 2, T0), ("b", 4, T0), (None, 5, T0)]), path, ["updated_at", "seq"])
    P.write_pages(keyed(spark, [("a", 6, T0 + hour), ("b", 0, T0 - hour), ("c", 7, None)]), path, ["updated_at", "seq"])
    one = [("", 5, "insert"), ("a", 1, "stale"), ("a", 2, "stale"), ("a", 3, "insert"), ("b", 4, "insert")]
    two = [("a", 6, "update"), ("b", 0, "stale"), ("c", 7, "insert")]
    assert classified(spark, path, out) == sorted(one + two)
    P.write_pages(keyed(spark, [("a", 6, T0 + hour), ("a", 7, T0 + hour), (None, 9, T0), ("c", 8, None)]), path, ["updated_at", "seq"])
    three = [("a", 6, "stale"), ("a", 7, "update"), ("", 9, "update"), ("c", 8, "update")]
    assert classified(spark, path, out) == sorted(one + two + three)


def test_state_expires(spark):
    """A stream with a TTL goes on making empty batches, so it is stopped once its rows are through."""
    from embedflow.streaming import state

    path, out = scratch_path(spark, "t-ttl"), scratch_path(spark, "t-ttl-out")
    checkpoint = out + "-checkpoint"
    for n in (1, 2):
        P.write_pages(keyed(spark, [("a", n, T0)]), path, ["updated_at", "seq"])
        feed = P.read_feed(spark, path, os.path.join(checkpoint, "position.json"), max_commits=1)
        found = state.classify_changes(feed, "id", "updated_at", "seq", ttl_ms=1)
        q = found.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(processingTime="0 seconds").start()
        deadline = time.time() + 90
        while time.time() < deadline and q.exception() is None and not any(p["numInputRows"] for p in q.recentProgress):
            time.sleep(0.1)
        q.stop()
        assert q.exception() is None
    rows = spark.read.schema(found.schema).parquet(out).collect()
    assert sorted((r["id"], r["seq"], r["change"]) for r in rows) == [("a", 1, "insert"), ("a", 2, "insert")]
