import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.operators import batching, progress, reconcile as R, upsert as U
from embedflow.session import scratch_path
from embedflow.streaming import sync
from tests.conftest import make_records


@pytest.mark.parametrize("n,size", [(50, 256), (50, 16), (5, 1), (100, 64)])
def test_batches_are_full_and_ordered(spark, n, size):
    df, _ = make_records(spark, n, 4, 0)
    rows = batching.assign_batches(df.repartition(3), size).orderBy("rn").collect()
    assert [r["id"] for r in rows] == sorted(r["id"] for r in rows)
    assert [r["rn"] for r in rows] == list(range(n))
    counts = {}
    for r in rows:
        counts[r["batch_id"]] = counts.get(r["batch_id"], 0) + 1
    assert all(c == size for b, c in counts.items() if b < max(counts)) and sum(counts.values()) == n


def test_repeated_and_null_keys_keep_their_rows(spark):
    df, _ = make_records(spark, 12, 4, 0)
    df = df.withColumn("id", F.when(F.col("id") < "v0003", F.lit("same")).when(F.col("id") < "v0005", F.lit(None)).otherwise(F.col("id")))
    rows = batching.assign_batches(df.repartition(3), 5).collect()
    assert sorted(r["rn"] for r in rows) == list(range(12)) and len({tuple(r["vector"]) for r in rows}) == 12


def test_very_many_ranges(spark):
    n = batching.number_rows(spark.range(5000), ["id"], n_ranges=300)
    assert n.where("rn <> id").count() == 0 and n.count() == 5000


def test_grouped_batches_restart_per_group(spark):
    df, _ = make_records(spark, 40, 4, 0)
    df = df.withColumn("namespace", F.when(F.col("id") < "v0010", "a").otherwise("b"))
    rows = batching.assign_batches(df, 8, group="namespace").collect()
    a = sorted(r["rn"] for r in rows if r["namespace"] == "a")
    b = sorted(r["rn"] for r in rows if r["namespace"] == "b")
    assert a == list(range(10)) and b == list(range(30))


def test_numbering_spreads_a_hot_group(spark):
    hot = spark.range(3000).select(F.lit("hot").alias("g"), (F.col("id") * 7 % 3001).alias("v"), "id")
    cold = spark.range(100).select(F.lit("cold").alias("g"), F.col("id").alias("v"), (F.col("id") + 10_000).alias("id"))
    df = hot.union(cold)
    n = batching.number_rows(df, ["g", "v", "id"], n_ranges=8)
    assert n.select("rn").distinct().count() == 3100
    p = progress.nearest_rank(df, "g", "v", [50, 99], tie="id").orderBy("g").collect()
    vals = sorted(r["v"] for r in df.where("g = 'hot'").collect())
    hot_row = [r for r in p if r["g"] == "hot"][0]
    assert hot_row["p50"] == vals[1500] and hot_row["p99"] == vals[2970]


def test_running_sum_matches_cumsum(spark):
    df = spark.range(10_000).select((F.col("id") % 3).alias("g"), "id", (F.col("id") % 11).alias("x"))
    out = progress.running_sum(df, "g", "id", ["x"], chunk=100).where("g = 1").orderBy("id").select("x", "cum_x").collect()
    assert [r["cum_x"] for r in out] == list(np.cumsum([r["x"] for r in out]))


def test_replace_vs_vector_only_upsert(spark):
    tgt, _ = make_records(spark, 10, 4, 0)
    src, _ = make_records(spark, 10, 4, 1)
    tgt = tgt.withColumn("metadata", F.create_map(F.lit("tier"), F.lit("old")))
    src = src.where(F.col("id") >= "v0005").withColumn("metadata", F.create_map(F.lit("tier"), F.lit("new")))
    rep = {r["id"]: r for r in U.upsert_replace(tgt, src).collect()}
    vo = {r["id"]: r for r in U.upsert_vector_only(tgt, src).collect()}
    srcv = {r["id"]: r["vector"] for r in src.collect()}
    assert len(rep) == len(vo) == 10
    assert rep["v0007"]["metadata"]["tier"] == "new" and vo["v0007"]["metadata"]["tier"] == "old"
    assert rep["v0007"]["vector"] == srcv["v0007"] == vo["v0007"]["vector"]
    assert rep["v0001"]["metadata"]["tier"] == "old"


def test_the_last_write_wins_by_an_order(spark):
    tgt, _ = make_records(spark, 3, 4, 0)
    src = tgt.where("id = 'v0001'").withColumn("at", F.explode(F.array(F.lit(1), F.lit(3), F.lit(2))))
    src = src.withColumn("metadata", F.create_map(F.lit("at"), F.col("at").cast("string")))
    out = {r["id"]: r["metadata"] for r in U.upsert_replace(tgt, src, order=["at"]).collect()}
    assert out["v0001"] == {"at": "3"} and len(out) == 3


def test_reconcile_is_exact_unless_told_otherwise(spark):
    a, _ = make_records(spark, 4, 4, 0)
    b = a.withColumn("vector", F.transform("vector", lambda x: (x + F.lit(0.01)).cast("float")))
    assert {r["status"] for r in R.reconcile(a, b).collect()} == {"vector_differs"}
    assert {r["status"] for r in R.reconcile(a, b, atol=0.05).collect()} == {"match"}


def test_reconcile_statuses(spark):
    a, _ = make_records(spark, 6, 4, 0)
    b = (
        a.where(F.col("id") != "v0000")
        .withColumn("vector", F.when(F.col("id") == "v0001", F.array_repeat(F.lit(9.0).cast("float"), 4)).otherwise(F.col("vector")))
        .withColumn("metadata", F.when(F.col("id") == "v0002", F.create_map(F.lit("n"), F.lit("x"))).otherwise(F.col("metadata")))
        .withColumn("vector", F.when(F.col("id") == "v0003", F.slice("vector", 1, 3)).otherwise(F.col("vector")))
        .unionByName(a.where(F.col("id") == "v0005").withColumn("id", F.lit("zzz")))
    )
    got = {r["id"]: r["status"] for r in R.reconcile(a, b).collect()}
    assert got == {
        "v0000": "missing",
        "v0001": "vector_differs",
        "v0002": "metadata_differs",
        "v0003": "vector_differs",
        "v0004": "match",
        "v0005": "match",
        "zzz": "extra",
    }


def test_duplicated_hot_id_is_reduced_not_paired(spark):
    a, _ = make_records(spark, 5, 4, 0)
    hot = a.where(F.col("id") == "v0001")
    dup = a
    for _ in range(11):
        dup = dup.unionByName(hot)  # v0001 appears 12 times
    out = R.reconcile(dup, dup).collect()
    assert len(out) == 5
    assert {r["id"]: r["status"] for r in out}["v0001"] == "duplicate"
    assert U.upsert_replace(a, dup).count() == 5


def _changes(spark, rows):
    return spark.createDataFrame(rows, "id string, seq bigint, updated_at timestamp, value double")


def test_sync_epoch_is_idempotent_and_keeps_equal_timestamps(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    target = sync.SyncTarget(scratch_path(spark, "t-sync"), "id", "updated_at", "seq")
    first = _changes(spark, [("a", 1, t, 1.0), ("b", 2, t, 2.0)])
    assert sync.apply_changes(spark, target, first, 0) == 2
    assert sync.apply_changes(spark, target, first, 0) == 0  # retried epoch: no second commit
    # same timestamp, higher seq: must not be lost; older change must not win
    nxt = _changes(spark, [("a", 3, t, 3.0), ("b", 0, t - dt.timedelta(days=1), 9.0)])
    sync.apply_changes(spark, target, nxt, 1)
    cur = {r["id"]: r["value"] for r in target.current(spark).collect()}
    assert cur == {"a": 3.0, "b": 2.0}
    assert target.ledger(spark).count() == 2
    sync.compact(spark, target)
    assert {r["id"]: r["value"] for r in target.current(spark).collect()} == cur
    sync.apply_changes(spark, target, _changes(spark, [("c", 9, t, 5.0)]), 2)
    assert {r["id"]: r["value"] for r in target.current(spark).collect()} == {**cur, "c": 5.0}


def test_streams_and_catch_up_number_their_epochs_apart(spark):
    """A load, then a stream with an update, an insert and a late row, then a restart: nothing is lost."""
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    target = sync.SyncTarget(scratch_path(spark, "t-live"), "id", "updated_at", "seq")
    sync.sync_once(spark, target, _changes(spark, [("a", 5, t, 1.0)]))
    feed = scratch_path(spark, "t-feed")
    late = t - dt.timedelta(days=30)
    _changes(spark, [("a", 6, t, 2.0), ("b", 7, t, 3.0), ("late", 1, late, 4.0)]).coalesce(1).write.parquet(feed)
    for more in ([], [("b", 9, t, 5.0)]):
        if more:
            _changes(spark, more).coalesce(1).write.mode("append").parquet(feed)
        stream = spark.readStream.schema("id string, seq bigint, updated_at timestamp, value double").parquet(feed)
        sync.start_sync_stream(stream, target, target.root + "/_offsets", compact_every=1).awaitTermination()
    sync.sync_once(spark, target, _changes(spark, [("later", 2, late, 6.0), ("a", 1, late, 7.0), ("b", 9, t, 5.0)]))
    assert {r["id"]: r["value"] for r in target.current(spark).collect()} == {"a": 2.0, "b": 5.0, "late": 4.0, "later": 6.0}
    assert target.ledger(spark).groupBy("commit").count().where("count > 1").count() == 0


def test_read_errors_are_not_an_empty_ledger(spark):
    target = sync.SyncTarget(scratch_path(spark, "t-bad"))
    import os

    os.makedirs(target.ledger_path)
    with open(os.path.join(target.ledger_path, "part-0.parquet"), "w") as f:
        f.write("this is no Parquet file")
    with pytest.raises(Exception):
        target.last_commit(spark)


def test_sync_once_uses_high_water_mark(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    target = sync.SyncTarget(scratch_path(spark, "t-once"), "id", "updated_at", "seq")
    all_rows = _changes(spark, [("a", 1, t, 1.0), ("a", 2, t, 2.0), ("c", 3, t + dt.timedelta(hours=1), 3.0)])
    sync.sync_once(spark, target, all_rows.where("seq < 2"))
    n = sync.sync_once(spark, target, all_rows)
    assert n == 2
    assert {r["id"]: r["seq"] for r in target.current(spark).collect()} == {"a": 2, "c": 3}


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([(f"i{k:02d}", None if k % 3 == 0 else "a") for k in range(30)], "id string, namespace string")
    rows = batching.assign_batches(df, 4, group="namespace").collect()
    assert sorted((r["batch_id"], r["pos"]) for r in rows if r["namespace"] is None) == [(k // 4, k % 4) for k in range(10)]
    assert len(rows) == 30


def test_jobs_with_more_batches_than_the_key_stay_apart(spark, monkeypatch):
    from embedflow.plans import ledger_queries as q

    src, _ = make_records(spark, 96, 8, 0)
    label = (F.substring("id", 2, 4).cast("int") % 2).cast("bigint")
    src = src.withColumn("label", label).withColumn("namespace", F.concat(F.lit("ns"), F.col("label").cast("string")))
    monkeypatch.setattr(q, "JOB_KEY", 2)  # three batches a job: job 0's last number is job 1's first
    rows = q.booked(src).collect()
    assert sorted((r["job_id"], r["label"], r["batch_id"], r["raw_bytes"]) for r in rows) == [(f"job-ns{k}", k, n, 512) for k in (0, 1) for n in range(3)]


def test_null_groups_and_orders_keep_their_running_sums_and_ranks(spark):
    from embedflow.operators import progress

    rows = [(g, k, float(k)) for g in ("a", None) for k in range(10)]
    df = spark.createDataFrame(rows, "g string, k bigint, v double")
    got = progress.running_sum(df, "g", "k", ["v"], chunk=4).collect()
    assert sorted((r["g"] or "", r["k"], r["cum_v"]) for r in got) == sorted((g or "", k, float(sum(range(k + 1)))) for g, k, _ in rows)
    ranks = {r["g"]: (r["n"], r["p50"], r["p99"]) for r in progress.nearest_rank(df, "g", "v", [50, 99]).collect()}
    assert ranks == {"a": (10, 5.0, 9.0), None: (10, 5.0, 9.0)}


def test_null_ids_are_one_id_for_reconcile_and_upserts(spark):
    a, _ = make_records(spark, 6, 4, 1)
    a = a.withColumn("id", F.when(F.col("id") != "v0003", F.col("id")))
    status = lambda s, t: {r["id"]: r["status"] for r in R.reconcile(s, t).collect()}
    assert set(status(a, a).values()) == {"match"} and len(status(a, a)) == 6
    moved = a.withColumn("vector", F.when(F.col("id").isNull(), F.transform("vector", lambda x: x + 1)).otherwise(F.col("vector")))
    assert status(a, moved)[None] == "vector_differs"
    assert status(a, a.where("id is not null"))[None] == "missing" and status(a.where("id is not null"), a)[None] == "extra"
    twice = a.unionByName(a.where("id is null"))
    assert status(twice, a)[None] == "duplicate" and R.one_row_per_id(twice).count() == 6
    for upsert in (U.upsert_replace, U.upsert_vector_only):
        out = upsert(a, moved)
        assert out.count() == 6 and status(moved, out.select("id", "vector", "metadata"))[None] == "match"


def test_a_commit_between_a_compaction_s_read_and_its_entry_is_kept(spark, monkeypatch):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    target = sync.SyncTarget(scratch_path(spark, "t-race"), "id", "updated_at", "seq")
    for k in range(3):
        sync.apply_changes(spark, target, _changes(spark, [(f"k{k}", k, t, float(k))]), k)
    real, meanwhile = sync._commit, []

    def slow(s, tgt, after, entry):
        if entry["kind"] == "base" and not meanwhile:
            meanwhile.append(1)
            assert sync.apply_changes(s, tgt, _changes(s, [("late", 9, t, 9.0)]), 0, "other") == 1
        return real(s, tgt, after, entry)

    monkeypatch.setattr(sync, "_commit", slow)
    assert sync.compact(spark, target) is not None
    want = {"k0": 0.0, "k1": 1.0, "k2": 2.0, "late": 9.0}
    assert {r["id"]: r["value"] for r in target.current(spark).collect()} == want
    state = target.state(spark)
    assert (state.commit, state.upto, len(state.deltas)) == (4, 2, 1) and state.has("other", 0) and state.has(sync.BATCH, 2)
    assert sync.compact(spark, target) is not None and sync.compact(spark, target) is None
    assert {r["id"]: r["value"] for r in target.current(spark).collect()} == want
    assert sync.apply_changes(spark, target, _changes(spark, [("late", 10, t, 0.0)]), 0, "other") == 0  # behind a base, still known


def test_writers_never_share_a_commit_number(spark):
    """Two streams and two compactions that begin from the same state."""
    import datetime as dt
    from concurrent.futures import ThreadPoolExecutor

    t = dt.datetime(2024, 1, 1)
    target = sync.SyncTarget(scratch_path(spark, "t-two"), "id", "updated_at", "seq")
    sync.apply_changes(spark, target, _changes(spark, [("a", 0, t, 0.0)]), 0, "s0")

    def stream(name):
        for epoch in range(1, 4):
            sync.apply_changes(spark, target, _changes(spark, [(f"{name}-{epoch}", epoch, t, 1.0)]), epoch, name)

    with ThreadPoolExecutor(4) as pool:
        for done in [pool.submit(stream, "s0"), pool.submit(stream, "s1"), pool.submit(sync.compact, spark, target), pool.submit(sync.compact, spark, target)]:
            done.result()
    commits = [r["commit"] for r in target.ledger(spark).collect()]
    assert sorted(commits) == list(range(len(commits)))
    assert {r["id"] for r in target.current(spark).collect()} == {"a", *(f"s{i}-{e}" for i in (0, 1) for e in range(1, 4))}


def test_an_epoch_reads_the_ledger_from_the_last_base_on(spark):
    import datetime as dt

    t = dt.datetime(2024, 1, 1)
    target = sync.SyncTarget(scratch_path(spark, "t-prune"), "id", "updated_at", "seq")
    for k in range(5):
        sync.apply_changes(spark, target, _changes(spark, [("a", k, t, float(k))]), k)
    sync.compact(spark, target)
    entries = target._entries(spark, 5)
    assert [r["kind"] for r in entries.collect()] == ["base"]
    assert target.state(spark).epochs == {sync.BATCH: [[0, 4]]} and target.next_epoch(spark, sync.BATCH) == 5
    assert target.high_water(spark) == (t, 4)


def test_publish_is_once_and_whole(spark):
    import os

    from embedflow import storage

    root = scratch_path(spark, "t-pub")
    path = os.path.join(root, "sub", "x.json")
    assert storage.read_text(spark, path) is None
    assert storage.publish(spark, path, "one") and not storage.publish(spark, path, "two")
    assert storage.read_text(spark, path) == "one" and os.listdir(os.path.dirname(path)) == ["x.json"]
    storage.replace(spark, path, "three")
    assert storage.read_text(spark, path) == "three"
