import pytest
from pyspark.sql import functions as F

from embedflow.operators import guards
from embedflow.plans.migrate import JobSpec, migrate
from embedflow.session import scratch_path
from tests.conftest import SF_SMALL, make_records


@pytest.mark.parametrize("ordered", [True, False])
def test_full_migration_transfers_and_verifies(spark, ordered):
    src, _ = make_records(spark, 100, 32, 0)
    path = scratch_path(spark, "src")
    src.repartition(3).write.parquet(path)  # three input splits
    res = migrate(spark.read.parquet(path), scratch_path(spark, "m"), JobSpec(job_id="t", batch_size=64, semantic_probes=20, ordered_batches=ordered))
    i = res.integrity.first()
    assert i["transferred"] == i["verified"] == 100 and i["failed"] == 0
    assert i["batches"] == 2
    assert res.batch_stats.where("sent <> received").count() == 0
    assert i["verification_rate_pct"] == 100.0 and i["raw_over_wire"] > 0
    assert res.semantic.first()["passed"]
    tgt = {r["id"]: (r["vector"], r["metadata"]) for r in res.target().collect()}
    assert {r["id"]: (r["vector"], r["metadata"]) for r in src.collect()} == tgt  # lossless


def _rows(df):
    return {r["id"]: (r["vector"], r["metadata"], r["namespace"]) for r in df.collect()}


def test_namespaces_come_back_as_they_were(spark):
    src, _ = make_records(spark, 40, 8, 0)
    names = F.element_at(F.array(F.lit("007"), F.lit("12"), F.lit(""), F.lit(None).cast("string")), (F.substring("id", 5, 1).cast("int") % 4 + 1))
    src = src.withColumn("namespace", names)
    res = migrate(src, scratch_path(spark, "m"), JobSpec(batch_size=16, semantic_verify=False))
    assert _rows(res.target()) == _rows(src) and res.integrity.first()["verified"] == 40


@pytest.mark.parametrize(
    "damage",
    [
        lambda d: d.withColumn("metadata", F.when(F.col("id") == "v0003", F.create_map(F.lit("n"), F.lit("other"))).otherwise(F.col("metadata"))),
        lambda d: d.withColumn("namespace", F.when(F.col("id") == "v0003", F.lit("7")).otherwise(F.col("namespace"))),
        lambda d: d.withColumn("vector", F.when(F.col("id") == "v0003", F.transform("vector", lambda x: (x * F.lit(1 + 2.0**-23)).cast("float"))).otherwise(F.col("vector"))),
        lambda d: d.where(F.col("id") != "v0003"),
        lambda d: d.where(~F.col("batch_id").endswith("-1")),
        lambda d: d.unionByName(d.where(F.col("id") == "v0003")),
    ],
)
def test_damage_in_the_target_is_failed(spark, damage):
    from embedflow.operators import batching
    from embedflow.plans.migrate import verify_run

    src, _ = make_records(spark, 40, 8, 0)
    root, spec = scratch_path(spark, "m"), JobSpec(batch_size=16, semantic_verify=False)
    src = src.withColumn("namespace", F.lit("007"))
    assert migrate(src, root, spec).integrity.first()["failed"] == 0
    expected = batching.hash_batches(src, 3).groupBy(F.concat(F.lit("1-"), F.col("batch_id").cast("string")).alias("batch_id")).agg(F.count("*").alias("sent"))
    assert verify_run(spark, root, 1, expected, spec).agg(F.sum("failed")).first()[0] == 0
    damage(spark.read.parquet(root + "/data/run=1")).write.parquet(root + "/data/run=2")
    after = verify_run(spark, root, 2, expected, spec).agg(F.sum("failed"), F.sum("sent")).first()
    assert after[0] > 0 and after[1] == 40


def test_a_later_run_replaces_rows_and_a_broken_one_is_not_read(spark):
    src, _ = make_records(spark, 20, 8, 0)
    root = scratch_path(spark, "m")
    migrate(src, root, JobSpec(batch_size=8, semantic_verify=False))
    again = migrate(src, root, JobSpec(batch_size=8, semantic_verify=False, resume=False))
    assert again.integrity.first()["transferred"] == 20 and again.cumulative.first()["transferred"] == 40
    assert _rows(again.target()) == _rows(src) and again.target().count() == 20
    ragged = src.withColumn("id", F.concat(F.lit("x"), "id")).withColumn("vector", F.when(F.col("id") == "xv0009", F.slice("vector", 1, 3)).otherwise(F.col("vector")))
    with pytest.raises(guards.DimensionMismatchError):
        migrate(ragged, root, JobSpec(semantic_verify=False))
    assert again.target().count() == 20


def test_incremental_mode_copies_what_changed(spark):
    src, _ = make_records(spark, 30, 8, 0)
    root = scratch_path(spark, "m")
    migrate(src, root, JobSpec(batch_size=8, semantic_verify=False))
    changed = src.withColumn("metadata", F.when(F.col("id") < "v0004", F.create_map(F.lit("n"), F.lit("new"))).otherwise(F.col("metadata")))
    changed = changed.unionByName(src.limit(2).withColumn("id", F.concat(F.lit("new-"), "id")))
    res = migrate(changed, root, JobSpec(mode="incremental", batch_size=8, semantic_verify=False))
    assert res.integrity.first()["transferred"] == 6 and _rows(res.target()) == _rows(changed)
    assert migrate(changed, root, JobSpec(mode="incremental", semantic_verify=False)).integrity.first()["transferred"] == 0


@pytest.mark.parametrize("spec", [JobSpec(target_dim=99), JobSpec(source_dim=99), JobSpec(mode="other")])
def test_wrong_declarations_raise(spark, spec):
    src, _ = make_records(spark, 5, 8, 0)
    with pytest.raises(ValueError):
        migrate(src, scratch_path(spark, "m"), spec)


def test_repeated_ids_keep_their_rows(spark):
    src, _ = make_records(spark, 10, 8, 0)
    src = src.unionByName(src.where("id = 'v0001'")).unionByName(src.where("id = 'v0001'"))
    for ordered in (True, False):
        res = migrate(src, scratch_path(spark, "m"), JobSpec(batch_size=4, semantic_verify=False, ordered_batches=ordered))
        i = res.integrity.first()
        assert i["transferred"] == i["verified"] == 12 and i["failed"] == 0 and res.target().count() == 12


@pytest.mark.parametrize("batch_size", [64, 1])
def test_resume_copies_nothing_twice(spark, batch_size):
    src, _ = make_records(spark, 20, 8, 0)
    root = scratch_path(spark, "m")
    migrate(src.where(F.col("id") < "v0010"), root, JobSpec(batch_size=batch_size, semantic_verify=False))
    res = migrate(src, root, JobSpec(batch_size=batch_size, semantic_verify=False))
    assert res.integrity.first()["transferred"] == 10 and res.cumulative.first()["transferred"] == 20
    assert res.target().count() == 20
    nothing = migrate(src, root, JobSpec(batch_size=batch_size, semantic_verify=False))
    assert nothing.integrity.first()["transferred"] == 0 and nothing.cumulative.first()["verified"] == 20


def test_metric_mismatch_blocks_unless_overridden(spark):
    src, _ = make_records(spark, 10, 8, 0)
    with pytest.raises(guards.MetricMismatchError):
        migrate(src, scratch_path(spark, "m"), JobSpec(source_metric="cosine", target_metric="l2"))
    res = migrate(src, scratch_path(spark, "m"), JobSpec(source_metric="cosine", target_metric="l2", metric_override=True, semantic_verify=False))
    assert res.integrity.first()["transferred"] == 10


def test_job_spec_defaults_and_json():
    s = JobSpec.from_json('{"job_id": "x", "batch_size": 64, "unknown": 1}')
    assert (s.job_id, s.batch_size, s.semantic_probes, s.semantic_top_k, s.semantic_verify, s.metric_override) == ("x", 64, 100, 5, True, False)


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["probe_id", "n_common", "overlap", "cosine"] and df.count() == 100
    q, o = e.queries(), e.oracle_sql()
    assert set(o) <= set(q)
    assert {n for n in set(q) - set(o) if not n.startswith("op") and n != "pipeline"} == set()


def test_reader_registry():
    from embedflow.sources import reader

    assert reader("Points").__name__ == "from_points"
    with pytest.raises(ValueError, match="available"):
        reader("nope")


def test_progress_and_batch_callbacks(spark):
    src, _ = make_records(spark, 40, 8, 0)
    seen = {}
    res = migrate(
        src,
        scratch_path(spark, "m"),
        JobSpec(batch_size=16, semantic_verify=False),
        on_progress=lambda m: seen.update(m),
        on_batch=lambda df: seen.update(batches_seen=df.count()),
    )
    assert seen["rows_written"] == 40 and seen["total"] == 40 and seen["batches"] == seen["batches_seen"] >= 3
    assert res.integrity.first()["verified"] == 40


def test_pluggable_knn(spark):
    from embedflow.operators import knn

    a, _ = make_records(spark, 30, 8, 1)
    calls = []

    def my_knn(d, p, k, m):
        calls.append(m)
        return knn.knn_topk(d, p, k, m, "expr", keep_vectors=True)

    _, summary = knn.semantic_validate(a, a, n_probes=5, top_k=3, knn_fn=my_knn)
    assert summary.first()["passed"] and calls == ["cosine", "cosine"]


def test_shuffled_input_has_the_same_batches(spark):
    src, _ = make_records(spark, 50, 8, 2)
    res = migrate(src.repartition(4), scratch_path(spark, "m"), JobSpec(batch_size=16, semantic_verify=False))
    i = res.integrity.first()
    assert i["transferred"] == i["verified"] == 50 and i["batches"] == 4  # global batches of 16


def test_rows_with_null_ids_stay_and_are_copied_once(spark):
    src, _ = make_records(spark, 12, 8, 0)
    src = src.withColumn("id", F.when(F.col("id") >= "v0003", F.col("id")))
    root, spec = scratch_path(spark, "m"), JobSpec(batch_size=4, semantic_verify=False)
    assert migrate(src, root, spec).target().where("id is null").count() == 3
    for mode in ("full", "incremental"):
        res = migrate(src, root, JobSpec(mode=mode, batch_size=4, semantic_verify=False))
        assert res.integrity.first()["transferred"] == 0 and res.cumulative.first()["transferred"] == 12
        assert res.target().count() == 12 and res.target().where("id is null").count() == 3
    changed = src.withColumn("namespace", F.when(F.col("metadata")["n"] == "0", F.lit("new")).otherwise(F.col("namespace")))
    res = migrate(changed, root, JobSpec(mode="incremental", batch_size=4, semantic_verify=False))
    assert res.integrity.first()["transferred"] == 3  # the changed row and those that share its id
    assert sorted((r["metadata"]["n"], r["namespace"] or "") for r in res.target().where("id is null").collect()) == [("0", "new"), ("1", ""), ("2", "")]


def test_a_repeated_id_is_verified_without_collecting_its_rows(spark):
    from embedflow.plans.migrate import verify_run

    src, _ = make_records(spark, 1, 8, 0)
    src = src.crossJoin(spark.range(3000).select(F.col("id").alias("k"))).withColumn("metadata", F.create_map(F.lit("n"), F.col("k").cast("string"))).drop("k")
    root, spec = scratch_path(spark, "m"), JobSpec(batch_size=16, semantic_verify=False)
    i = migrate(src, root, spec).integrity.first()
    assert (i["transferred"], i["verified"], i["failed"], i["batches"]) == (3000, 3000, 0, 1)
    rows = spark.read.parquet(root + "/data/run=1")
    expected = rows.groupBy("batch_id").agg(F.count("*").alias("sent"))
    plan = verify_run(spark, root, 1, expected, spec)._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "partial_sum" in plan
    other = F.create_map(F.lit("n"), F.lit("x"))
    rows.withColumn("metadata", F.when(F.col("metadata")["n"] == "2999", other).otherwise(F.col("metadata"))).write.parquet(root + "/data/run=2")
    assert verify_run(spark, root, 2, expected, spec).first()["failed"] == 3000


@pytest.mark.parametrize("ordered", [False, True])
def test_lost_repeated_and_altered_rows_fail_their_batch(spark, ordered):
    """The proof comes from the source: a target whose stored digests all agree with its rows isn't enough."""
    from embedflow.plans.migrate import read_target, verify_run

    src, _ = make_records(spark, 24, 8, 0)
    spec = JobSpec(batch_size=4, semantic_verify=False, ordered_batches=ordered)
    root = scratch_path(spark, "m")
    assert migrate(src, root, spec).integrity.first()["verified"] == 24
    expected = spark.read.parquet(root + "/_expected/run=1")
    rows = spark.read.parquet(root + "/data/run=1").cache()
    batch, members = rows.groupBy("batch_id").agg(F.sort_array(F.collect_set("id")).alias("ids")).where("size(ids) > 1").orderBy("batch_id").first()
    lost, twin = members[0], members[1]
    other = rows.where(F.col("batch_id") != batch).first()["id"]
    flipped = F.when(F.col("id") == lost, F.transform("vector", lambda x: -x)).otherwise(F.col("vector"))
    cases = {
        "lost and another one repeated": rows.where(F.col("id") != lost).unionByName(rows.where(F.col("id") == twin)),
        "lost": rows.where(F.col("id") != lost),
        "repeated": rows.unionByName(rows.where(F.col("id") == lost)),
        "altered": rows.withColumn("vector", flipped),
        "replaced by a row of another batch": rows.where(F.col("id") != lost).unionByName(rows.where(F.col("id") == other).withColumn("batch_id", F.lit(batch))),
    }
    for n, (what, target) in enumerate(cases.items(), 2):
        target.drop("run").write.parquet(f"{root}/data/run={n}")
        found = {r["batch_id"]: r for r in verify_run(spark, root, n, expected, spec).collect()}
        assert {b for b, r in found.items() if r["failed"]} == {batch}, what
        assert found[batch]["verified"] == 0 and sum(r["verified"] for r in found.values()) == 24 - len(members), what
    assert read_target(spark, root).count() == 24
