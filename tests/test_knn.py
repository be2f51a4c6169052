import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.operators import knn
from tests.conftest import make_records


def _numpy_topk(vecs, ids, Q, k):
    out = []
    for q in Q:
        s = vecs.astype(np.float64) @ q / (np.linalg.norm(vecs.astype(np.float64), axis=1) * np.linalg.norm(q) + 1e-9)
        order = sorted(range(len(ids)), key=lambda i: (-round(s[i], 9), ids[i]))[:k]
        out.append([ids[i] for i in order])
    return out


def test_block_and_expression_forms_agree_with_numpy(spark):
    df, vecs = make_records(spark, 120, 16, 5)
    probes = knn.make_probes(spark, 12, 16)
    Q = np.array([r["probe"] for r in probes.orderBy("probe_id").collect()])
    ids = [f"v{i:04d}" for i in range(120)]
    expect = _numpy_topk(vecs, ids, Q, 5)
    for method in ("block", "expr"):
        top = knn.knn_topk(df.repartition(5), probes, 5, method=method).orderBy("probe_id", "rank").collect()
        got = [[r["id"] for r in top if r["probe_id"] == p] for p in range(12)]
        assert got == expect, method


@pytest.mark.parametrize("metric", ["dot", "l2"])
def test_other_metrics_agree_between_forms(spark, metric):
    df, _ = make_records(spark, 80, 8, 9, unit=False)
    probes = knn.make_probes(spark, 6, 8)
    a = knn.knn_topk(df.repartition(3), probes, 4, metric, "block").select("probe_id", "rank", "id").collect()
    b = knn.knn_topk(df, probes, 4, metric, "expr").select("probe_id", "rank", "id").collect()
    assert sorted(a) == sorted(b)


def test_ties_are_broken_by_id(spark):
    df, _ = make_records(spark, 10, 8, 0)
    dup = df.union(df.withColumn("id", F.concat(F.lit("a"), "id")))  # every vector twice
    top = knn.knn_topk(dup, knn.make_probes(spark, 3, 8), 2).orderBy("probe_id", "rank").collect()
    for p in range(3):
        ids = [r["id"] for r in top if r["probe_id"] == p]
        assert ids[0].startswith("a") and ids[1] == ids[0][1:]


def test_hot_duplicate_group_stays_small_and_exact():
    import numpy as np

    from embedflow.operators.knn import _batch_candidates

    rng = np.random.default_rng(0)
    S = np.vstack([np.full((5000, 3), 0.9), rng.uniform(-1, 0.8, (100, 3))])  # 5000 rows tie at the top
    ids = np.array([f"h{i:05d}" for i in range(5000)] + [f"o{i:03d}" for i in range(100)], dtype=object)
    r, p = _batch_candidates(S, ids, 4)
    assert len(r) == 12  # k per probe, not 5000
    assert sorted(ids[r[p == 0]]) == ["h00000", "h00001", "h00002", "h00003"]


def test_identical_stores_pass(spark):
    df, _ = make_records(spark, 100, 32, 0)
    scores, summary = knn.semantic_validate(df, df, n_probes=20, top_k=5)
    s = summary.first()
    assert s["passed"] and s["avg_overlap_pct"] == 100.0 and s["n_probes"] == 20
    assert s["avg_cosine_sim"] == pytest.approx(1.0, abs=1e-6)


def test_negative_control_unrelated_vectors_fail(spark):
    a, _ = make_records(spark, 100, 32, 0)
    b, _ = make_records(spark, 100, 32, 99)
    _, summary = knn.semantic_validate(a, b, n_probes=20, top_k=5)
    assert not summary.first()["passed"]


def test_report_fields(spark):
    a, _ = make_records(spark, 50, 16, 1)
    scores, summary = knn.semantic_validate(a, a, n_probes=10, top_k=3)
    assert scores.count() == 10
    assert set(summary.columns) == {"n_probes", "top_k", "avg_overlap_pct", "avg_cosine_sim", "passed"}
    assert summary.first()["top_k"] == 3


def test_empty_target_does_not_pass(spark):
    a, _ = make_records(spark, 30, 8, 1)
    _, summary = knn.semantic_validate(a, a.limit(0), n_probes=5, top_k=3)
    s = summary.first()
    assert s["avg_overlap_pct"] == 0.0 and not s["passed"]


def test_probes_beyond_the_bound_go_in_blocks_and_tiles(spark, monkeypatch):
    df, _ = make_records(spark, 25, 8, 1)
    probes = knn.make_probes(spark, 7, 8)
    found = lambda: sorted((r["probe_id"], r["rank"], r["id"], round(r["score"], 9)) for r in knn.knn_topk(df, probes, 2).collect())
    want = found()
    monkeypatch.setattr(knn, "MAX_PROBE_CELLS", 24)
    monkeypatch.setattr(knn, "MAX_SCORE_CELLS", 40)
    assert found() == want
    assert knn.knn_topk(df, probes.limit(0), 2).count() == 0


@pytest.mark.parametrize("method", ["block", "expr"])
def test_nan_rows_rank_last_and_ragged_rows_are_left_out(spark, method):
    df, _ = make_records(spark, 12, 8, 1)
    nan = df.limit(6).withColumn("id", F.concat(F.lit("a"), "id")).withColumn("vector", F.array_repeat(F.lit(float("nan")).cast("float"), 8))
    short = df.limit(3).withColumn("id", F.concat(F.lit("s"), "id")).withColumn("vector", F.slice("vector", 1, 3))
    mixed = short.union(nan).union(df).coalesce(1)
    assert knn.detect_dim(mixed) == 8
    probes = knn.make_probes(spark, 4, 8)
    got = knn.knn_topk(mixed, probes, 3, method=method, keep_vectors=True).select("probe_id", "rank", "id").collect()
    assert sorted(got) == sorted(knn.knn_topk(df, probes, 3).select("probe_id", "rank", "id").collect())
    every = knn.knn_topk(mixed, probes, 100, method=method).where("probe_id = 0").orderBy("rank").collect()
    assert len(every) == 18 and all(r["id"].startswith("a") for r in every[12:])


def test_near_duplicates_stay_k_rows_a_task():
    import numpy as np

    from embedflow.operators.knn import _batch_candidates

    S = np.round(0.9 + np.arange(10_000)[:, None] * 1e-12, 9)  # all within any float margin
    r, p = _batch_candidates(S, np.array([f"h{i:05d}" for i in range(10_000)], dtype=object), 5)
    assert len(r) == 5


def test_vectors_are_fetched_not_shuffled_as_candidates(spark):
    df, _ = make_records(spark, 64, 8, 0)
    top = knn.knn_topk(df, knn.make_probes(spark, 4, 8), 3, keep_vectors=True)
    lines = top._jdf.queryExecution().optimizedPlan().toString().split("\n")
    windows = [x for x in lines if "Window" in x]
    assert windows and not any("vector" in x for x in windows)
    vectors = {r["id"]: r["vector"] for r in df.collect()}
    assert all(r["vector"] == vectors[r["id"]] for r in top.collect())
