"""Property tests (hypothesis): invariants over generated inputs, few examples each (Spark jobs are slow)."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from embedflow.functions.vectors import fixed_point, fixed_point_np
from embedflow.operators import batching, knn
from embedflow.operators import upsert as U
from tests.conftest import make_records

FEW = settings(max_examples=4, deadline=None)


@FEW
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True, width=64), min_size=1, max_size=300))
def test_fixed_point_python_equals_spark(spark, vals):
    df = spark.createDataFrame([(vals,)], "v array<double>")
    assert df.select(fixed_point("v")).first()[0] == list(fixed_point_np(np.array(vals, dtype=np.float64)))


@FEW
@given(st.integers(1, 120), st.integers(1, 40), st.integers(1, 6))
def test_batches_partition_the_rows(spark, n, size, ranges):
    df, _ = make_records(spark, n, 2, n)
    rows = batching.assign_batches(df, size, n_ranges=ranges).collect()
    assert sorted(r["rn"] for r in rows) == list(range(n))
    for r in rows:
        assert r["batch_id"] == r["rn"] // size and r["pos"] == r["rn"] % size
    order = sorted(rows, key=lambda r: r["rn"])
    assert [r["id"] for r in order] == sorted(r["id"] for r in rows)


@FEW
@given(st.integers(0, 10_000), st.integers(1, 7), st.sampled_from(["cosine", "dot", "l2"]))
def test_block_equals_expression_knn(spark, seed, k, metric):
    df, _ = make_records(spark, 40, 6, seed, unit=False)
    probes = knn.make_probes(spark, 5, 6, seed=str(seed))
    a = knn.knn_topk(df.repartition(3), probes, k, metric, "block").select("probe_id", "rank", "id").collect()
    b = knn.knn_topk(df, probes, k, metric, "expr").select("probe_id", "rank", "id").collect()
    assert sorted(a) == sorted(b)


@FEW
@given(st.integers(0, 30), st.integers(0, 30), st.integers(0, 99))
def test_upsert_replace_semantics(spark, n_t, n_s, seed):
    tgt, _ = make_records(spark, max(n_t, 1), 3, seed)
    src, _ = make_records(spark, max(n_s, 1), 3, seed + 1)
    tgt, src = tgt.limit(n_t), src.where(F.col("id") >= "v0005").limit(n_s)
    out = {r["id"]: r["vector"] for r in U.upsert_replace(tgt, src).collect()}
    t, s = {r["id"]: r["vector"] for r in tgt.collect()}, {r["id"]: r["vector"] for r in src.collect()}
    assert set(out) == set(t) | set(s)
    assert all(out[i] == v for i, v in s.items())
    assert all(out[i] == v for i, v in t.items() if i not in s)
