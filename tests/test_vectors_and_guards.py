import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.functions import vectors as V
from embedflow.operators import guards
from tests.conftest import make_records


def test_dot_norm_cosine_match_numpy(spark):
    df, vecs = make_records(spark, 20, 16, 3, unit=False)
    out = df.select("id", V.dot("vector", "vector").alias("dd"), V.norm("vector").alias("n"), V.cosine("vector", F.reverse("vector")).alias("c")).orderBy("id").collect()
    for r, v in zip(out, vecs):
        v = v.astype(np.float64)
        assert r["dd"] == pytest.approx(float(v @ v), rel=1e-12)
        assert r["n"] == pytest.approx(float(np.linalg.norm(v)), rel=1e-12)
        w = v[::-1]
        assert r["c"] == pytest.approx(float(v @ w / (np.linalg.norm(v) * np.linalg.norm(w) + 1e-9)), rel=1e-9)


def test_l2_normalise_gives_unit_vectors(spark):
    df, _ = make_records(spark, 30, 8, 1, unit=False)
    norms = [r[0] for r in df.select(V.norm(V.l2_normalise("vector"))).collect()]
    assert all(abs(n - 1) < 1e-6 for n in norms)


@pytest.mark.parametrize(
    "src,tgt,override,expect",
    [
        ("cos", "cosine", False, "ok"),
        ("l2", "euclidean", False, "ok"),
        ("dot", "ip", False, "ok"),
        ("dot_product", "dot", False, "ok"),
        ("COSINE", "Cos", False, "ok"),
        ("cosine", "l2", False, "mismatch"),
        ("dot", "cosine", False, "mismatch"),
        ("cosine", "l2", True, "override"),
    ],
)
def test_metric_guard_pairs(spark, src, tgt, override, expect):
    if expect == "mismatch":
        with pytest.raises(guards.MetricMismatchError):
            guards.validate_metrics(src, tgt, override)
    else:
        assert guards.validate_metrics(src, tgt, override) == expect
    df = spark.createDataFrame([(src, tgt, override)], "s string, t string, o boolean")
    assert df.select(guards.metric_verdict("s", "t", "o")).first()[0] == expect


def test_metric_normalise_unknown_maps_to_itself(spark):
    df = spark.createDataFrame([("Manhattan",), ("EUCLID",)], "m string")
    assert [r[0] for r in df.select(V.metric_normalise_col("m")).collect()] == ["manhattan", "l2"]


def test_dimension_guard(spark):
    with pytest.raises(guards.DimensionMismatchError):
        guards.validate_dimensions(64, 32)
    guards.validate_dimensions(0, 32)  # unknown side: no error
    a, _ = make_records(spark, 10, 8, 0)
    b, _ = make_records(spark, 10, 4, 0)
    verdicts = {r["side"]: r["verdict"] for r in guards.dimension_check(a, b).collect()}
    assert verdicts == {"source": "mismatch", "target": "mismatch"}


def test_dimension_check_reports_ragged_rows(spark):
    a, _ = make_records(spark, 10, 8, 0)
    ragged = a.withColumn("vector", F.when(F.col("id") == "v0003", F.slice("vector", 1, 5)).otherwise(F.col("vector")))
    rows = {r["side"]: r for r in guards.dimension_check(a, ragged).collect()}
    assert rows["target"]["n_ragged"] == 1 and rows["target"]["verdict"] == "ragged"
    assert rows["source"]["modal_dim"] == 8


def test_norm_profile_flags_one_sided_normalisation(spark):
    a, _ = make_records(spark, 20, 8, 0, unit=True)
    b, _ = make_records(spark, 20, 8, 0, unit=False)
    pa, pb = guards.norm_profile(a, "a").first(), guards.norm_profile(b, "b").first()
    assert pa["unit_share"] == 1.0 and pb["unit_share"] < 0.5


def test_dimension_order_check_finds_permutation(spark):
    a, _ = make_records(spark, 10, 8, 0)
    b = a.withColumn("vector", F.reverse("vector"))
    out = guards.dimension_order_check(a, b).collect()
    assert all(r["n_permuted"] == 10 for r in out)
    same = guards.dimension_order_check(a, a).collect()
    assert all(r["max_abs_diff"] == 0 and r["n_permuted"] == 0 for r in same)


def test_empty_and_null_vectors_are_rejected(spark):
    from embedflow.operators import guards

    df = spark.createDataFrame([("a", [1.0]), ("b", []), ("c", None)], "id string, vector array<float>")
    assert {r["id"]: r["s"] for r in df.select("id", guards.vector_status().alias("s")).collect()} == {"a": "kept", "b": "rejected", "c": "rejected"}
