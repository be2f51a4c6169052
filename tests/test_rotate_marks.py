import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.operators import marks, rotate
from tests.conftest import make_records


@pytest.mark.parametrize("seed", ["1", "2", "7", "42"])
def test_key_is_orthogonal(spark, seed):
    K = rotate.collect_key(rotate.key_table(spark, seed, 64))
    assert np.allclose(K @ K.T, np.eye(64), atol=1e-5)


def test_round_trip_and_paths_agree(spark):
    df, vecs = make_records(spark, 30, 64, 4)
    K = rotate.collect_key(rotate.key_table(spark, "s", 64))
    rot = {r["id"]: np.array(r["vector"]) for r in rotate.rotate(df, "s", 64).collect()}
    back = {r["id"]: np.array(r["vector"]) for r in rotate.rotate(rotate.rotate(df, "s", 64), "s", 64, inverse=True).collect()}
    mat = {r["id"]: np.array(r["vector"]) for r in rotate.rotate_with_matrix(df, K).collect()}
    for i, v in enumerate(vecs):
        rid = f"v{i:04d}"
        assert np.allclose(back[rid], v, atol=1e-4)
        assert np.allclose(rot[rid], v.astype(np.float64) @ K, atol=1e-5)
        assert np.allclose(mat[rid], rot[rid], atol=1e-5)


def test_gaussian_mark_cases(spark):
    df, vecs = make_records(spark, 200, 64, 5)
    seed = b"s" * 32
    batched = df.withColumn("batch_id", (F.substring("id", 2, 4).cast("int") / 2).cast("bigint"))  # more batches than are cached
    marked = marks.apply_gaussian_mark(batched, seed, strength=1.0)
    rows = {r["id"]: r for r in marks.gaussian_mark_verdicts(marked, seed, threshold=0.3).collect()}
    assert all(r["verified"] for r in rows.values())
    for i, v in enumerate(vecs):
        want = v + marks.gaussian_mark(seed, i // 2, 64)
        assert np.allclose(rows[f"v{i:04d}"]["vector"], want / np.linalg.norm(want), atol=1e-6)
    other = marked.withColumn("batch_id", F.col("batch_id") + 1)
    assert not any(r["verified"] for r in marks.gaussian_mark_verdicts(other, seed, threshold=0.95).collect())
    assert not any(r["verified"] for r in marks.gaussian_mark_verdicts(marked, b"t" * 32, threshold=0.95).collect())
    zero = batched.withColumn("vector", F.array_repeat(F.lit(0.0).cast("float"), 64))
    assert not any(r["verified"] for r in marks.gaussian_mark_verdicts(zero, seed).collect())
    ragged = batched.withColumn("vector", F.slice("vector", 1, (F.substring("id", 5, 1).cast("int") + 1)))
    assert {len(r["vector"]) for r in marks.apply_gaussian_mark(ragged, seed).collect()} == set(range(1, 11))


def test_byte_mark_recovery(spark):
    df, _ = make_records(spark, 40, 64, 2)
    m = marks.apply_byte_mark(df.withColumn("batch_id", F.lit(3).cast("bigint")))
    r = marks.recovery(m).first()
    assert r["avg_cosine"] > 0.99 and r["share_099"] == 1.0
    wrong = m.withColumn("mark", marks.byte_mark(F.lit(4), F.size("vector")))
    right = m.select(marks.mark_cosine().alias("c")).agg(F.avg("c")).first()[0]
    other = wrong.select(marks.mark_cosine().alias("c")).agg(F.avg("c")).first()[0]
    assert right > other
