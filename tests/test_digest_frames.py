import hashlib
import hmac

import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.functions import digest as D
from embedflow.functions.hashing import hmac_sha256_hex
from embedflow.functions.vectors import fixed_point_np
from embedflow.operators import batching, frames
from tests.conftest import make_records


def test_hmac_column_equals_stdlib(spark):
    df = spark.createDataFrame([("00ff" * 16, "hello"), ("ab" * 32, ""), ("01", "x" * 300)], "k string, m string")
    for r in df.select("k", "m", hmac_sha256_hex(F.col("k"), F.col("m")).alias("h")).collect():
        assert r["h"] == hmac.new(bytes.fromhex(r["k"]), r["m"].encode(), hashlib.sha256).hexdigest()


def test_fixed_point_matches_spark_round(spark):
    vals = [0.5e-6, -0.5e-6, 1.5e-6, -2.5e-6, 0.1234565, -0.9999995, 3.0e-7]
    df = spark.createDataFrame([(vals,)], "v array<double>")
    spark_fp = df.select(F.transform("v", lambda x: F.round(x * 1e6).cast("bigint"))).first()[0]
    assert list(fixed_point_np(np.array(vals))) == spark_fp


def test_non_finite_values_have_codes(spark):
    vals = [float("nan"), float("inf"), float("-inf"), 1e300, -1e300, 1.0]
    df = spark.createDataFrame([(vals,)], "v array<double>")
    from embedflow.functions.vectors import fixed_point

    assert df.select(fixed_point("v")).first()[0] == list(fixed_point_np(np.array(vals)))


def test_batch_digest_python_equals_spark(spark):
    df, vecs = make_records(spark, 40, 8, 2)
    b = batching.assign_batches(df, 16)
    sd = {r["batch_id"]: r["digest"] for r in D.batch_digests(b).collect()}
    rows = b.select("batch_id", "id", "vector", D.meta_json().alias("meta"), "namespace").collect()
    for bid in sd:
        part = [r for r in rows if r["batch_id"] == bid]
        columns = [[r[c] for r in part] for c in ("id", "vector", "meta", "namespace")]
        assert D.batch_digest_py(bid, *columns) == sd[bid]


def test_digest_changes_with_any_edit(spark):
    ids, vecs = ["a", "b"], [np.ones(4, np.float32), np.zeros(4, np.float32)]
    base = D.batch_digest_py(0, ids, vecs)
    assert D.batch_digest_py(1, ids, vecs) != base  # batch id is covered
    assert D.batch_digest_py(0, ids[:1], vecs[:1]) != base  # count
    v2 = [vecs[0].copy(), vecs[1]]
    v2[0][2] = np.nextafter(v2[0][2], np.float32(2))  # the last bit
    assert D.batch_digest_py(0, ids, v2) != base
    assert D.batch_digest_py(0, ["b", "a"], [vecs[1], vecs[0]]) == base  # order inside a batch is irrelevant


def test_sealed_round_trip_and_layout():
    rng = np.random.default_rng(0)
    vecs = list(rng.standard_normal((20, 64)).astype(np.float32))
    ids = [f"v{i}" for i in range(20)]
    frame = frames.pack_sealed(7, ids, vecs, ["{}"] * 20)
    assert frame[:4] == frames.MAGIC
    bid, ids2, vecs2, metas, spaces, ok = frames.unpack_sealed(frame)
    assert ok and bid == 7 and spaces == [None] * 20 and ids2 == ids and metas == ["{}"] * 20
    assert all(np.array_equal(a, b) for a, b in zip(vecs, vecs2))
    assert sum(v.nbytes for v in vecs2) == 20 * 64 * 4


@pytest.mark.parametrize("ids", [["a1", "b2", "c3"], ["a", "long id", "é"]])
@pytest.mark.parametrize("spaces", [["n", "m", "o"], ["n", None, "longer"], [None] * 3])
def test_records_of_one_size_and_of_many_read_back_alike(ids, spaces):
    vecs = [np.arange(3, dtype=np.float32) + i for i in range(3)]
    metas = ['{"k":"1"}', '{"k":"2"}', None]
    bid, ids2, vecs2, metas2, spaces2, ok = frames.unpack_sealed(frames.pack_sealed(2, ids, vecs, metas, spaces))
    assert ok and ids2 == ids and spaces2 == spaces and metas2 == ['{"k":"1"}', '{"k":"2"}', "{}"]
    assert all(np.array_equal(a, b) for a, b in zip(vecs, vecs2))
    ids3, vecs3 = frames.unpack_binary(frames.pack_binary(ids, vecs))
    assert ids3 == ids and all(np.array_equal(a, b) for a, b in zip(vecs, vecs3))


def test_empty_batch_is_empty_bytes():
    assert frames.pack_sealed(0, [], [], []) == b""
    assert frames.pack_binary([], []) == b""


def test_tampered_frame_fails_verification():
    vecs = [np.ones(8, np.float32) * 0.5 for _ in range(3)]
    frame = bytearray(frames.pack_sealed(1, ["a", "b", "c"], vecs, ["{}"] * 3))
    frame[frames.SEALED_HEADER + 3] ^= 0x40
    assert not frames.unpack_sealed(bytes(frame))[-1]
    changed_digest = bytearray(frames.pack_sealed(1, ["a", "b", "c"], vecs, ["{}"] * 3))
    changed_digest[25] ^= 1
    assert not frames.unpack_sealed(bytes(changed_digest))[-1]


def test_any_changed_byte_of_a_sealed_frame_is_noticed():
    """One bit of a float, of an id, of metadata, of a namespace, or of the header."""
    frame = frames.pack_sealed(1, ["a", "bb"], [np.ones(2, np.float32), np.zeros(2, np.float32)], ['{"k":"v"}', None], ["007", None])
    assert frames.unpack_sealed(frame)[-1]
    for i in range(4, len(frame)):
        damaged = bytearray(frame)
        damaged[i] ^= 1
        try:
            assert not frames.unpack_sealed(bytes(damaged))[-1], i
        except (frames.FrameError, UnicodeDecodeError):
            pass


def test_float_bits_definition(spark):
    values = [0.0, -0.0, 1.0, -1.0, 0.1, 2.0**-126, 2.0**-149, -(2.0**-140), 3.4e38, float("inf"), float("-inf"), float("nan"), 1 - 2.0**-24, 2.0**-30 * 1.5]
    v = np.array(values, np.float32)
    df = spark.createDataFrame([([float(x) for x in v],)], "v array<float>")
    got = df.select(F.transform("v", D.float_bits_hex)).first()[0]
    assert "".join(got).lower() == D.float_bits(v).hex()


def test_bad_magic_and_ragged_batch_raise():
    with pytest.raises(frames.FrameError):
        frames.unpack_sealed(b"XXXX" + b"\0" * 60)
    with pytest.raises(frames.FrameError):
        frames.pack_sealed(0, ["a", "b"], [np.ones(4), np.ones(3)], ["{}", "{}"])


def test_binary_round_trip():
    vecs = [np.arange(4, dtype=np.float32) + i for i in range(5)]
    ids, back = frames.unpack_binary(frames.pack_binary([f"id{i}" for i in range(5)], vecs))
    assert ids == [f"id{i}" for i in range(5)] and all(np.array_equal(a, b) for a, b in zip(vecs, back))


def test_seal_unseal_in_spark_keeps_ids_in_order(spark):
    df, _ = make_records(spark, 50, 16, 3)
    b = batching.assign_batches(df, 16)
    rows = frames.unseal_batches(frames.seal_batches(b)).collect()
    assert len(rows) == 50 and all(r["verified"] for r in rows)
    by_batch = {}
    for r in rows:
        by_batch.setdefault(r["batch_id"], []).append((r["pos"], r["id"]))
    for items in by_batch.values():
        assert [i for _, i in sorted(items)] == sorted(i for _, i in items)


def test_jvm_definition_equals_arrow_path(spark):
    df, _ = make_records(spark, 60, 24, 7, unit=False)
    df = df.unionByName(df.limit(2).withColumn("id", F.concat(F.lit("empty-"), "id")).withColumn("vector", F.array().cast("array<float>")))
    df = df.withColumn("namespace", F.when(F.col("id") < "v0030", F.lit("007")))
    a = {r["id"]: r["d"] for r in df.select("id", D.row_digest(meta=D.meta_json(), namespace=F.col("namespace")).alias("d")).collect()}
    b = {r["id"]: r["rd"] for r in D.with_row_digests(df, ["id"]).collect()}
    assert a == b and len(a) == 62
    for r in df.withColumn("meta", D.meta_json()).collect():
        assert D.row_digest_py(r["id"], np.array(r["vector"], np.float32), r["meta"], r["namespace"]) == a[r["id"]]


def test_lists_from_sliced_arrays():
    import pyarrow as pa

    arr = pa.array([[1.0], [2.0, 3.0], None, [4.0]], pa.list_(pa.float32()))[1:]
    flat, offsets = D.flat_floats(arr)
    assert flat.tolist() == [2.0, 3.0, 4.0] and offsets.tolist() == [0, 2, 2, 3]


def test_seal_splits_needs_no_shuffle_and_round_trips(spark):
    df, _ = make_records(spark, 70, 16, 5)
    df = df.repartition(3)
    fr = frames.seal_splits(df, 16)
    assert fr._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1  # only the repartition above
    rows = frames.unseal_batches(fr).collect()
    assert len(rows) == 70 and all(r["verified"] for r in rows)
    assert sorted(r["id"] for r in rows) == sorted(r["id"] for r in df.collect())
    counts = [r["count"] for r in fr.collect()]
    assert all(c <= 16 for c in counts) and sum(counts) == 70


def test_binary_splits_round_trip(spark):
    df, _ = make_records(spark, 45, 8, 6)
    fr = frames.pack_binary_splits(df.repartition(2), 10)
    rows = frames.unpack_binary_batches(fr.select("batch_id", "frame")).collect()
    assert sorted(r["id"] for r in rows) == sorted(r["id"] for r in df.collect())
