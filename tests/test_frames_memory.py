"""Frames are checked one at a time: a task holds no second copy of a batch of them."""

import tracemalloc

import pyarrow as pa
from pyspark.sql import functions as F

from embedflow.operators import batching, frames
from tests.conftest import make_records


def test_frames_are_copied_one_at_a_time():
    column = pa.array([bytes([n]) * 1_000_000 for n in range(50)] + [None, b""], pa.binary())
    tracemalloc.start()
    try:
        seen = [None if f is None else len(f) for f in frames._one_by_one(column)]
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert seen == [1_000_000] * 50 + [None, 0]
    assert most < 5_000_000  # all of them are 50 MB


def test_received_frames_count_as_before(spark):
    df, _ = make_records(spark, 40, 8, 3, namespace="n")
    sealed = frames.seal_batches(batching.assign_batches(df, 16))
    cut = sealed.withColumn("frame", F.when(F.col("batch_id") == 1, F.expr("substring(frame, 1, 100)")).otherwise(F.col("frame")))
    got = {r["batch_id"]: (r["sent"], r["received"], r["verified"]) for r in frames.receive(cut).collect()}
    assert got == {0: (16, 16, 16), 1: (16, 0, 0), 2: (8, 8, 8)}
    assert frames.unseal_batches(sealed).where("verified").count() == 40
