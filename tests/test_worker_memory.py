"""Small tables come to executors without a job in their Python workers."""

import subprocess
import sys
import time

import numpy as np
import pyarrow as pa
import pytest

import embedflow
from embedflow.functions import arrowvec
from embedflow.functions.digest import flat_floats
from embedflow.operators import batching, frames
from embedflow.plans import ledger_queries, transport_queries
from tests.conftest import SF_SMALL, make_records


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_tables_make_no_python_job(spark):
    df, _ = make_records(spark, 40, 8, 1)
    numbered = batching.number_rows(df, ["id"])
    for d in (numbered, ledger_queries.plans(spark)):
        assert "ExistingRDD" not in _plan(d) and "LocalTableScan" in _plan(d)
    assert [r["rn"] for r in numbered.orderBy("id").collect()] == list(range(40))
    assert batching.number_rows(df.where("id < ''"), ["id"]).count() == 0
    assert [tuple(r) for r in ledger_queries.plans(spark).collect()] == ledger_queries.PLANS


def test_latest_report_reads_no_list_through_python(spark):
    assert "ExistingRDD" not in _plan(ledger_queries.latest_report(spark, SF_SMALL))


def test_sealing_and_checking_workers_do_not_load_pandas(spark):
    def loaded(batches):
        """Of the worker: whether it has the frames' module, and pandas."""
        for batch in batches:
            time.sleep(0.5)
            has = [m in sys.modules for m in ("embedflow.operators.frames", "pandas")]
            yield pa.RecordBatch.from_arrays([arrowvec.column(np.array([h], np.int64)) for h in has], names=["frames", "pandas"])

    df, _ = make_records(spark, 200, 8, 5, namespace="n")
    here = spark.sparkContext.environment
    here["EMBEDFLOW_FRESH"] = "frames"  # workers of another environment are new ones
    try:
        sealed = frames.seal_batches(batching.assign_batches(df, 16), job="namespace").repartition(4)
        got = frames.receive(transport_queries.tampered(sealed)).collect()
        assert sum(r["received"] for r in got) == 200 and 0 < sum(r["verified"] for r in got) < 200
        seen = spark.range(0, 4, 1, 4).mapInArrow(loaded, "frames bigint, pandas bigint").collect()
    finally:
        del here["EMBEDFLOW_FRESH"]
    used = [r for r in seen if r["frames"]]
    assert used and not any(r["pandas"] for r in used)


def test_the_package_loads_what_is_asked_for():
    code = "import sys, embedflow; from embedflow.operators import frames; assert 'pandas' not in sys.modules; assert embedflow.knn_topk and embedflow.plans.QUERIES"
    subprocess.run([sys.executable, "-c", code], check=True, env={"PYTHONPATH": ":".join(sys.path)})
    assert all(getattr(embedflow, name) is not None for name in dir(embedflow) if not name.startswith("__"))
    with pytest.raises(AttributeError):
        embedflow.nothing_of_that_name


def test_arrays_by_buffers():
    assert arrowvec.column(np.arange(6, dtype=np.int64)[::2]).to_pylist() == [0, 2, 4]
    assert arrowvec.binary([b"a", b"", b"xyz"]).to_pylist() == [b"a", b"", b"xyz"] and arrowvec.binary([]).to_pylist() == []
    assert arrowvec.binary(["é".encode()], pa.string()).to_pylist() == ["é"]
    assert arrowvec.numbers(pa.array([1.5, 2.5, 3.5]).slice(1)).tolist() == [2.5, 3.5]
    for rows in ([[1.0, 2.0], [], [3.0]], [[1.0, None], None, [3.0]], []):
        flat, offs = flat_floats(pa.array([[9.0], *rows], pa.list_(pa.float32())).slice(1))
        assert np.array_equal(flat, np.array([x for r in rows for x in r or []], np.float32), equal_nan=True)
        assert offs.tolist() == np.cumsum([0, *(len(r or []) for r in rows)]).tolist()
