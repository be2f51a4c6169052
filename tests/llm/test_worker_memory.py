"""What the training-data operators' Python workers hold, and how many of them the pipeline's tasks have."""

import sys
import time

import pyarrow as pa
import pytest

import corpus_pipeline as p
from embedflow.functions import arrowvec
from embedflow.llm import textmap
from tests.conftest import SF_SMALL
from tests.llm.helpers import docs

SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64())])
BUILT = [
    (pa.int64(), [1, None, -(2**63)]), (pa.int32(), [1, 2]), (pa.float64(), [None, 0.5, float("inf")]), (pa.float32(), [0.25]),
    (pa.bool_(), [True, None, False] * 5), (pa.string(), ["é\U0001f600", None, ""]), (pa.binary(), [b"\x00a", None, b""]),
    (pa.list_(pa.binary()), [[b"a", None], None, []]), (pa.list_(pa.float64()), [[1.0], [], [2.0, None]]),
    (pa.list_(SPAN), [[{"kind": "hex", "start": 3}, None], [], None, [{"kind": None, "start": None}]]),
    (pa.date32(), [None]),
]


@pytest.mark.parametrize("kind, values", BUILT, ids=str)
def test_arrays_as_the_library_makes_them(kind, values):
    for some in (values, values[:1], []):
        made = arrowvec.built(some, kind)
        made.validate(full=True)
        assert made.equals(pa.array(some, kind))
    with pytest.raises(Exception):
        arrowvec.built([2**63], pa.int64())


def test_text_workers_do_not_load_pandas(spark):
    def loaded(batches):
        for batch in batches:
            time.sleep(0.5)
            has = [m in sys.modules for m in (textmap.__name__, "pandas")]
            yield pa.RecordBatch.from_arrays([arrowvec.built([int(h)], pa.int64()) for h in has], names=["text", "pandas"])

    here = spark.sparkContext.environment
    here["EMBEDFLOW_FRESH"] = "text"  # workers of another environment are new ones
    try:
        table = docs(spark, ["some words", "password = hunter2hunter2", None]).repartition(4)
        found = [p.secrets(spark, table, SF_SMALL), p.near_duplicates(spark, table, SF_SMALL), p.tokens(spark, table, SF_SMALL)]
        assert [d.count() for d in found] == [3, 3, 3]
        assert len(found[2].where("round_trip").collect()) == 3
        seen = spark.range(0, 4, 1, 4).mapInArrow(loaded, "text bigint, pandas bigint").collect()
    finally:
        del here["EMBEDFLOW_FRESH"]
    used = [r for r in seen if r["text"]]
    assert used and not any(r["pandas"] for r in used)


def test_ids_are_written_before_they_are_decoded(spark):
    plan = p.tokens(spark, docs(spark, ["some words", None]), SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "token-ids-" in plan
