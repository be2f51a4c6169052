"""Plan checks: data-sized operators never funnel rows through one partition."""

import pytest
from pyspark.sql import functions as F

from embedflow.functions.digest import batch_digests
from embedflow.operators import batching, knn, progress
from embedflow.operators import reconcile as R
from embedflow.operators import upsert as U
from tests.conftest import make_records


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def data(spark):
    df, _ = make_records(spark, 64, 8, 0)
    return df


CASES = {
    "number_rows": lambda df: batching.number_rows(df, ["id"]),
    "assign_batches_grouped": lambda df: batching.assign_batches(df.withColumn("namespace", F.substring("id", 1, 3)), 8, group="namespace"),
    "running_sum": lambda df: progress.running_sum(df.select(F.substring("id", 1, 3).alias("g"), F.substring("id", 2, 4).cast("int").alias("o"), F.lit(1).alias("x")), "g", "o", ["x"]),
    "nearest_rank": lambda df: progress.nearest_rank(df.select(F.substring("id", 1, 3).alias("g"), F.col("vector")[0].alias("v"), "id"), "g", "v", [50, 99], tie="id"),
    "latest": lambda df: progress.latest(df.select(F.substring("id", 1, 3).alias("g"), "id"), "g", ["id"]),
    "knn_topk": lambda df: knn.knn_topk(df, knn.make_probes(df.sparkSession, 4, 8), 3),
    "reconcile": lambda df: R.reconcile(df, df),
    "upsert_replace": lambda df: U.upsert_replace(df, df),
    "batch_digests": lambda df: batch_digests(batching.assign_batches(df, 16)),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_no_single_partition_exchange(data, name):
    plan = _plan(CASES[name](data))
    assert "SinglePartition" not in plan, plan
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_knn_shuffles_candidates_not_vectors(data):
    plan = knn.knn_topk(data, knn.make_probes(data.sparkSession, 4, 8), 3)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    # one exchange (by probe_id) after the per-task top-k; the scan feeds MapInArrow directly
    assert text.count("Exchange hashpartitioning(probe_id") == 1
    assert "WindowGroupLimit" in text
