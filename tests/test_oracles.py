"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from oracle_check import TABLES, rows_multiset  # noqa: E402
from tests.conftest import SF_SMALL  # noqa: E402


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF_SMALL, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


FORBIDDEN_PLAN_NODES = ("CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN_PLAN_NODES:
        assert node not in plan, f"{name} plans a {node}"
    rows = [tuple(r) for r in df.collect()]
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert len(rows) > 0
        return
    rel = duck.sql(sql)
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert rows_multiset(df.columns, rows) == rows_multiset(rel.columns, o_rows)
