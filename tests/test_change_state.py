"""Change state by buckets of keys: few groups, and rows that come back as they were."""

import datetime as dt
import math
import os

import pandas as pd

from embedflow.plans.store_queries import drain
from embedflow.session import scratch_path
from embedflow.sources import paged_store as P
from embedflow.streaming import state

T0 = dt.datetime(2024, 1, 1)


class Entries(dict):
    reads = writes = 0

    def getValue(self, key):
        self.reads += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.writes += 1
        self[key] = value


def chunk(rows):
    return pd.DataFrame([(0, k, us, seq, f"{k}{us}{seq}") for k, us, seq in rows], columns=["bucket", "state_key", "us", "seq", "row_json"])


def test_a_group_holds_many_keys_and_reads_each_once():
    c = state.ChangeClassifier()
    c.last = entries = Entries({("a",): (5, 0)})
    chunks = [chunk([("a", 4, 9), ("b", 1, 1), ("a", 6, 0), (None, 1, 1), ("b", 1, 1)]), chunk([("a", 7, 0), (None, 1, 2), ("a", 6, 5)])]
    got = pd.concat(c.handleInputRows((0,), iter(chunks), None))
    changes = sorted(zip(got["row_json"], got["change"]))
    assert changes == sorted([("a49", "stale"), ("b11", "insert"), ("a60", "stale"), ("None11", "stale"), ("b11", "stale"), ("a70", "update"), ("None12", "insert"), ("a65", "stale")])
    assert (entries.reads, entries.writes) == (3, 3)
    assert entries == {("a",): (7, 0), ("b",): (1, 1), (None,): (1, 2)}


def test_many_keys_make_few_groups_and_rows_keep_every_value(spark):
    path, out = scratch_path(spark, "t-buckets"), scratch_path(spark, "t-buckets-out")
    odd = dt.datetime(2024, 3, 31, 1, 30, 0, 123457)
    big = 2**62 + 1
    rows = [("x", big, odd, float("nan"), True, {"a": None, "b": 'q"\n'}), ("x", None, odd, None, None, None), (None, 3, None, -0.0, False, {})]
    rows += [(f"k{i}", i, T0, float(i), True, {}) for i in range(3000)]
    schema = "id string, seq bigint, updated_at timestamp, value double, flag boolean, tags map<string,string>"
    P.write_pages(spark.createDataFrame(rows, schema), path, ["updated_at", "seq"])
    stream = P.read_feed(spark, path, os.path.join(out + "-checkpoint", "position.json"), max_commits=1)
    found = state.classify_changes(stream, "id", "updated_at", "seq")
    assert found.columns == [*stream.columns, "change"] and [f.dataType for f in found.schema][:-1] == [f.dataType for f in stream.schema]
    drain(found, out, out + "-checkpoint")
    got = {(r["id"], r["seq"]): r for r in spark.read.schema(found.schema).parquet(out).collect()}
    assert len(got) == len(rows)
    for k, seq, at, value, flag, tags in rows:
        r = got[k, seq]
        assert (r["updated_at"], r["flag"], r["tags"]) == (at, flag, tags)
        assert (value is None and r["value"] is None) or (math.isnan(value) and math.isnan(r["value"])) or (value, math.copysign(1, value)) == (r["value"], math.copysign(1, r["value"]))
        assert r["change"] == ("stale" if k == "x" and seq is None else "insert")
    assert state.BUCKETS < 3000
