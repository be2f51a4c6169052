"""Digest trees, bucketed targets, pivot indexes, selection, id dictionaries, dimension matching and typed metadata."""

import math
import random
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.functions import typed_metadata as M
from embedflow.operators import dimension_match as D
from embedflow.operators import digest_tree as DT
from embedflow.operators import knn, selection
from embedflow.operators.bucketed import BucketedTarget
from embedflow.operators.id_dictionary import IdDictionary
from embedflow.operators.knn_index import PivotIndex
from embedflow.operators.reconcile import reconcile
from embedflow.schema import CANONICAL
from embedflow.session import scratch_path
from tests.conftest import make_records


def statuses(df):
    return sorted(((r["id"] or ""), r["status"]) for r in df.collect())


def planted(spark, src):
    """A target with rows that are missing, extra, repeated, and changed in a bit, in metadata, or only in a zero's sign."""
    i = F.col("id")
    changed = src.withColumn("vector", F.when(i == "v0005", F.transform("vector", lambda x, k: F.when(k == 0, x + 1).otherwise(x))).otherwise(F.col("vector")))
    changed = changed.withColumn("metadata", F.when(i == "v0006", F.create_map(F.lit("n"), F.lit("other"))).otherwise(F.col("metadata")))
    kept = changed.where(i != "v0007")
    return kept.unionByName(kept.where(i == "v0008")).unionByName(kept.where(i == "v0009").withColumn("id", F.lit("extra")))


# ── J4: digest tree ──────────────────────────────────────────────────────────


def test_tree_reconcile_equals_reconcile(spark):
    src, _ = make_records(spark, 300, 8, 0)
    src = src.withColumn("id", F.when(F.col("id") != "v0100", F.col("id")))
    src = src.unionByName(src.where("id = 'v0020'"))  # repeated on both sides
    tgt = planted(spark, src)
    want = statuses(reconcile(src, tgt))
    for leaves, fanout in ((256, 4), (100, 7), (1, 2)):
        got, report = DT.tree_reconcile(src, tgt, leaves, fanout)
        assert statuses(got) == want
        assert report.differing <= 6 and (leaves == 1 or sum(report.compared) < 6 * fanout * 5 + 1)


def test_equal_tables_cost_two_aggregates(spark):
    src, _ = make_records(spark, 200, 8, 0)
    got, report = DT.tree_reconcile(src, src.repartition(7))
    assert (report.differing, report.compared) == (0, [1])
    assert statuses(got) == [(f"v{i:04d}", "match") for i in range(200)]


def test_only_rows_of_differing_leaves_are_joined(spark):
    src, _ = make_records(spark, 2000, 4, 0)
    tgt = src.where("id <> 'v0777'")
    trees = [DT.DigestTree.build(x, 512, 8) for x in (src, tgt)]
    leaves, compared = DT.differing_leaves(*trees)
    assert len(leaves) == 1 and compared == [1, 8, 8, 8]
    assert src.where(DT.leaf_of(512) == leaves[0]).count() < 20


def test_tolerance_zeros_nan_and_empty_tables(spark):
    rows = [("z", [0.0, 1.0]), ("t", [1.0, 2.0]), ("nan", [float("nan"), 1.0])]
    make = lambda rs: spark.createDataFrame([(i, v, {}, None) for i, v in rs], CANONICAL)
    other = make([("z", [-0.0, 1.0]), ("t", [1.01, 2.0]), ("nan", [float("nan"), 1.0])])
    got, _ = DT.tree_reconcile(make(rows), other, atol=0.05)
    assert statuses(got) == [("nan", "match"), ("t", "match"), ("z", "match")]
    assert dict(statuses(DT.tree_reconcile(make(rows), other)[0]))["t"] == "vector_differs"
    assert statuses(DT.tree_reconcile(make(rows), make([]))[0]) == [("nan", "missing"), ("t", "missing"), ("z", "missing")]
    assert statuses(DT.tree_reconcile(make([]), make([]))[0]) == []


# ── K1, J4, J5: bucketed target ──────────────────────────────────────────────


def bucketed(spark, df, buckets=8):
    t = BucketedTarget(spark, f"t_{uuid.uuid4().hex[:8]}", scratch_path(spark, "t-bucketed"), buckets)
    t.create(df)
    return t


def target_side(plan: str) -> str:
    """The operators between the target's scan and the join above it."""
    lines, out = plan.split("\n"), []
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    here = depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < here:
            here = depth(line)
            out.append(line)
            if "Join" in line:
                return "\n".join(out)
    raise AssertionError("no join above the scan")


def test_the_target_is_never_shuffled(spark):
    src, _ = make_records(spark, 60, 8, 0)
    t = bucketed(spark, src.where("id < 'v0040'"))
    for df in (t.merged(src), t.remaining(src), t.reconcile(src)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Bucketed: true" in plan and "Exchange" not in target_side(plan), plan
    merged = t.merged(src)._jdf.queryExecution().executedPlan().toString()
    assert merged.count("Exchange hashpartitioning(key") == 1  # the source's


def test_bucketed_upserts_resume_and_reconcile(spark):
    src, _ = make_records(spark, 40, 8, 0, namespace="new")
    src = src.withColumn("id", F.when(F.col("id") != "v0001", F.col("id")))
    old = src.where("id < 'v0020' OR id IS NULL").withColumns({"namespace": F.lit("old"), "vector": F.transform("vector", lambda x: x * 2)})
    t = bucketed(spark, old)
    assert t.remaining(src).count() == 20
    from embedflow.operators import upsert as U

    as_rows = lambda df: sorted(str((r["id"], list(r["vector"]), r["metadata"], r["namespace"])) for r in df.collect())
    cols = ["id", "vector", "metadata", "namespace"]
    for vector_only, plain in ((True, U.upsert_vector_only), (False, U.upsert_replace)):
        want = as_rows(plain(t.rows(), src.where("id > 'v0010' OR id IS NULL")).select(*cols))
        t.upsert(src.where("id > 'v0010' OR id IS NULL"), vector_only)
        assert as_rows(t.rows()) == want
    t.upsert(src)
    assert {s for _, s in statuses(t.reconcile(src))} == {"match"} and t.remaining(src).count() == 0
    tgt = planted(spark, src).dropDuplicates(["id"])
    assert statuses(bucketed(spark, tgt).reconcile(src)) == statuses(reconcile(src, tgt))
    twice = src.unionByName(src)
    assert bucketed(spark, twice).rows().count() == 40


# ── J1, M5: pruned search ────────────────────────────────────────────────────


def clustered(spark, n=1500, dim=12, centres=25, seed=3):
    rng = np.random.default_rng(seed)
    c = rng.standard_normal((centres, dim)) * 3
    x = (c[rng.integers(0, centres, n)] + 0.05 * rng.standard_normal((n, dim))).astype(np.float32)
    return spark.createDataFrame([(f"{i}", [float(v) for v in x[i]]) for i in range(n)], "id string, vector array<float>")


@pytest.mark.parametrize("metric", ["cosine", "dot", "l2"])
def test_pruned_search_equals_brute_force(spark, metric):
    data = clustered(spark)
    probes = knn.data_probes(data, 30)
    want = sorted(tuple(r) for r in knn.knn_topk(data, probes, 5, metric).select("probe_id", "rank", "id", F.round("score", 6)).collect())
    top, report = PivotIndex.build(data, metric, pivots=100, shells=2).search(probes, 5)
    assert sorted(tuple(r) for r in top.select("probe_id", "rank", "id", F.round("score", 6)).collect()) == want
    assert len(want) == 250 and report.pairs_scored < report.pairs
    if metric != "dot":
        assert report.pairs_skipped_share > 0.7


def test_pruned_search_of_odd_vectors(spark):
    rng = np.random.default_rng(0)
    rows = [(f"{i}", [float(v) for v in rng.standard_normal(4)]) for i in range(60)]
    rows += [("z1", [0.0] * 4), ("z2", [0.0] * 4), ("nan", [float("nan")] * 4), ("inf", [float("inf"), 0.0, 0.0, 0.0]), ("tiny", [1e-12, -1e-12, 0.0, 0.0]), ("other", [1.0, 2.0]), ("empty", []), ("none", None)]
    rows += [("copy", rows[0][1])] * 9
    data = spark.createDataFrame(rows, "id string, vector array<float>")
    probes = knn.data_probes(data, 20).unionByName(spark.createDataFrame([(1000, [0.0] * 4), (1001, [-1.0, 0.5, 0.0, 2.0])], "probe_id bigint, probe array<double>"))
    for metric in ("cosine", "dot", "l2"):
        out = lambda t: sorted((r["probe_id"], r["rank"], r["id"]) for r in t.collect())
        assert out(PivotIndex.build(data, metric, pivots=6, shells=3).search(probes, 12)[0]) == out(knn.knn_topk(data, probes, 12, metric)), metric
    top, report = PivotIndex.build(data.limit(0)).search(probes, 3)
    assert top.count() == 0 and report.blocks == 0


def test_data_probes(spark):
    df = spark.createDataFrame([("0", [1.0]), ("100", [2.0]), ("100", [1.0]), ("7", [1.0]), ("x", [1.0]), (None, [1.0]), ("200", None), ("300", [])], "id string, vector array<float>")
    assert sorted((r["probe_id"], r["probe"]) for r in knn.data_probes(df, 100).collect()) == [(0, [1.0]), (100, [1.0])]


# ── A6: selection ────────────────────────────────────────────────────────────


def nearest(values, p):
    order = sorted(values, key=lambda v: (v is not None, math.inf if v is not None and v != v else v or 0, v is not None and v != v))
    return order[min(int(len(order) * p / 100), len(order) - 1)]


@pytest.mark.parametrize("kind", ["double", "float", "bigint", "int", "timestamp"])
def test_selected_ranks_equal_sorted_ones(spark, kind):
    rng = random.Random(kind)
    pick = {
        "double": lambda: rng.choice([None, 0.0, -0.0, 1e-310, -1e300, float("inf"), float("-inf"), rng.gauss(0, 1), rng.gauss(0, 1e9)]),
        "float": lambda: rng.choice([None, 0.5, -2.0, float("nan"), np.float32(rng.gauss(0, 1)).item()]),
        "bigint": lambda: rng.choice([None, 0, -1, 2**63 - 1, -(2**63), rng.randrange(-(10**12), 10**12)]),
        "int": lambda: rng.randrange(-3, 4),
        "timestamp": lambda: rng.choice([None, __import__("datetime").datetime(1960 + rng.randrange(90), 1, 1, 3, 4, 5, 678)]),
    }[kind]
    rows = [(rng.choice(["a", "b", None]), pick()) for _ in range(400)] + [("one", pick()), ("gone", None)]
    df = spark.createDataFrame(rows, f"g string, v {kind}")
    percents = [0, 1, 50, 95, 99, 100]
    got = selection.select_ranks(df, "g", "v", percents)
    for r in got.collect():
        values = [v for g, v in rows if g == r["g"]]
        assert r["n"] == len(values)
        for p in percents:
            want, have = nearest([v.timestamp() if kind == "timestamp" and v else v for v in values], p), r[f"p{p}"]
            have = have.timestamp() if kind == "timestamp" and have else have
            assert have == want or (have != have and want != want), (r["g"], p)
    assert got.count() == 5
    assert selection.select_ranks(df.limit(0), "g", "v", [50]).count() == 0


def test_selection_sorts_nothing(spark, monkeypatch):
    plans = []
    real = selection._kept
    monkeypatch.setattr(selection, "_kept", lambda s, df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(s, df))[1])
    df = spark.range(1000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").cast("double").alias("v"))
    out = selection.select_ranks(df, "g", "v", [50])
    assert sorted(r["p50"] for r in out.collect()) == [499.0, 500.0, 501.0]
    for plan in [*plans, out._jdf.queryExecution().executedPlan().toString()]:
        scans = plan[plan.index("Range") :] if "Range" in plan else plan
        assert "rangepartitioning" not in plan and "Window" not in plan and "Sort " not in scans


# ── K5, J7: id dictionary ────────────────────────────────────────────────────


def crowded(id_col, attempt):
    """Thirteen numbers for a turn: collisions are certain."""
    return F.when(id_col.rlike("^[0-9]+$") & F.lit(attempt == 0), id_col.cast("bigint")).otherwise(F.pmod(F.xxhash64(id_col, F.lit(attempt)), F.lit(13)) + F.lit(13 * attempt))


def brute_dictionary(spark, known, ids):
    """The same turns with plain dictionaries."""
    numbers = {}
    for attempt in range(40):
        for r in spark.createDataFrame([(i,) for i in ids], "id string").select("id", crowded(F.col("id"), attempt).alias("n")).collect():
            numbers[r["id"], attempt] = r["n"]
    out, taken, left, attempt = {}, set(known.values()), sorted(set(ids) - set(known)), 0
    while left:
        proposals = {}
        for i in left:
            n = numbers[i, attempt]
            if n not in taken:
                proposals.setdefault(n, []).append(i)
        for n, who in proposals.items():
            out[min(who, key=lambda i: (not i.isdigit(), i))] = n
            taken.add(n)
        left, attempt = [i for i in left if i not in out], attempt + 1
    return out


def test_dictionary_keeps_and_adds_without_collisions(spark):
    d = IdDictionary(spark, scratch_path(spark, "t-dict"), propose=crowded)
    first = [f"id{k}" for k in range(40)] + ["5", "7", "id3"]
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    assert d.extend(frame([*first, None])) == 42
    one = {r["id"]: r["point_id"] for r in d.entries().collect()}
    assert one == brute_dictionary(spark, {}, first) and len(set(one.values())) == 42 and one["5"] == 5
    second = [*first, *(f"new{k}" for k in range(30)), "9", "11"]
    assert d.extend(frame(second).repartition(5)) == 32 and d.extend(frame(second)) == 0
    two = {r["id"]: (r["point_id"], r["run"]) for r in d.entries().collect()}
    assert {i: n for i, (n, run) in two.items() if run == 0} == one
    assert {i: n for i, (n, run) in two.items() if run == 1} == brute_dictionary(spark, one, second)
    assert len({n for n, _ in two.values()}) == len(two) == 74
    seen = {r["id"]: r["point_id"] for r in d.lookup(frame(["id3", "nobody", None])).collect()}
    assert seen == {"id3": one["id3"], "nobody": None, None: None}


def test_a_writer_that_comes_second_starts_over(spark, monkeypatch):
    path = scratch_path(spark, "t-dict2")
    a, b = (IdDictionary(spark, path, propose=crowded) for _ in range(2))
    frame = lambda ids: spark.createDataFrame([(i,) for i in ids], "id string")
    from embedflow import storage

    real, done = storage.publish, []

    def slow(s, p, text):
        if not done:
            done.append(1)
            assert b.extend(frame([f"x{k}" for k in range(10)])) == 10
        return real(s, p, text)

    monkeypatch.setattr(storage, "publish", slow)
    assert a.extend(frame([f"x{k}" for k in range(5, 20)])) == 10
    rows = a.entries().collect()
    assert len({r["id"] for r in rows}) == len({r["point_id"] for r in rows}) == len(rows) == 20


# ── G6: dimension order ──────────────────────────────────────────────────────


def order(df):
    return sorted((r["source_dim"], r["target_dim"], r["verdict"]) for r in df.collect())


def test_a_shuffled_dimension_order_is_recovered(spark):
    src, _ = make_records(spark, 50, 10, 0)
    src = src.withColumn("vector", F.transform("vector", lambda x, i: F.when((i == 3) | (i == 6), F.lit(0.0).cast("float")).otherwise(x)))  # equal dimensions
    perm = [4, 0, 9, 2, 7, 1, 8, 5, 3, 6]
    at = F.array(*[F.lit(p + 1) for p in perm])
    tgt = src.withColumn("vector", F.transform(at, lambda k: F.element_at("vector", k))).where("id <> 'v0004'").repartition(5)
    found = D.recover_dimension_order(src, tgt)
    got = order(found)
    assert {v for _, _, v in got} == {"permuted"} and sorted(t for _, t, _ in got) == list(range(10))
    exact = {p: j for j, p in enumerate(perm)}
    assert all(exact[s] == t for s, t, _ in got if s not in (3, 6))
    back = {r["id"]: list(r["vector"]) for r in D.reorder(tgt, found).collect()}
    assert back == {r["id"]: list(r["vector"]) for r in src.collect() if r["id"] != "v0004"}


def test_no_order_where_there_is_none(spark):
    src, _ = make_records(spark, 30, 6, 0)
    other, _ = make_records(spark, 30, 6, 9)
    none = [(None, None, "none")]
    assert order(D.recover_dimension_order(src, other)) == none
    assert order(D.recover_dimension_order(src, src.withColumn("vector", F.slice("vector", 1, 5)))) == none
    assert order(D.recover_dimension_order(src.limit(0), src.limit(0))) == none
    assert order(D.recover_dimension_order(src, src)) == [(i, i, "same") for i in range(6)]
    with pytest.raises(ValueError):
        D.reorder(src, D.recover_dimension_order(src, other))


# ── S1, K6: typed metadata ───────────────────────────────────────────────────


def test_metadata_keeps_its_types(spark):
    texts = ['{"k": 9, "b": true, "s": "x", "n": {"a": [1, 2.5]}, "z": null}', None, "bad {", '{"k": "9"}', '{"k": 9.5}', "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("metadata", M.parse_metadata("t"))
    path = scratch_path(spark, "t-variant")
    df.select("i", "metadata").write.parquet(path)
    back = spark.read.parquet(path)
    fields = {"k": ("$.k", "double"), "b": ("$.b", "boolean"), "a1": ("$.n.a[1]", "double"), "none": ("$.q", "string")}
    rows = {r["i"]: r for r in M.project_fields(back, fields).collect()}
    assert (rows[0]["k"], rows[0]["b"], rows[0]["a1"], rows[0]["none"]) == (9.0, True, 2.5, None)
    assert rows[1]["k"] is rows[2]["k"] is rows[5]["k"] is None and rows[4]["k"] == 9.5
    text = {r["i"]: r["t"] for r in back.select("i", M.metadata_text("metadata").alias("t")).collect()}
    assert text[0] == '{"b":true,"k":9,"n":{"a":[1,2.5]},"s":"x","z":null}' and text[2] is None
    assert [r["i"] for r in M.where_field(back, "$.k", "double", lambda k: k > 9).collect()] == [4]
    assert M.metadata_schema(back.where("i = 0")).first()["schema"].startswith("OBJECT<b: BOOLEAN, k: BIGINT")


def test_maps_of_strings_and_back(spark):
    df = spark.createDataFrame([({"a": "1", "b": "x y", "c": "true", "q": '"'},), ({},), (None,)], "m map<string,string>")
    typed = df.select("m", M.from_strings("m").alias("v"))
    rows = typed.select("m", F.schema_of_variant("v").alias("s"), M.to_strings("v").alias("back")).collect()
    assert rows[0]["s"] == "OBJECT<a: BIGINT, b: STRING, c: BOOLEAN, q: STRING>"
    assert [r["back"] for r in rows] == [r["m"] for r in rows]
