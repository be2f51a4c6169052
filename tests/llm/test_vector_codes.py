import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.llm import queries, tables, vector_codes


def brute(rows, parts=8, entries=16, rounds=6):
    """The contract by plain loops over (id, vector, label); returns ({id: (code, error)}, {label: error}, sha256)."""
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    ints = {i: [math.floor(4096 * float(np.float32(x))) for x in v] for i, v, _ in kept}
    cut = lambda i, p: tuple(ints[i][p * width : (p + 1) * width])
    ids = sorted(ints)
    books = [[cut(i, p) for i in ids[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for i in ids:
                groups.setdefault(nearest(cut(i, p), books[p])[1], []).append(cut(i, p))
            for k, members in groups.items():
                books[p][k] = tuple(sum(c) // len(members) for c in zip(*members))
    out, labels = {}, {}
    for i, _, lab in kept:
        found = [nearest(cut(i, p), books[p]) for p in range(parts)]
        out[i] = ("".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found))
        labels[lab] = labels.get(lab, 0) + out[i][1]
    text = ",".join(str(c) for b in books for e in b for c in e)
    return out, labels, hashlib.sha256(text.encode()).hexdigest()


def check(spark, rows, tmp_path, big=False):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.QUERIES["op12_vector_codes"](spark, str(tmp_path)).collect()
    codes, labels, sha = brute(rows)
    by_id = {i: lab for i, _, lab in rows}
    clipped = lambda e: e if e < 2**63 else None
    assert {r.vec_id: (r.code, r.error) for r in got} == {i: (c, clipped(e)) for i, (c, e) in codes.items()}
    assert len(got) == len(codes) and {r.codebooks_sha256 for r in got} == {sha}
    if not big:
        assert all(r.label_error == labels[by_id[r.vec_id]] for r in got)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(2)
    rows = [(i * 7 % 401, [rng.choice([0.0, -0.0, 0.25, 1 / 3, -1e-6]) if rng.random() < 0.3 else rng.gauss(0, 1) for _ in range(16)], rng.choice([None, 1, 2, 2])) for i in range(401)]
    rows += [(1000, None, 1), (1001, [None] + [0.0] * 15, 1), (1002, [float("nan")] * 16, 2), (1003, [float("-inf")] + [0.0] * 15, None)]
    check(spark, rows, tmp_path)


def test_ties_and_copies(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [float(rng.randrange(-1, 2)) for _ in range(8)], i % 3) for i in range(120)]
    check(spark, rows, tmp_path)


def test_huge_components(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [rng.choice([1e30, -3e38, 7.0, 1e6, 0.1]) for _ in range(8)], 0) for i in range(60)]
    check(spark, rows, tmp_path, big=True)


@pytest.mark.parametrize("degree", [2, 4, 7])
def test_gnat_equals_all_distances(degree):
    rng = np.random.default_rng(degree)
    for spread, n in [(3, 40), (1000, 200), (2**27, 64), (1, 9), (5, 1)]:
        entries = rng.integers(-spread, spread + 1, (n, 5))
        queries_ = np.concatenate([rng.integers(-spread, spread + 1, (300, 5)), entries])
        d = ((queries_[:, None] - entries[None]) ** 2).sum(axis=2)
        best, least, computed = vector_codes.Gnat(entries, degree).nearest(queries_)
        assert (best == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all()
        assert computed <= d.size
    clusters = rng.integers(-10**6, 10**6, (8, 5))
    entries = (clusters[:, None] + rng.integers(-50, 50, (8, 25, 5))).reshape(-1, 5)
    _, _, computed = vector_codes.Gnat(entries, 8).nearest(entries)
    assert computed < 0.5 * len(entries) ** 2  # subtrees are dropped


def test_odd_tables(spark):
    rows = [(1, [1.0] * 10, 5, "x"), (1, [1.0] * 10, 5, "x"), (None, [2.0] * 10, None, "x"), (2, [], 5, "x"), (3, [1.0, 2.0], 6, "x"), (4, None, 6, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, code string").withColumns({c: F.lit(1) for c in ("id", "v", "size", "error", "n")})
    codes, books = vector_codes.compress(df, parts=4)
    got = sorted((tuple(r) for r in codes.collect()), key=str)
    assert [len(b) for b in books.books] == [3] * 4 and books.books[0][0] == (4096,) * 3
    assert got == sorted([(1, 5, "00000000", 0, 0)] * 2 + [(None, None, "02020202", 0, 0), (2, 5, None, None, 0), (3, 6, None, None, None)], key=str)
    for empty in (df.limit(0), df.where("vec_id = 4"), df.where("vec_id = 2")):
        codes, books = vector_codes.compress(empty)
        assert all(r.code is None for r in codes.collect()) and books.books == [[]] * 8


def test_totals_of_many_keys(spark):
    """Hot keys by broadcast and the others by a shuffle give what one join gives; null keys and lone rows stay."""
    rows = spark.range(6000).select(F.expr("if(id % 3 = 0, null, if(id % 3 = 1, 0, id))").alias("k"), "id")
    totals = rows.groupBy("k").agg(F.count("*").alias("n"), F.sum("id").alias("s")).where("k is null or k <> 5")
    got = [{tuple(r) for r in tables.join_totals(rows, totals, ["k"], "n", small=small).select("k", "id", "n", "s").collect()} for small in (0, 10**6)]
    assert got[0] == got[1] and len(got[0]) == 6000 and (5, 5, None, None) in got[0]
    assert (None, 3, 2000, sum(range(0, 6000, 3))) in got[0]
