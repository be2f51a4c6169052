"""Exact top-k neighbours of a bounded probe set, and the checks built on them.

Plan shape (block form, the default):

    scan(data) ─ mapInArrow[X @ Qᵀ, per-batch top-k] ─ shuffle(probe_id)
               ─ WindowGroupLimit/Window[row_number ≤ k]

* The probe matrix Q (n_probes × dim) is broadcast in blocks of at most
  ``MAX_PROBE_CELLS`` values, and a task scores in tiles of at most
  ``MAX_SCORE_CELLS``.
* Data vectors never shuffle: each task scores its own rows with BLAS
  calls and emits exactly k candidates per probe and batch, so the shuffle
  carries O(n_probes · k · batches) rows no matter how large the table is
  or how many rows tie, and a hot namespace or duplicated id cannot grow a
  group.
* The final order is the one the tasks use, ``round(score, 9) DESC, id
  ASC`` with NaN last, which makes results independent of partitioning.

``method="expr"`` is the definition: the same scores with JVM-side
higher-order functions (no Python), used to test the block form.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..functions.hashing import PROBE_SEED, hash_unit_vector

# Cells (probes * dim doubles) of a probe matrix that is broadcast at once: 128 MiB.  More probes go in blocks.
MAX_PROBE_CELLS = 16 * 1024 * 1024
# Scores (rows * probes) that a task holds at once.
MAX_SCORE_CELLS = 4 * 1024 * 1024
# Rows of a top-k result that are broadcast to fetch vectors by id.
MAX_FETCH_ROWS = 100_000
ORDER_DIGITS = 9


def detect_dim(data: DataFrame, vector_col: str = "vector") -> int | None:
    """The most frequent vector length (ties: the smaller; empty vectors ignored); None if there is none.

    Rows of any other length are not scored; ``operators.guards.dimension_check`` reports them.
    """
    profile = data.where(F.size(vector_col) > 0).groupBy(F.size(vector_col).alias("dim")).count()
    row = profile.orderBy(F.col("count").desc(), "dim").first()
    return None if row is None else int(row["dim"])


def first_dim(data: DataFrame, vector_col: str = "vector") -> int | None:
    """Length of the first non-empty vector found, which reads one split; None if there is none."""
    row = data.where(F.size(vector_col) > 0).select(F.size(vector_col).alias("dim")).first()
    return None if row is None else int(row["dim"])


def make_probes(spark: SparkSession, n_probes: int, dim: int, seed: str = PROBE_SEED) -> DataFrame:
    """probe_id BIGINT, probe ARRAY<DOUBLE>: seeded unit vectors, same in SQL."""
    return spark.range(n_probes).select(
        F.col("id").alias("probe_id"), hash_unit_vector(seed, F.col("id"), dim).alias("probe")
    )


def data_probes(data: DataFrame, every: int, id_col: str = "id") -> DataFrame:
    """probe_id BIGINT, probe ARRAY<DOUBLE>: the vectors whose whole-number id divides by ``every``.

    Ids that are no number, null and empty vectors make no probe; of an id that stands several times, the
    smallest vector does.
    """
    number = F.col(id_col).cast("string").try_cast("bigint")
    picked = data.select(number.alias("probe_id"), F.col("vector").cast("array<double>").alias("probe"))
    picked = picked.where((F.col("probe_id") % every == 0) & (F.size("probe") > 0))
    return picked.groupBy("probe_id").agg(F.min("probe").alias("probe"))


def _probe_blocks(probes: DataFrame):
    """(ids, matrix) of the probes, in blocks of at most MAX_PROBE_CELLS values.

    Probes are a stated query set; each block is one pass over the data.
    """
    ids, rows = [], []

    def block():
        order = np.argsort(np.array(ids, dtype=np.int64))
        return np.array(ids, dtype=np.int64)[order], np.array(rows, dtype=np.float64).reshape(len(rows), len(rows[0]) if rows else 0)[order]

    for r in probes.select("probe_id", "probe").toLocalIterator():
        if rows and (len(r["probe"]) != len(rows[0]) or (len(rows) + 1) * max(1, len(rows[0])) > MAX_PROBE_CELLS):
            yield block()
            ids, rows = [], []
        ids.append(r["probe_id"])
        rows.append(r["probe"])
    yield block()


CANDIDATES = T.StructType(
    [
        T.StructField("probe_id", T.LongType()),
        T.StructField("id", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("key", T.DoubleType()),
    ]
)


def _order_key(score):
    """What results are ordered by, descending: the rounded score; NaN ranks below everything."""
    return F.round(F.nanvl(score, F.lit(float("-inf"))), ORDER_DIGITS)


def _batch_candidates(keys: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, probe) pairs of the k best rows of every probe column, by (key descending, id).

    The final order is the same, so k rows a batch are enough however many rows tie.
    """
    n = keys.shape[0]
    if n <= k:
        return np.nonzero(np.ones_like(keys, dtype=bool))
    kth = np.partition(keys, n - k, axis=0)[n - k]
    keep_r, keep_p = [], []
    for p in range(keys.shape[1]):
        better = np.nonzero(keys[:, p] > kth[p])[0]
        tied = np.nonzero(keys[:, p] == kth[p])[0]
        if len(better) + len(tied) > k:
            tied = tied[np.argsort(ids[tied], kind="stable")[: k - len(better)]]
        keep_r += [better, tied]
        keep_p.append(np.full(len(better) + len(tied), p))
    return np.concatenate(keep_r), np.concatenate(keep_p)


def _block_scorer(probe_ids: np.ndarray, Q: np.ndarray, k: int, metric: str):
    """mapInArrow function: tiles of each Arrow batch and of the probes are multiplied as matrices.

    The list column is read as a flat float32 buffer (zero copy when every
    row has the probe dimension); rows of another length are skipped.
    """
    import pyarrow as pa

    from ..functions.arrowvec import as_matrix, list_lengths

    d = Q.shape[1]
    q_norm = np.linalg.norm(Q, axis=1)
    names = CANDIDATES.fieldNames()

    def scores(X, probes):
        dots = X @ Q[probes].T
        if metric == "cosine":
            return dots / (np.linalg.norm(X, axis=1)[:, None] * q_norm[None, probes] + V.EPS)
        if metric == "dot":
            return dots
        x_sq = np.einsum("ij,ij->i", X, X)  # l2: larger score = nearer
        return -np.sqrt(np.maximum(x_sq[:, None] + q_norm[None, probes] ** 2 - 2.0 * dots, 0.0))

    def score_batches(batches):
        for b in batches:
            if b.num_rows == 0 or not len(probe_ids):
                continue
            varr = b.column("vector")
            ok = np.nonzero(list_lengths(varr) == d)[0]
            if len(ok) == 0:
                continue
            X = as_matrix(varr, ok, d, np.float32).astype(np.float64)
            ids = np.asarray(b.column("id").to_pylist(), dtype=object)[ok]
            order_ids = np.asarray([i or "" for i in ids], dtype=object)
            tile = max(1, MAX_SCORE_CELLS // len(ok))
            for at in range(0, len(probe_ids), tile):
                with np.errstate(invalid="ignore", over="ignore"):
                    S = scores(X, slice(at, at + tile))
                    keys = np.round(np.where(np.isnan(S), -np.inf, S), ORDER_DIGITS)
                rows, cols = _batch_candidates(keys, order_ids, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(probe_ids[at + cols], pa.int64()),
                        pa.array(ids[rows].tolist(), pa.string()),
                        pa.array(S[rows, cols], pa.float64()),
                        pa.array(keys[rows, cols], pa.float64()),
                    ],
                    names=names,
                )

    return score_batches


def _expr_candidates(data: DataFrame, probe_ids: np.ndarray, Q: np.ndarray, metric: str) -> DataFrame:
    qs = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in Q])
    pid = F.array(*[F.lit(int(p)) for p in probe_ids])
    scored = data.where(F.size("vector") == Q.shape[1]).select(
        "id", F.posexplode(F.transform(qs, lambda q: V.score(metric, q, F.col("vector")))).alias("pos", "score")
    )
    return scored.select(F.element_at(pid, F.col("pos") + 1).alias("probe_id"), "id", "score", _order_key(F.col("score")).alias("key"))


def knn_topk(
    data: DataFrame,
    probes: DataFrame,
    k: int = 5,
    metric: str = "cosine",
    method: str = "block",
    keep_vectors: bool = False,
) -> DataFrame:
    """probe_id, rank, id, score (+ vector): exact top-k per probe over ``data(id, vector)``.

    NaN scores rank last; ties go by id.  With ``keep_vectors`` the vectors of the at most k * probes rows
    found are fetched by id afterwards, so no vector of a mere candidate is shuffled; an id that ``data``
    holds several times takes its smallest vector.
    """
    metric = V.normalise_metric_name(metric)
    if metric not in ("cosine", "dot", "l2"):
        raise ValueError(f"unsupported metric {metric!r}")
    if method not in ("block", "expr"):
        raise ValueError(f"unknown method {method!r}")
    base = data.select(F.col("id").cast("string").alias("id"), F.col("vector"))
    cands, n_probes = None, 0
    for probe_ids, Q in _probe_blocks(probes):
        n_probes += len(probe_ids)
        if method == "block":
            part = base.mapInArrow(_block_scorer(probe_ids, Q, k, metric), CANDIDATES)
        else:
            part = _expr_candidates(base, probe_ids, Q, metric)
        cands = part if cands is None else cands.unionByName(part)
    w = Window.partitionBy("probe_id").orderBy(F.col("key").desc(), F.col("id").asc())
    top = cands.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("key")
    if not keep_vectors:
        return top
    small = F.broadcast(top) if n_probes * k <= MAX_FETCH_ROWS else top  # at most k rows a probe
    vectors = base.select("id", F.col("vector").cast("array<float>").alias("vector"))
    return vectors.join(small, "id").groupBy("probe_id", "id", "score", "rank").agg(F.min("vector").alias("vector"))


def neighbour_overlap(probes: DataFrame, src_top: DataFrame, tgt_top: DataFrame) -> DataFrame:
    """probe_id, n_source, n_common, overlap = |S ∩ T| / max(|S|, 1) (order-insensitive)."""
    s = src_top.select("probe_id", "id").distinct()
    t = tgt_top.select("probe_id", "id").distinct().withColumn("_hit", F.lit(1))
    per_probe = (
        s.join(t, ["probe_id", "id"], "left")
        .groupBy("probe_id")
        .agg(F.count("id").alias("n_source"), F.count("_hit").alias("n_common"))
    )
    return (
        probes.select("probe_id")
        .join(per_probe, "probe_id", "left")
        .select(
            "probe_id",
            F.coalesce("n_source", F.lit(0)).alias("n_source"),
            F.coalesce("n_common", F.lit(0)).alias("n_common"),
        )
        .withColumn("overlap", F.col("n_common") / F.greatest(F.col("n_source"), F.lit(1)))
    )


def positional_cosine(src_top: DataFrame, tgt_top: DataFrame) -> DataFrame:
    """probe_id, cosine: mean cosine of the i-th source hit against the i-th target hit."""
    s = src_top.select("probe_id", "rank", F.col("vector").alias("sv"))
    t = tgt_top.select("probe_id", "rank", F.col("vector").alias("tv"))
    return (
        s.join(t, ["probe_id", "rank"])
        .groupBy("probe_id")
        .agg(F.avg(V.cosine("sv", "tv")).alias("cosine"))
    )


def probe_scores(probes: DataFrame, src_top: DataFrame, tgt_top: DataFrame) -> DataFrame:
    """probe_id, n_common, overlap, cosine (NULL when either side found nothing).

    One shuffle: both top-k sets are unioned and grouped by probe (at most
    2k rows per group); overlap and positional cosine are array functions
    over the group, so each side is scanned and scored once.
    """
    hit = lambda df, side: df.select("probe_id", F.lit(side).alias("side"), "rank", "id", "vector")
    g = (
        hit(src_top, 0)
        .unionByName(hit(tgt_top, 1))
        .groupBy("probe_id")
        .agg(F.array_sort(F.collect_list(F.struct("side", "rank", "id", "vector"))).alias("hits"))
    )
    s = F.filter("hits", lambda h: h["side"] == 0)
    t = F.filter("hits", lambda h: h["side"] == 1)
    s_ids = F.array_distinct(F.transform(s, lambda h: h["id"]))
    t_ids = F.array_distinct(F.transform(t, lambda h: h["id"]))
    pairs = F.filter(
        F.zip_with(s, t, lambda a, b: F.when(a.isNotNull() & b.isNotNull(), V.cosine(a["vector"], b["vector"]))),
        lambda c: c.isNotNull(),
    )
    per_probe = g.select(
        "probe_id",
        F.size(s_ids).alias("n_source"),
        F.size(F.array_intersect(s_ids, t_ids)).alias("n_common"),
        F.when(F.size(pairs) > 0, F.aggregate(pairs, F.lit(0.0), lambda acc, c: acc + c) / F.size(pairs)).alias("cosine"),
    )
    return (
        probes.select("probe_id")
        .join(per_probe, "probe_id", "left")
        .select(
            "probe_id",
            F.coalesce("n_common", F.lit(0)).cast("bigint").alias("n_common"),
            (F.coalesce("n_common", F.lit(0)) / F.greatest(F.coalesce("n_source", F.lit(0)), F.lit(1))).alias("overlap"),
            "cosine",
        )
    )


def semantic_summary(scores: DataFrame, top_k: int, threshold: float = 0.95) -> DataFrame:
    """One row: n_probes, top_k, avg_overlap_pct, avg_cosine_sim, passed (empty → 0 / false)."""
    avg_ov = F.coalesce(F.avg("overlap"), F.lit(0.0))
    return scores.agg(
        F.count("*").alias("n_probes"),
        F.lit(top_k).alias("top_k"),
        F.round(avg_ov * 100, 4).alias("avg_overlap_pct"),
        F.round(F.coalesce(F.avg("cosine"), F.lit(0.0)), 6).alias("avg_cosine_sim"),
        (avg_ov >= F.lit(threshold)).alias("passed"),
    )


def running_overlap(scores: DataFrame, every: int = 25, job: str = "job") -> DataFrame:
    """probe_id, n, running_avg_overlap emitted at every ``every``-th probe (in probe order).

    Uses the chunked prefix sum of operators.progress, so even a very large
    probe set is not funnelled through one task.
    """
    from .progress import running_sum

    base = scores.select(F.lit(job).alias("_job"), "probe_id", F.col("overlap"), F.lit(1).cast("bigint").alias("one"))
    run = running_sum(base, "_job", "probe_id", ["overlap", "one"])
    return run.where(F.col("cum_one") % every == 0).select(
        "probe_id", F.col("cum_one").alias("n"), (F.col("cum_overlap") / F.col("cum_one")).alias("running_avg_overlap")
    )


def semantic_validate(
    source: DataFrame,
    target: DataFrame,
    n_probes: int = 100,
    top_k: int = 5,
    metric: str = "cosine",
    seed: str = PROBE_SEED,
    method: str = "block",
    knn_fn=None,
):
    """Probe both sides with the same probes; return (probe_scores, summary).

    ``knn_fn(data, probes, k, metric)`` may replace the exact search (e.g. a
    store's own index); it must return probe_id, rank, id, score, vector.
    """
    spark = source.sparkSession
    dim = detect_dim(source)
    if dim is None:
        empty = spark.createDataFrame([], "probe_id bigint, overlap double, cosine double")
        return empty, semantic_summary(empty, top_k)
    probes = make_probes(spark, n_probes, dim, seed)
    search = knn_fn or (lambda d, p, k, m: knn_topk(d, p, k, m, method, keep_vectors=True))
    s = search(source, probes, top_k, metric)
    t = search(target, probes, top_k, metric)
    scores = probe_scores(probes, s, t)
    return scores, semantic_summary(scores, top_k)
