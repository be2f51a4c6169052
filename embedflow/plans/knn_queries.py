"""Semantic validation queries: k-NN, overlap, positional cosine, summary."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import knn
from . import sqlkit as S
from .common import N_PROBES, TOP_K, rounded_copy, source
from .registry import query


def _probes(spark, src):
    return knn.make_probes(spark, N_PROBES, knn.detect_dim(src))


def _both_sides(spark, sf_dir, k=TOP_K, metric="cosine"):
    src = source(spark, sf_dir)
    tgt = rounded_copy(src)
    probes = _probes(spark, src)
    s = knn.knn_topk(src, probes, k, metric, keep_vectors=True)
    t = knn.knn_topk(tgt, probes, k, metric, keep_vectors=True)
    return probes, s, t


_BOTH = f"WITH {S.SRC}, {S.TGT_ROUNDED}, {S.DIMS}, {S.hash_unit_probes(N_PROBES)}, " + (
    f"{S.topk('s_top', 'src', TOP_K)}, {S.topk('t_top', 'tgt', TOP_K)}"
)
_OVERLAP_CTE = (
    "ov AS (SELECT s.probe_id, count(*) AS n_source, count(t.id) AS n_common FROM s_top s "
    "LEFT JOIN t_top t ON s.probe_id = t.probe_id AND s.id = t.id GROUP BY s.probe_id), "
    f"pc AS (SELECT s.probe_id, avg({S.cos('s.vector', 't.vector')}) AS cosine FROM s_top s "
    "JOIN t_top t ON s.probe_id = t.probe_id AND s.rank = t.rank GROUP BY s.probe_id), "
    "scores AS (SELECT p.probe_id, coalesce(ov.n_common, 0) AS n_common, "
    "coalesce(ov.n_common, 0) / greatest(coalesce(ov.n_source, 0), 1) AS overlap, pc.cosine "
    "FROM probes p LEFT JOIN ov ON p.probe_id = ov.probe_id LEFT JOIN pc ON p.probe_id = pc.probe_id)"
)


@query(
    "knn_bruteforce",
    f"WITH {S.SRC}, {S.DIMS}, {S.hash_unit_probes(N_PROBES)}, {S.topk('s_top', 'src', TOP_K)} "
    "SELECT probe_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM s_top",
)
def knn_bruteforce(spark, sf_dir):
    src = source(spark, sf_dir)
    top = knn.knn_topk(src, _probes(spark, src), TOP_K)
    return top.select("probe_id", "rank", "id", F.round("score", 6).alias("score"))


@query(
    "neighbour_overlap",
    f"{_BOTH}, {_OVERLAP_CTE} SELECT probe_id, CAST(n_common AS BIGINT) AS n_common, "
    "round(overlap, 6) AS overlap, round(cosine, 6) AS cosine FROM scores",
)
def neighbour_overlap(spark, sf_dir):
    probes, s, t = _both_sides(spark, sf_dir)
    sc = knn.probe_scores(probes, s, t)
    return sc.select("probe_id", "n_common", F.round("overlap", 6).alias("overlap"), F.round("cosine", 6).alias("cosine"))


@query(
    "positional_cosine",
    f"{_BOTH}, {_OVERLAP_CTE} SELECT probe_id, round(cosine, 6) AS cosine FROM pc",
)
def positional_cosine(spark, sf_dir):
    _, s, t = _both_sides(spark, sf_dir)
    return knn.positional_cosine(s, t).select("probe_id", F.round("cosine", 6).alias("cosine"))


@query(
    "semantic_summary",
    f"{_BOTH}, {_OVERLAP_CTE} SELECT count(*) AS n_probes, {TOP_K} AS top_k, "
    "round(coalesce(avg(overlap), 0) * 100, 4) AS avg_overlap_pct, "
    "round(coalesce(avg(cosine), 0), 6) AS avg_cosine_sim, coalesce(avg(overlap), 0) >= 0.95 AS passed FROM scores",
)
def semantic_summary(spark, sf_dir):
    probes, s, t = _both_sides(spark, sf_dir)
    return knn.semantic_summary(knn.probe_scores(probes, s, t), TOP_K)


@query(
    "probe_running_overlap",
    f"{_BOTH}, {_OVERLAP_CTE} SELECT probe_id, n, round(r, 6) AS running_avg_overlap FROM ("
    "SELECT probe_id, row_number() OVER (ORDER BY probe_id) AS n, "
    "avg(overlap) OVER (ORDER BY probe_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r FROM scores) "
    "WHERE n % 25 = 0",
)
def probe_running_overlap(spark, sf_dir):
    probes, s, t = _both_sides(spark, sf_dir)
    run = knn.running_overlap(knn.probe_scores(probes, s, t), every=25)
    return run.select("probe_id", F.col("n").cast("bigint").alias("n"), F.round("running_avg_overlap", 6).alias("running_avg_overlap"))


@query(
    "topk_per_probe",
    f"WITH {S.SRC}, {S.TGT_ROUNDED}, {S.DIMS}, {S.hash_unit_probes(N_PROBES)}, {S.topk('t_top', 'tgt', 10)} "
    "SELECT probe_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM t_top",
)
def topk_per_probe(spark, sf_dir):
    src = source(spark, sf_dir)
    top = knn.knn_topk(rounded_copy(src), _probes(spark, src), 10)
    return top.select("probe_id", "rank", "id", F.round("score", 6).alias("score"))


@query(
    "id_set_intersect",
    f"{_BOTH} SELECT probe_id, id FROM s_top INTERSECT SELECT probe_id, id FROM t_top",
)
def id_set_intersect(spark, sf_dir):
    _, s, t = _both_sides(spark, sf_dir)
    return s.select("probe_id", "id").intersect(t.select("probe_id", "id"))


@query(
    "knn_by_metric",
    f"WITH {S.SRC}, {S.DIMS}, {S.hash_unit_probes(N_PROBES)}, "
    f"{S.topk('d_top', 'src', TOP_K, 'dot')}, {S.topk('l_top', 'src', TOP_K, 'l2')} "
    "SELECT 'dot' AS metric, probe_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) AS score FROM d_top "
    "UNION ALL SELECT 'l2', probe_id, CAST(rank AS INTEGER), id, round(score, 6) FROM l_top",
)
def knn_by_metric(spark, sf_dir):
    src = source(spark, sf_dir)
    probes = _probes(spark, src)
    out = None
    for metric in ("dot", "l2"):
        top = knn.knn_topk(src, probes, TOP_K, metric).select(
            F.lit(metric).alias("metric"), "probe_id", "rank", "id", F.round("score", 6).alias("score")
        )
        out = top if out is None else out.unionByName(top)
    return out
