"""Queries on structures of their own: digest trees, bucketed targets, pivot indexes, selection, dictionaries,
recovered dimensions and typed metadata (S1, S14, K1, K5, K6, J1, J4, A6, G6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import typed_metadata as M
from ..operators import dimension_match, knn, selection
from ..operators.bucketed import BucketedTarget
from ..operators.digest_tree import tree_reconcile
from ..operators.id_dictionary import IdDictionary
from ..operators.knn_index import PivotIndex
from ..session import scratch_path
from . import sqlkit as S
from .common import TOP_K, source, table
from .record_queries import _IDS_SQL, CANON_SQL, W, _ids_with_prefixed, _label, _reconcile_target, _upsert_sides, canon_out
from .registry import ORACLES, query

# ── J4, K1, J5: digest tree and bucketed target ──────────────────────────────


@query("reconcile_tree", ORACLES["reconcile"])
def reconcile_tree(spark, sf_dir):
    src = source(spark, sf_dir)
    statuses, _ = tree_reconcile(src, _reconcile_target(src), atol=0.05, rtol=1e-5)
    return statuses


def _bucketed(spark, df) -> BucketedTarget:
    target = BucketedTarget(spark, f"target_{uuid.uuid4().hex[:12]}", scratch_path(spark, "bucketed"), max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    target.create(df)
    return target


@query("upsert_bucketed", ORACLES["upsert_replace"])
def upsert_bucketed(spark, sf_dir):
    tgt, upd = _upsert_sides(spark, sf_dir)
    target = _bucketed(spark, tgt)
    target.upsert(upd)
    return canon_out(target.rows())


@query("reconcile_bucketed", ORACLES["reconcile"])
def reconcile_bucketed(spark, sf_dir):
    src = source(spark, sf_dir)
    return _bucketed(spark, _reconcile_target(src)).reconcile(src, atol=0.05, rtol=1e-5)


@query("resume_bucketed", f"{W} SELECT {CANON_SQL} FROM src WHERE label >= 5")
def resume_bucketed(spark, sf_dir):
    src = source(spark, sf_dir)
    return canon_out(_bucketed(spark, src.where(_label(src) < 5)).remaining(src))


# ── J1, S14: pruned search with probes from the data ─────────────────────────

#: Every id that divides by this is a probe.
PROBE_EVERY = 100
_PROBES_SQL = f"probes AS (SELECT CAST(id AS BIGINT) AS probe_id, {S.dbl('vector')} AS q FROM src WHERE CAST(id AS BIGINT) % {PROBE_EVERY} = 0 AND len(vector) > 0)"


@query("gen_probes", f"{W}, {_PROBES_SQL} SELECT probe_id, CAST(len(q) AS INTEGER) AS dim, {S.fp('q')} AS fp FROM probes")
def gen_probes(spark, sf_dir):
    from ..functions import vectors as V

    probes = knn.data_probes(source(spark, sf_dir), PROBE_EVERY)
    return probes.select("probe_id", F.size("probe").alias("dim"), V.fingerprint("probe").alias("fp"))


_PRUNED_SQL = " UNION ALL ".join(
    f"SELECT '{m}' AS metric, probe_id, CAST(rank AS INTEGER) AS rank, id, round(score, 6) + 0.0 AS score FROM {m}_top" for m in ("cosine", "dot", "l2")
)


@query(
    "knn_pruned",
    f"{W}, {S.DIMS}, {_PROBES_SQL}, " + ", ".join(S.topk(f"{m}_top", "src", TOP_K, m) for m in ("cosine", "dot", "l2")) + f" {_PRUNED_SQL}",
)
def knn_pruned(spark, sf_dir):
    src = source(spark, sf_dir)
    probes = knn.data_probes(src, PROBE_EVERY)
    out = None
    for metric in ("cosine", "dot", "l2"):
        top, _ = PivotIndex.build(src, metric).search(probes, TOP_K)
        part = top.select(F.lit(metric).alias("metric"), "probe_id", "rank", "id", (F.round("score", 6) + 0.0).alias("score"))  # a distance of zero has no sign
        out = part if out is None else out.unionByName(part)
    return out


# ── A6: percentiles by selection ─────────────────────────────────────────────

_SELECTED = "SELECT CASE WHEN event_type = 'view' THEN NULL ELSE event_type END AS g, CASE WHEN event_id % 25 = 0 THEN NULL ELSE value END AS v FROM events"


@query(
    "latency_percentiles_selected",
    f"WITH e AS ({_SELECTED}), r AS (SELECT g, v, row_number() OVER (PARTITION BY g ORDER BY v NULLS FIRST) - 1 AS k, count(*) OVER (PARTITION BY g) AS n FROM e) "
    "SELECT g, n, "
    + ", ".join(f"max(v) FILTER (WHERE k = least(floor(n * {p} / 100.0), n - 1)) AS p{p}" for p in (1, 50, 95, 99))
    + " FROM r GROUP BY g, n",
)
def latency_percentiles_selected(spark, sf_dir):
    """A group without a name and values that are missing among the rest."""
    ev = table(spark, sf_dir, "events")
    g = F.when(F.col("event_type") != "view", F.col("event_type"))
    v = F.when(F.col("event_id") % 25 != 0, F.col("value"))
    return selection.select_ranks(ev.select(g.alias("g"), v.alias("v")), "g", "v", [1, 50, 95, 99])


# ── K5, J7: the id dictionary ────────────────────────────────────────────────


@query(
    "id_dictionary",
    f"{_IDS_SQL}, old AS (SELECT id FROM src WHERE label < 5) SELECT m.id, point_id, CAST(CASE WHEN o.id IS NULL THEN 1 ELSE 0 END AS BIGINT) AS run FROM m LEFT JOIN old o USING (id)",
)
def id_dictionary(spark, sf_dir):
    """A first run over some ids, a second one over all of them and a third that finds nothing new."""
    src = source(spark, sf_dir)
    d = IdDictionary(spark, scratch_path(spark, "id-dictionary"))
    d.extend(src.where(_label(src) < 5))
    for _ in range(2):
        d.extend(_ids_with_prefixed(spark, sf_dir))
    return d.entries()


# ── G6: the recovered dimension order ────────────────────────────────────────

_PAIRS_SQL = """
, case_rows AS (
  SELECT 'shuffled' AS side, id, list_transform(range(len(vector)), lambda j: vector[(j * 5 + 3) % len(vector) + 1]) AS other FROM src
  UNION ALL SELECT 'as it was', id, vector FROM src
  UNION ALL SELECT 'unrelated', s.id, t.vector FROM src s JOIN src t ON CAST(t.id AS BIGINT) = (CAST(s.id AS BIGINT) + 1) % (SELECT count(*) FROM src)
), s AS (SELECT id, unnest(range(len(vector))) AS i, unnest(vector) AS x FROM src),
t AS (SELECT side, id, unnest(range(len(other))) AS j, unnest(other) AS y FROM case_rows),
pairs AS (SELECT side, i, j FROM s JOIN t USING (id) GROUP BY side, i, j HAVING bool_and(x = y)),
sides AS (SELECT side, (SELECT count(*) FROM pairs p WHERE p.side = c.side) AS n, (SELECT count(*) FROM pairs p WHERE p.side = c.side AND i = j) AS fixed FROM (SELECT DISTINCT side FROM case_rows) c)
SELECT side, CAST(i AS INTEGER) AS source_dim, CAST(j AS INTEGER) AS target_dim, CASE WHEN fixed = n THEN 'same' ELSE 'permuted' END AS verdict
FROM pairs JOIN sides USING (side) UNION ALL SELECT side, NULL, NULL, 'none' FROM sides WHERE n = 0
"""


@query("dimension_order_recover", W + _PAIRS_SQL)
def dimension_order_recover(spark, sf_dir):
    src = source(spark, sf_dir)
    d = F.size("vector")
    shuffled = src.withColumn("vector", F.transform(F.sequence(F.lit(0), d - 1), lambda j: F.element_at("vector", (j * 5 + 3) % F.size("vector") + 1)))
    n = src.count()
    unrelated = src.withColumn("id", ((F.col("id").cast("bigint") + n - 1) % n).cast("string"))
    out = None
    for side, target in (("shuffled", shuffled), ("as it was", src), ("unrelated", unrelated)):
        part = dimension_match.recover_dimension_order(src, target).withColumn("side", F.lit(side))
        out = part if out is None else out.unionByName(part)
    return out


# ── S1, K6: typed metadata ───────────────────────────────────────────────────


@query(
    "metadata_variant",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.k') AS k_text, CAST(NULL AS VARCHAR) AS missing, "
    "'OBJECT<id: BIGINT, props: OBJECT<k: BIGINT>, tags: ARRAY<STRING>, valued: BOOLEAN>' AS kind, event_type AS first_tag FROM events "
    "WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 20",
)
def metadata_variant(spark, sf_dir):
    """Nested metadata written as VARIANT and read back: fields by path and type, a filter on one, the value's own schema."""
    ev = table(spark, sf_dir, "events")
    nested = F.to_variant_object(F.struct(F.col("event_id").alias("id"), M.parse_metadata("props").alias("props"), F.array("event_type").alias("tags"), (F.col("value") >= 0).alias("valued")))
    path = scratch_path(spark, "variant")
    ev.select("event_id", nested.alias("metadata")).write.parquet(path)
    stored = M.where_field(spark.read.parquet(path), "$.props.k", "bigint", lambda k: k >= 20)
    fields = {"k": ("$.props.k", "bigint"), "k_text": ("$.props.k", "string"), "missing": ("$.props.none", "string"), "first_tag": ("$.tags[0]", "string")}
    return M.project_fields(stored.withColumn("kind", F.schema_of_variant("metadata")), fields)
