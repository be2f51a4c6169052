"""Readers, projections, guards, scalar functions, writers and joins on canonical records.

Every query starts from the whole ``embeddings`` (or ``events``) table;
dumps of each vendor shape are derived from it in Spark and normalised back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import batching, guards, paging, reconcile as R, upsert as U
from ..sources import changes, dumps
from ..sources.canonical import canonicalize
from . import sqlkit as S
from .common import BATCH_SIZE, rounded_copy, source, table
from .registry import query

FP = S.fp("vector")
CANON_SQL = f"id, CAST(len(vector) AS INTEGER) AS dim, {FP} AS fp, meta_label, namespace"
W = f"WITH {S.SRC}"
BATCHED_SQL = (
    f"batched AS (SELECT *, (row_number() OVER (ORDER BY id) - 1) // {BATCH_SIZE} AS batch_id, "
    f"(row_number() OVER (ORDER BY id) - 1) % {BATCH_SIZE} AS pos FROM src)"
)
SINCE = "2024-01-15 00:00:00"


def canon_out(df: DataFrame, *others: str) -> DataFrame:
    return df.select(
        "id",
        F.size("vector").alias("dim"),
        V.fingerprint("vector").alias("fp"),
        F.try_element_at("metadata", F.lit("label")).alias("meta_label"),
        "namespace",
        *others,
    )


def _label(df):
    return F.col("metadata")["label"].cast("int")


# ── S1-S8, S11: readers ──────────────────────────────────────────────────────


@query("scan_canonical", f"{W} SELECT {CANON_SQL} FROM src")
def scan_canonical(spark, sf_dir):
    return canon_out(source(spark, sf_dir))


@query("scan_text_vectors", f"{W} SELECT {CANON_SQL} FROM src")
def scan_text_vectors(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    dump = e.select("vec_id", dumps.format_text_vector("embedding").alias("embedding_text"), "label")
    recs = dumps.from_text_vectors(dump, "vec_id", "embedding_text", ["label"], F.concat(F.lit("ns"), F.col("label").cast("string")))
    return canon_out(recs)


def _pages(spark, sf_dir):
    src = source(spark, sf_dir)
    b = batching.assign_batches(src, BATCH_SIZE)
    meta = F.when(_label(b) == 0, F.lit(None)).otherwise(F.col("metadata"))
    by_pos = lambda x, y: F.when(x["pos"] < y["pos"], -1).when(x["pos"] > y["pos"], 1).otherwise(0)
    g = b.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("pos", "id", "vector", meta.alias("m"))), by_pos).alias("rs"))
    return g.select(
        "batch_id",
        F.transform("rs", lambda r: r["id"]).alias("ids"),
        F.transform("rs", lambda r: r["vector"]).alias("embeddings"),
        F.transform("rs", lambda r: r["m"]).alias("metadatas"),
    )


@query(
    "scan_parallel_arrays",
    f"{W} SELECT id, CAST(len(vector) AS INTEGER) AS dim, {FP} AS fp, "
    "CASE WHEN label = 0 THEN NULL ELSE meta_label END AS meta_label, CAST(NULL AS VARCHAR) AS namespace FROM src",
)
def scan_parallel_arrays(spark, sf_dir):
    return canon_out(dumps.from_parallel_arrays(_pages(spark, sf_dir)))


@query("scan_points", f"{W} SELECT id, CAST(len(vector) AS INTEGER) AS dim, {FP} AS fp, meta_label, CAST(NULL AS VARCHAR) AS namespace FROM src")
def scan_points(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    docs = e.select(
        F.to_json(F.struct(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.struct("label").alias("payload"))).alias("value")
    )
    return canon_out(dumps.from_points(docs))


@query("scan_ids_then_fetch", f"{W} SELECT {CANON_SQL} FROM src WHERE namespace = 'ns3'")
def scan_ids_then_fetch(spark, sf_dir):
    return canon_out(dumps.scan_ids_then_fetch(source(spark, sf_dir), "ns3"))


def _named(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    objs = e.select(
        F.col("vec_id").cast("string").alias("uuid"),
        F.when(F.col("label") == 9, F.create_map(F.lit("alt"), "embedding"))
        .otherwise(F.create_map(F.lit("default"), "embedding"))
        .alias("vector"),
        F.create_map(F.lit("label"), F.col("label").cast("string")).alias("properties"),
    )
    return dumps.from_named_vectors(objs)


NAMED_SQL = (
    "named AS (SELECT id, CASE WHEN label = 9 THEN CAST([] AS FLOAT[]) ELSE vector END AS vector, "
    "meta_label, CAST(NULL AS VARCHAR) AS namespace FROM src)"
)


@query("scan_named_vectors", f"{W}, {NAMED_SQL} SELECT {CANON_SQL} FROM named")
def scan_named_vectors(spark, sf_dir):
    return canon_out(_named(spark, sf_dir))


@query(
    "scan_positional_ids",
    "SELECT CASE WHEN label <> 0 THEN 'doc-' || CAST(vec_id AS VARCHAR) ELSE CAST(vec_id AS VARCHAR) END AS id, "
    f"vec_id AS pos, {S.fp('embedding')} AS fp FROM embeddings",
)
def scan_positional_ids(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    vecs = e.select(F.col("vec_id").alias("pos"), F.col("embedding").alias("vector"))
    ids = e.where(F.col("label") != 0).select(F.col("vec_id").alias("pos"), F.concat(F.lit("doc-"), F.col("vec_id").cast("string")).alias("id"))
    recs = dumps.from_positional(vecs, ids)
    return recs.select("id", "pos", V.fingerprint("vector").alias("fp"))


@query(
    "ingest_json_batches",
    f"{W}, {BATCHED_SQL} SELECT batch_id, pos, id, {FP} AS fp, count(*) OVER (PARTITION BY batch_id) AS received FROM batched",
)
def ingest_json_batches(spark, sf_dir):
    b = batching.assign_batches(source(spark, sf_dir), BATCH_SIZE)
    bodies = dumps.to_json_batches(b)
    rows = dumps.from_json_batches(bodies)
    return rows.select("batch_id", "pos", "id", V.fingerprint("vector").alias("fp"), "received")


@query(
    "scan_changes",
    f"SELECT event_id, CAST(user_id AS VARCHAR) AS id, epoch_us(ts) AS ts_us, event_type FROM events WHERE ts > TIMESTAMP '{SINCE}'",
)
def scan_changes(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    ch = changes.scan_changes(ev.withColumn("id", F.col("user_id").cast("string")), SINCE, "ts", "id")
    return ch.select("event_id", "id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_us"), "event_type")


# ── P1-P8: projections, filters, paging ──────────────────────────────────────


@query(
    "canonical_cast",
    f"{W} SELECT id, CAST(len(vector) AS INTEGER) AS dim, {FP} AS fp, CASE WHEN label = 0 THEN NULL ELSE meta_label END AS meta_label, "
    "CAST(NULL AS VARCHAR) AS namespace FROM src",
)
def canonical_cast(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings")
    raw = e.select(
        F.col("vec_id").alias("key"),
        F.col("embedding").cast("array<double>").alias("vec"),
        F.when(F.col("label") == 0, F.lit(None)).otherwise(F.create_map(F.lit("label"), F.col("label"))).alias("meta"),
    )
    return canon_out(canonicalize(raw, "key", "vec", "meta"))


@query("filter_namespace", f"{W} SELECT {CANON_SQL} FROM src WHERE namespace = 'ns3'")
def filter_namespace(spark, sf_dir):
    return canon_out(source(spark, sf_dir).where(F.col("namespace") == "ns3"))


@query(
    "restructure_namespace",
    f"{W} SELECT id, CASE WHEN namespace IN ('ns3', 'ns4') THEN 'archive' ELSE namespace END AS namespace, "
    "namespace AS previous_namespace FROM src",
)
def restructure_namespace(spark, sf_dir):
    src = source(spark, sf_dir)
    moved = src.withColumn("previous_namespace", F.col("namespace")).withColumn(
        "namespace", F.when(F.col("namespace").isin("ns3", "ns4"), F.lit("archive")).otherwise(F.col("namespace"))
    )
    return moved.select("id", "namespace", "previous_namespace")


@query(
    "drop_empty_vectors",
    f"{W}, {NAMED_SQL} SELECT id, CAST(len(vector) AS INTEGER) AS dim, "
    "CASE WHEN len(vector) > 0 THEN 'kept' ELSE 'rejected' END AS status FROM named",
)
def drop_empty_vectors(spark, sf_dir):
    named = _named(spark, sf_dir)
    return named.select("id", F.size("vector").alias("dim"), guards.vector_status("vector").alias("status"))


@query("page_offset", f"{W} SELECT {CANON_SQL} FROM src ORDER BY id LIMIT 50 OFFSET 100")
def page_offset(spark, sf_dir):
    return canon_out(paging.page_offset(source(spark, sf_dir), 100, 50))


@query("page_keyset", f"{W} SELECT {CANON_SQL} FROM src WHERE id > '200' ORDER BY id LIMIT 50")
def page_keyset(spark, sf_dir):
    return canon_out(paging.page_keyset(source(spark, sf_dir), "200", 50))


@query("assign_batches", f"{W}, {BATCHED_SQL} SELECT id, batch_id, pos FROM batched")
def assign_batches(spark, sf_dir):
    return batching.assign_batches(source(spark, sf_dir).select("id"), BATCH_SIZE).select("id", "batch_id", "pos")


@query("limit_records", f"{W} SELECT {CANON_SQL} FROM src ORDER BY id LIMIT 100")
def limit_records(spark, sf_dir):
    return canon_out(paging.limit_records(source(spark, sf_dir), 100))


# ── G1-G6: guards ────────────────────────────────────────────────────────────


def _dim_sql(name, table_):
    return (
        f"{name}_p AS (SELECT len(vector) AS dim, count(*) AS n FROM {table_} GROUP BY 1), "
        f"{name} AS (SELECT (SELECT dim FROM {name}_p WHERE dim > 0 ORDER BY n DESC, dim LIMIT 1) AS modal_dim, "
        f"(SELECT sum(n) FROM {name}_p) AS n_rows, "
        f"(SELECT sum(n) FROM {name}_p) - coalesce((SELECT n FROM {name}_p WHERE dim > 0 ORDER BY n DESC, dim LIMIT 1), 0) AS n_ragged)"
    )


@query(
    "dimension_guard",
    f"{W}, {NAMED_SQL}, {_dim_sql('ds', 'src')}, {_dim_sql('dt', 'named')}, "
    "sides AS (SELECT 'source' AS side, * FROM ds UNION ALL SELECT 'target', * FROM dt) "
    "SELECT side, CAST(modal_dim AS INTEGER) AS modal_dim, CAST(n_rows AS BIGINT) AS n_rows, CAST(n_ragged AS BIGINT) AS n_ragged, "
    "CASE WHEN (SELECT min(modal_dim) FROM sides) <> (SELECT max(modal_dim) FROM sides) THEN 'mismatch' "
    "WHEN n_ragged > 0 THEN 'ragged' ELSE 'ok' END AS verdict FROM sides",
)
def dimension_guard(spark, sf_dir):
    return guards.dimension_check(source(spark, sf_dir), _named(spark, sf_dir))


@query(
    "dimension_profile",
    f"{W}, {NAMED_SQL} SELECT CAST(len(vector) AS INTEGER) AS dim, count(*) AS n FROM named GROUP BY 1",
)
def dimension_profile(spark, sf_dir):
    return guards.dimension_profile(_named(spark, sf_dir))


def _norm_sides(spark, sf_dir):
    src = source(spark, sf_dir)
    scaled = src.withColumn(
        "vector", F.transform("vector", lambda x: (x * (F.lit(1.0) + _label(src) / 10.0)).cast("float"))
    )
    return {"source": src, "rounded": rounded_copy(src), "scaled": scaled}


@query(
    "norm_profile",
    f"{W}, {S.TGT_ROUNDED}, scaled AS (SELECT id, list_transform(vector, lambda x: CAST(x * (1.0 + label / 10.0) AS FLOAT)) AS vector FROM src), "
    f"n AS (SELECT 'source' AS side, {S.norm('vector')} AS nrm FROM src UNION ALL SELECT 'rounded', {S.norm('vector')} FROM tgt "
    f"UNION ALL SELECT 'scaled', {S.norm('vector')} FROM scaled) "
    "SELECT side, round(min(nrm), 6) AS min_norm, round(avg(nrm), 6) AS avg_norm, round(max(nrm), 6) AS max_norm, "
    "round(avg(CAST(abs(nrm - 1) < 1e-3 AS DOUBLE)), 6) AS unit_share, "
    "CASE WHEN avg(CAST(abs(nrm - 1) < 1e-3 AS DOUBLE)) = 1 THEN 'unit' WHEN avg(CAST(abs(nrm - 1) < 1e-3 AS DOUBLE)) = 0 "
    "THEN 'not_unit' ELSE 'mixed' END AS verdict FROM n GROUP BY side",
)
def norm_profile(spark, sf_dir):
    out = None
    for side, df in _norm_sides(spark, sf_dir).items():
        p = guards.norm_profile(df, side)
        out = p if out is None else out.unionByName(p)
    return out.select(
        "side",
        *[F.round(c, 6).alias(c) for c in ("min_norm", "avg_norm", "max_norm", "unit_share")],
        guards.normalisation_verdict(out).alias("verdict"),
    )


@query(
    "dimension_order_check",
    f"{W}, {S.TGT_ROUNDED}, t2 AS (SELECT id, CASE WHEN label = 1 THEN list_reverse(s.vector) WHEN label = 2 THEN t.vector "
    "ELSE s.vector END AS tv, s.vector AS sv FROM src s JOIN tgt t USING (id, label)), "
    "x AS (SELECT id, list_sort(sv) = list_sort(tv) AND sv <> tv AS permuted, unnest(range(0, len(sv))) AS i, sv, tv FROM t2 WHERE len(sv) = len(tv)), "
    "d AS (SELECT id, permuted, CAST(i AS INTEGER) AS dim_index, abs(CAST(sv[i + 1] AS DOUBLE) - CAST(tv[i + 1] AS DOUBLE)) AS d FROM x) "
    "SELECT dim_index, round(max(d), 6) AS max_abs_diff, count(*) FILTER (WHERE d > 0) AS n_rows_differ, "
    "count(*) FILTER (WHERE permuted) AS n_permuted FROM d GROUP BY dim_index",
)
def dimension_order_check(spark, sf_dir):
    src = source(spark, sf_dir)
    rnd = rounded_copy(src).select("id", F.col("vector").alias("rv"))
    tgt = src.join(rnd, "id").select(
        "id",
        F.when(_label(src) == 1, F.reverse("vector")).when(_label(src) == 2, F.col("rv")).otherwise(F.col("vector")).alias("vector"),
    )
    out = guards.dimension_order_check(src, tgt)
    return out.select("dim_index", F.round("max_abs_diff", 6).alias("max_abs_diff"), "n_rows_differ", "n_permuted")


# ── scalar functions ─────────────────────────────────────────────────────────


@query("fn_string_vector_parse", f"{W} SELECT id, CAST(len(vector) AS INTEGER) AS dim, {FP} AS fp FROM src")
def fn_string_vector_parse(spark, sf_dir):
    src = source(spark, sf_dir)
    text = F.concat(F.lit("[ "), F.array_join(F.transform("vector", lambda x: x.cast("string")), ", "), F.lit(" ]"))
    parsed = src.select("id", dumps.parse_text_vector(text).alias("vector"))
    return parsed.select("id", F.size("vector").alias("dim"), V.fingerprint("vector").alias("fp"))


@query("fn_metadata_lookup", f"{W} SELECT id, meta_label AS label, CAST(NULL AS VARCHAR) AS firm FROM src")
def fn_metadata_lookup(spark, sf_dir):
    src = source(spark, sf_dir)
    return src.select("id", F.try_element_at("metadata", F.lit("label")).alias("label"), F.try_element_at("metadata", F.lit("firm")).alias("firm"))


@query("fn_metadata_merge", f"{W} SELECT id, 3 AS n_keys, id AS orig_id, meta_label AS label FROM src")
def fn_metadata_merge(spark, sf_dir):
    src = source(spark, sf_dir)
    merged = F.map_concat("metadata", F.create_map(F.lit("orig_id"), F.col("id"), F.lit("source"), F.lit("embeddings")))
    m = src.select("id", merged.alias("m"))
    return m.select("id", F.size("m").alias("n_keys"), F.col("m")["orig_id"].alias("orig_id"), F.col("m")["label"].alias("label"))


@query(
    "fn_json_metadata",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type FROM events",
)
def fn_json_metadata(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    meta = F.from_json("props", "map<string,string>")
    return ev.select("event_id", meta["k"].cast("bigint").alias("k"), "event_type")


@query(
    "fn_hash_ids",
    f"{W} SELECT id, md5(id) AS id_md5, sha256('vec_' || id) AS id_sha256, "
    "('0x' || substr(md5(id), 1, 15))::BIGINT AS id_hash60 FROM src",
)
def fn_hash_ids(spark, sf_dir):
    src = source(spark, sf_dir)
    return src.select(
        "id",
        F.md5("id").alias("id_md5"),
        F.sha2(F.concat(F.lit("vec_"), F.col("id")), 256).alias("id_sha256"),
        F.conv(F.substring(F.md5("id"), 1, 15), 16, 10).cast("bigint").alias("id_hash60"),
    )


@query(
    "fn_norm_round",
    f"{W}, u AS (SELECT id, vector, list_transform(vector, lambda x: CAST(x / ({S.norm('vector')} + 1e-9) AS FLOAT)) AS uv FROM src) "
    f"SELECT id, round({S.norm('vector')}, 6) AS norm6, round({S.norm('uv')}, 6) AS unit_norm6, {S.fp('uv')} AS unit_fp FROM u",
)
def fn_norm_round(spark, sf_dir):
    src = source(spark, sf_dir)
    u = src.select("id", "vector", V.l2_normalise("vector").alias("uv"))
    return u.select(
        "id", F.round(V.norm("vector"), 6).alias("norm6"), F.round(V.norm("uv"), 6).alias("unit_norm6"), V.fingerprint("uv").alias("unit_fp")
    )


@query(
    "vec_dot",
    f"{W}, {S.TGT_ROUNDED} SELECT s.id, round({S.dot('s.vector', 't.vector')}, 6) AS dot FROM src s JOIN tgt t USING (id)",
)
def vec_dot(spark, sf_dir):
    src = source(spark, sf_dir)
    t = rounded_copy(src).select("id", F.col("vector").alias("tv"))
    return src.join(t, "id").select("id", F.round(V.dot("vector", "tv"), 6).alias("dot"))


@query("vec_norm", f"{W} SELECT id, round({S.norm('vector')}, 6) AS norm FROM src")
def vec_norm(spark, sf_dir):
    return source(spark, sf_dir).select("id", F.round(V.norm("vector"), 6).alias("norm"))


@query(
    "vec_cosine",
    f"{W}, {S.TGT_ROUNDED} SELECT s.id, round({S.cos('s.vector', 't.vector')}, 6) AS cosine FROM src s JOIN tgt t USING (id)",
)
def vec_cosine(spark, sf_dir):
    src = source(spark, sf_dir)
    t = rounded_copy(src).select("id", F.col("vector").alias("tv"))
    return src.join(t, "id").select("id", F.round(V.cosine("vector", "tv"), 6).alias("cosine"))


@query(
    "vec_l2_normalise",
    f"{W}, {S.TGT_ROUNDED}, u AS (SELECT id, list_transform(vector, lambda x: CAST(x / ({S.norm('vector')} + 1e-9) AS FLOAT)) AS uv FROM tgt) "
    f"SELECT id, {S.fp('uv')} AS fp, round({S.norm('uv')}, 6) AS norm FROM u",
)
def vec_l2_normalise(spark, sf_dir):
    t = rounded_copy(source(spark, sf_dir)).select("id", V.l2_normalise("vector").alias("uv"))
    return t.select("id", V.fingerprint("uv").alias("fp"), F.round(V.norm("uv"), 6).alias("norm"))


# ── K1-K7: writers ───────────────────────────────────────────────────────────


def _upsert_sides(spark, sf_dir):
    src = source(spark, sf_dir)
    tgt = rounded_copy(src).where(_label(src) < 5)
    upd = src.where(_label(src) >= 3)
    return tgt, upd


@query(
    "upsert_replace",
    f"{W}, {S.TGT_ROUNDED} SELECT {CANON_SQL} FROM tgt WHERE label < 5 AND id NOT IN (SELECT id FROM src WHERE label >= 3) "
    f"UNION ALL SELECT {CANON_SQL} FROM src WHERE label >= 3",
)
def upsert_replace(spark, sf_dir):
    tgt, upd = _upsert_sides(spark, sf_dir)
    return canon_out(U.upsert_replace(tgt, upd))


@query(
    "upsert_vector_only",
    f"{W}, {S.TGT_ROUNDED}, t AS (SELECT * FROM tgt WHERE label < 5), s AS (SELECT * FROM src WHERE label >= 3) "
    f"SELECT coalesce(s.id, t.id) AS id, {S.fp('CASE WHEN s.id IS NOT NULL THEN s.vector ELSE t.vector END')} AS fp, "
    "CASE WHEN t.id IS NOT NULL THEN 'old' ELSE 'new' END AS tier FROM t FULL OUTER JOIN s ON t.id = s.id",
)
def upsert_vector_only(spark, sf_dir):
    tgt, upd = _upsert_sides(spark, sf_dir)
    tgt = tgt.withColumn("metadata", F.map_concat("metadata", F.create_map(F.lit("tier"), F.lit("old"))))
    upd = upd.withColumn("metadata", F.map_concat("metadata", F.create_map(F.lit("tier"), F.lit("new"))))
    out = U.upsert_vector_only(tgt, upd)
    return out.select("id", V.fingerprint("vector").alias("fp"), F.col("metadata")["tier"].alias("tier"))


@query(
    "append_records",
    f"{W}, {S.TGT_ROUNDED} SELECT {CANON_SQL} FROM tgt WHERE label < 5 UNION ALL SELECT {CANON_SQL} FROM src WHERE label >= 3",
)
def append_records(spark, sf_dir):
    tgt, upd = _upsert_sides(spark, sf_dir)
    return canon_out(U.append_records(tgt, upd))


def _ids_with_prefixed(spark, sf_dir):
    src = source(spark, sf_dir)
    return src.select("id").unionByName(src.select(F.concat(F.lit("doc-"), F.col("id")).alias("id")))


_POINT_SQL = (
    "CASE WHEN regexp_full_match(id, '[0-9]{1,18}') THEN CAST(id AS BIGINT) "
    "ELSE ('0x' || substr(md5(id), 1, 15))::BIGINT END"
)
_IDS_SQL = f"{W}, ids AS (SELECT DISTINCT id FROM (SELECT id FROM src UNION ALL SELECT 'doc-' || id FROM src)), " + (
    f"m AS (SELECT id, {_POINT_SQL} AS point_id FROM ids), "
    "m2 AS (SELECT id, point_id, count(*) OVER (PARTITION BY point_id) AS n_sharing FROM m)"
)


@query("stable_point_id", f"{_IDS_SQL} SELECT id, point_id, n_sharing FROM m2")
def stable_point_id_q(spark, sf_dir):
    return U.id_map(_ids_with_prefixed(spark, sf_dir))


@query(
    "project_metadata_columns",
    f"{W} SELECT id, namespace, meta_label AS label, 'gold' AS tier, CAST(NULL AS VARCHAR) AS firm FROM src",
)
def project_metadata_columns(spark, sf_dir):
    src = source(spark, sf_dir).withColumn("metadata", F.map_concat("metadata", F.create_map(F.lit("tier"), F.lit("gold"))))
    return U.project_metadata_columns(src, ["label", "tier", "firm"]).drop("vector")


@query("format_text_vector", f"{W} SELECT id, CAST(len(vector) AS INTEGER) AS dim, true AS roundtrip_ok FROM src")
def format_text_vector(spark, sf_dir):
    src = source(spark, sf_dir)
    back = dumps.parse_text_vector(dumps.format_text_vector("vector"))
    return src.select("id", F.size("vector").alias("dim"), (V.fingerprint(back) == V.fingerprint("vector")).alias("roundtrip_ok"))


# ── J4-J7: joins ─────────────────────────────────────────────────────────────


def _reconcile_target(src):
    rnd = rounded_copy(src)
    lab = _label(rnd)
    changed = rnd.where(lab != 0).withColumn(
        "vector",
        F.when(lab == 7, F.transform("vector", lambda x, i: F.when(i == 0, (x + F.lit(0.1)).cast("float")).otherwise(x))).otherwise(
            F.col("vector")
        ),
    ).withColumn(
        "metadata", F.when(lab == 8, F.map_concat("metadata", F.create_map(F.lit("tier"), F.lit("x")))).otherwise(F.col("metadata"))
    )
    extra = rnd.where(lab == 9).withColumn("id", F.concat(F.lit("x"), F.col("id")))
    return changed.unionByName(extra)


@query(
    "reconcile",
    f"{W} SELECT id, CASE WHEN label = 0 THEN 'missing' WHEN label = 7 THEN 'vector_differs' "
    "WHEN label = 8 THEN 'metadata_differs' ELSE 'match' END AS status FROM src "
    "UNION ALL SELECT 'x' || id, 'extra' FROM src WHERE label = 9",
)
def reconcile_q(spark, sf_dir):
    src = source(spark, sf_dir)
    return R.reconcile(src, _reconcile_target(src), atol=0.05, rtol=1e-5)  # the target is a copy rounded to two decimals


@query(
    "resume_remaining",
    f"{W}, {BATCHED_SQL} SELECT id FROM batched WHERE batch_id >= 3",
)
def resume_remaining(spark, sf_dir):
    src = source(spark, sf_dir)
    committed = batching.assign_batches(src.select("id"), BATCH_SIZE).where(F.col("batch_id") < 3).select("id")
    return src.join(committed, "id", "left_anti").select("id")


@query(
    "fetch_by_ids",
    f"{W}, {S.TGT_ROUNDED} SELECT {CANON_SQL} FROM tgt WHERE id IN (SELECT id FROM src WHERE label = 2)",
)
def fetch_by_ids(spark, sf_dir):
    src = source(spark, sf_dir)
    ids = src.where(_label(src) == 2).select("id")
    return canon_out(dumps.fetch_by_ids(rounded_copy(src), ids))


@query(
    "id_map_join",
    f"{_IDS_SQL} SELECT s.id, m2.point_id, {S.fp('s.vector')} AS fp FROM src s JOIN m2 USING (id)",
)
def id_map_join(spark, sf_dir):
    src = source(spark, sf_dir)
    m = U.id_map(_ids_with_prefixed(spark, sf_dir))
    return src.join(m, "id").select("id", "point_id", V.fingerprint("vector").alias("fp"))
