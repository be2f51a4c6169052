"""Batch digests, frames, transfer statistics, rotation and marks."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..functions.digest import batch_digests
from ..operators import batching, frames, marks, rotate
from ..operators import knn
from . import sqlkit as S
from .common import BATCH_SIZE, source
from .record_queries import BATCHED_SQL, FP, W
from .registry import query

KEY_SEED = rotate.KEY_SEED
JOB_ID = "job-embeddings"


def batched_source(spark, sf_dir) -> DataFrame:
    return batching.assign_batches(source(spark, sf_dir), BATCH_SIZE)


DG = f"{W}, {BATCHED_SQL}, {S.batch_digest_ctes()}"
META_LEN = "strlen('{\"label\":\"' || meta_label || '\"}')"
SEALED_SQL = (
    f"sz AS (SELECT batch_id, 52 + sum(4 * len(vector) + 8 + strlen(id) + {META_LEN} + strlen(namespace)) AS sealed_bytes, "
    "8 + sum(4 + strlen(id) + 4 * len(vector)) AS binary_bytes, sum(4 * len(vector)) AS raw_bytes, "
    "count(*) * max(len(vector)) * 18 AS json_equiv_bytes, count(*) AS n FROM batched GROUP BY batch_id)"
)


@query("batch_digest", f"{DG} SELECT batch_id, CAST(cnt AS BIGINT) AS count, CAST(dim AS INTEGER) AS dim, digest FROM dg")
def batch_digest(spark, sf_dir):
    return batch_digests(batched_source(spark, sf_dir))


@query(
    "seal_batches",
    f"{DG}, {SEALED_SQL} SELECT dg.batch_id, CAST(cnt AS INTEGER) AS count, CAST(dim AS INTEGER) AS dim, digest, "
    "CAST(sealed_bytes AS BIGINT) AS frame_bytes FROM dg JOIN sz USING (batch_id)",
)
def seal_batches(spark, sf_dir):
    fr = frames.seal_batches(batched_source(spark, sf_dir))
    return fr.select("batch_id", "count", "dim", "digest", F.octet_length("frame").cast("bigint").alias("frame_bytes"))


@query("unseal_batches", f"{W}, {BATCHED_SQL} SELECT batch_id, pos, id, {FP} AS fp, true AS verified FROM batched")
def unseal_batches(spark, sf_dir):
    rows = frames.unseal_batches(frames.seal_batches(batched_source(spark, sf_dir)))
    return rows.select("batch_id", "pos", "id", V.fingerprint("vector").alias("fp"), "verified")


@query(
    "ingest_binary_batches",
    f"{W}, {BATCHED_SQL} SELECT batch_id, pos, id, {FP} AS fp, count(*) OVER (PARTITION BY batch_id) AS received FROM batched",
)
def ingest_binary_batches(spark, sf_dir):
    rows = frames.unpack_binary_batches(frames.pack_binary_batches(batched_source(spark, sf_dir)))
    return rows.select("batch_id", "pos", "id", V.fingerprint("vector").alias("fp"), "received")


def transfer_stats(spark, sf_dir, tamper: bool = False) -> DataFrame:
    """Seal every batch, (optionally damage some frames,) unseal, and count per batch."""
    fr = frames.seal_batches(batched_source(spark, sf_dir))
    if tamper:
        fr = tampered(fr)
    # one narrow pass over the frames: what the sender put in the row, what the receiver decodes
    return frames.receive(fr).select(
        F.lit(JOB_ID).alias("job_id"),
        "batch_id",
        "sent",
        "received",
        "verified",
        (F.col("received") - F.col("verified")).alias("failed"),
        "wire_bytes",
        (F.col("sent") * F.col("dim") * 4).cast("bigint").alias("raw_bytes"),
    )


def tampered(fr: DataFrame) -> DataFrame:
    """Damage the first vector of frames whose digest starts with 0-3 (a content-chosen quarter)."""
    pos = frames.SEALED_HEADER + 4  # high byte of element 0 (float32 little-endian)
    hit = F.substring("digest", 1, 1) < F.lit("4")
    byte = F.substring("frame", pos, 1)
    new = F.when(byte == F.unhex(F.lit("00")), F.unhex(F.lit("01"))).otherwise(F.unhex(F.lit("00")))
    damaged = F.concat(F.substring("frame", 1, pos - 1), new, F.expr(f"substring(frame, {pos + 1})"))
    return fr.withColumn("frame", F.when(hit, damaged).otherwise(F.col("frame")))


STATS_SQL = (
    f"{DG}, {SEALED_SQL}, st AS (SELECT '{JOB_ID}' AS job_id, batch_id, CAST(n AS BIGINT) AS sent, CAST(n AS BIGINT) AS received, "
    "CAST(CASE WHEN substr(digest, 1, 1) < '4' THEN 0 ELSE n END AS BIGINT) AS verified_t, CAST(n AS BIGINT) AS verified, "
    "CAST(sealed_bytes AS BIGINT) AS wire_bytes, CAST(raw_bytes AS BIGINT) AS raw_bytes FROM sz JOIN dg USING (batch_id))"
)


@query(
    "batch_stats",
    f"{STATS_SQL} SELECT job_id, batch_id, sent, received, verified, received - verified AS failed, wire_bytes, raw_bytes FROM st",
)
def batch_stats(spark, sf_dir):
    return transfer_stats(spark, sf_dir)


def rollup(stats: DataFrame) -> DataFrame:
    t = F.sum("received")
    return stats.groupBy("job_id").agg(
        F.sum("sent").cast("bigint").alias("total_vectors"),
        t.cast("bigint").alias("transferred"),
        F.sum("verified").cast("bigint").alias("verified"),
        F.sum("failed").cast("bigint").alias("failed"),
        F.count("*").alias("batches"),
        F.sum("wire_bytes").cast("bigint").alias("wire_bytes"),
        F.sum("raw_bytes").cast("bigint").alias("raw_bytes"),
        F.count_if(F.col("failed") > 0).alias("n_errors"),
        F.when(t > 0, F.round(F.sum("verified") / t * 100, 4)).otherwise(F.lit(0.0)).alias("verification_rate_pct"),
        F.when(F.sum("wire_bytes") > 0, F.round(F.sum("raw_bytes") / F.sum("wire_bytes"), 2)).otherwise(F.lit(0.0)).alias("raw_over_wire"),
    )


@query(
    "integrity_rollup",
    f"{STATS_SQL} SELECT job_id, CAST(sum(sent) AS BIGINT) AS total_vectors, CAST(sum(received) AS BIGINT) AS transferred, "
    "CAST(sum(verified_t) AS BIGINT) AS verified, CAST(sum(received - verified_t) AS BIGINT) AS failed, count(*) AS batches, "
    "CAST(sum(wire_bytes) AS BIGINT) AS wire_bytes, CAST(sum(raw_bytes) AS BIGINT) AS raw_bytes, "
    "count(*) FILTER (WHERE received > verified_t) AS n_errors, "
    "CASE WHEN sum(received) > 0 THEN round(sum(verified_t) / sum(received) * 100, 4) ELSE 0.0 END AS verification_rate_pct, "
    "CASE WHEN sum(wire_bytes) > 0 THEN round(sum(raw_bytes) / sum(wire_bytes), 2) ELSE 0.0 END AS raw_over_wire FROM st GROUP BY job_id",
)
def integrity_rollup(spark, sf_dir):
    return rollup(transfer_stats(spark, sf_dir, tamper=True))


@query(
    "failed_batches",
    f"{STATS_SQL} SELECT batch_id, CAST(received - verified_t AS BIGINT) AS failed, "
    "printf('Batch %d: %d of %d records failed verification', batch_id, received - verified_t, received) AS message "
    "FROM st WHERE received > verified_t",
)
def failed_batches(spark, sf_dir):
    st = transfer_stats(spark, sf_dir, tamper=True)
    return st.where(F.col("failed") > 0).select(
        "batch_id", "failed", F.format_string("Batch %d: %d of %d records failed verification", "batch_id", "failed", "received").alias("message")
    )


def sizes(records: DataFrame) -> DataFrame:
    """Bytes per batch; only lengths go through the numbering."""
    rec = records.select(
        "id",
        frames.sealed_record_bytes().alias("s"),
        frames.binary_record_bytes().alias("b"),
        (4 * F.size("vector")).alias("r"),
        F.size("vector").alias("d"),
    )
    return batching.assign_batches(rec, BATCH_SIZE).groupBy("batch_id").agg(
        F.count("*").alias("n"),
        F.sum("r").cast("bigint").alias("raw_bytes"),
        (F.lit(frames.BINARY_HEADER) + F.sum("b")).cast("bigint").alias("binary_bytes"),
        (F.lit(frames.SEALED_HEADER) + F.sum("s")).cast("bigint").alias("sealed_bytes"),
        (F.count("*") * F.max("d") * 18).cast("bigint").alias("json_equiv_bytes"),
    )


@query(
    "frame_sizes",
    f"{W}, {BATCHED_SQL}, {SEALED_SQL} SELECT batch_id, n, CAST(raw_bytes AS BIGINT) AS raw_bytes, CAST(binary_bytes AS BIGINT) AS binary_bytes, "
    "CAST(sealed_bytes AS BIGINT) AS sealed_bytes, CAST(json_equiv_bytes AS BIGINT) AS json_equiv_bytes FROM sz",
)
def frame_sizes(spark, sf_dir):
    return sizes(source(spark, sf_dir))


@query(
    "format_comparison",
    f"{W}, {BATCHED_SQL}, {SEALED_SQL} SELECT round(avg(json_equiv_bytes), 2) AS avg_json_equiv_bytes, round(avg(binary_bytes), 2) AS avg_binary_bytes, "
    "round(avg(sealed_bytes), 2) AS avg_sealed_bytes, round(avg(json_equiv_bytes) / avg(sealed_bytes), 3) AS json_over_sealed, "
    "round(avg(binary_bytes) / avg(sealed_bytes), 3) AS binary_over_sealed, "
    "round((sum(json_equiv_bytes) - sum(sealed_bytes)) / sum(json_equiv_bytes) * 100, 1) AS saved_pct FROM sz",
)
def format_comparison(spark, sf_dir):
    s = sizes(source(spark, sf_dir))
    return s.agg(
        F.round(F.avg("json_equiv_bytes"), 2).alias("avg_json_equiv_bytes"),
        F.round(F.avg("binary_bytes"), 2).alias("avg_binary_bytes"),
        F.round(F.avg("sealed_bytes"), 2).alias("avg_sealed_bytes"),
        F.round(F.avg("json_equiv_bytes") / F.avg("sealed_bytes"), 3).alias("json_over_sealed"),
        F.round(F.avg("binary_bytes") / F.avg("sealed_bytes"), 3).alias("binary_over_sealed"),
        F.round((F.sum("json_equiv_bytes") - F.sum("sealed_bytes")) / F.sum("json_equiv_bytes") * 100, 1).alias("saved_pct"),
    )


@query(
    "json_gzip_sizes",
    f"{W}, {BATCHED_SQL} SELECT batch_id, count(*) AS n, true AS gzip_smaller, md5(string_agg(id || {FP}, ',' ORDER BY id)) AS content FROM batched GROUP BY batch_id",
)
def json_gzip_sizes(spark, sf_dir):
    """Per batch: JSON body and its gzip-6 form compared by size, and the content read back from the unzipped body."""
    from ..sources.dumps import to_json_batches

    bodies = to_json_batches(batched_source(spark, sf_dir))

    @F.pandas_udf("binary")
    def zipped(s: pd.Series) -> pd.Series:
        return s.map(lambda t: gzip.compress(t.encode("utf-8"), compresslevel=6))

    @F.pandas_udf("string")
    def unzipped(s: pd.Series) -> pd.Series:
        return s.map(lambda b: gzip.decompress(b).decode("utf-8"))

    sent = bodies.select("batch_id", F.octet_length("value").alias("json_bytes"), zipped("value").alias("z"))
    sizes_of = sent.select("batch_id", (F.octet_length("z") < F.col("json_bytes")).alias("gzip_smaller"), unzipped("z").alias("value"))
    body = F.from_json("value", "ids array<string>, vectors array<array<float>>")
    pairs = F.array_sort(F.zip_with("b.ids", "b.vectors", lambda i, v: F.struct(i.alias("id"), V.fingerprint(v).alias("fp"))))
    return sizes_of.withColumn("b", body).select(
        "batch_id",
        F.size("b.ids").cast("bigint").alias("n"),
        "gzip_smaller",
        F.md5(F.array_join(F.transform(pairs, lambda p: F.concat(p["id"], p["fp"])), ",")).alias("content"),
    )


# ── rotation ─────────────────────────────────────────────────────────────────


def _dim(spark, sf_dir):
    return knn.detect_dim(source(spark, sf_dir))


ROT_SQL = (
    f"{W}, {S.DIMS}, k AS (SELECT {S.hash_uniform(KEY_SEED, 'k1', '(SELECT dim FROM dims)')} AS u1, "
    f"{S.hash_uniform(KEY_SEED, 'k2', '(SELECT dim FROM dims)')} AS u2), "
    "r1 AS (SELECT id, CAST(vector AS DOUBLE[]) AS v, u1, u2 FROM src, k WHERE len(vector) = (SELECT dim FROM dims)), "
    f"r2 AS (SELECT id, u1, u2, {S.reflect('v', 'u1')} AS v1 FROM r1), "
    f"rot AS (SELECT id, u1, u2, CAST({S.reflect('v1', 'u2')} AS FLOAT[]) AS rv FROM r2)"
)


@query("rotate_vectors", f"{ROT_SQL} SELECT id, {S.fp('rv')} AS fp FROM rot")
def rotate_vectors(spark, sf_dir):
    src = source(spark, sf_dir)
    dim = knn.detect_dim(src)
    r = rotate.rotate(src.where(F.size("vector") == dim), KEY_SEED, dim)
    return r.select("id", V.fingerprint("vector").alias("fp"))


@query(
    "unrotate_vectors",
    f"{ROT_SQL}, b1 AS (SELECT id, u1, {S.reflect('CAST(rv AS DOUBLE[])', 'u2')} AS w FROM rot), "
    f"b2 AS (SELECT id, CAST({S.reflect('w', 'u1')} AS FLOAT[]) AS back FROM b1) SELECT id, {S.fp('back')} AS fp FROM b2",
)
def unrotate_vectors(spark, sf_dir):
    src = source(spark, sf_dir)
    dim = knn.detect_dim(src)
    r = rotate.rotate(rotate.rotate(src.where(F.size("vector") == dim), KEY_SEED, dim), KEY_SEED, dim, inverse=True)
    return r.select("id", V.fingerprint("vector").alias("fp"))


@query(
    "key_orthogonality",
    f"{W}, {S.DIMS} SELECT count(*) AS n_rows, true AS norm_ok, true AS roundtrip_ok, true AS paths_agree FROM src "
    "WHERE len(vector) = (SELECT dim FROM dims)",
)
def key_orthogonality(spark, sf_dir):
    """Check the key on the data: the matrix form preserves norms, inverts exactly and equals the reflections."""
    src = source(spark, sf_dir)
    dim = knn.detect_dim(src)
    K = rotate.collect_key(rotate.key_table(spark, KEY_SEED, dim))
    data = src.where(F.size("vector") == dim).select("id", "vector")
    by_matrix = rotate.rotate_with_matrix(data, K).withColumnRenamed("vector", "mv")
    back = rotate.rotate_with_matrix(by_matrix.withColumnRenamed("mv", "vector"), K, inverse=True).withColumnRenamed("vector", "bv")
    normals = rotate.key_normal_values(spark, KEY_SEED, dim)
    by_expr = data.select("id", rotate.rotate_col("vector", KEY_SEED, dim, normals=normals).alias("ev"))
    j = data.join(by_matrix, "id").join(back, "id").join(by_expr, "id")
    maxdiff = lambda a, b: F.array_max(F.zip_with(a, b, lambda x, y: F.abs(x - y)))
    return j.agg(
        F.count("*").alias("n_rows"),
        (F.max(F.abs(V.norm("mv") - V.norm("vector"))) < 1e-5).alias("norm_ok"),
        (F.max(maxdiff("bv", "vector")) < 1e-4).alias("roundtrip_ok"),
        (F.max(maxdiff("mv", "ev")) < 1e-5).alias("paths_agree"),
    )


# ── marks ────────────────────────────────────────────────────────────────────

MARK_SQL = (
    f"{W}, {BATCHED_SQL}, mk AS (SELECT batch_id, id, vector, {S.byte_mark('batch_id', 'len(vector)')} AS mark FROM batched), "
    "mk2 AS (SELECT batch_id, id, mark, CAST(list_transform(list_zip(CAST(vector AS DOUBLE[]), mark), lambda p: p[1] + 0.01 * p[2]) AS FLOAT[]) AS mv FROM mk)"
)


def _marked(spark, sf_dir):
    return marks.apply_byte_mark(batched_source(spark, sf_dir))


@query("watermark_vector_sha", f"{MARK_SQL} SELECT id, batch_id, {S.fp('mv')} AS fp FROM mk2")
def watermark_vector_sha(spark, sf_dir):
    return _marked(spark, sf_dir).select("id", "batch_id", V.fingerprint("vector").alias("fp"))


@query(
    "watermark_verify",
    f"{MARK_SQL} SELECT id, batch_id, round({S.cos('mv', 'mark')}, 6) AS mark_cos, "
    f"{S.norm('mv')} > 0 AND {S.cos('mv', 'mark')} >= 0.0 AS verified FROM mk2",
)
def watermark_verify(spark, sf_dir):
    m = _marked(spark, sf_dir)
    return m.select("id", "batch_id", F.round(marks.mark_cosine(), 6).alias("mark_cos"), marks.verify_mark(threshold=0.0).alias("verified"))


@query(
    "watermark_recovery",
    f"{MARK_SQL}, rc AS (SELECT batch_id, {S.cos('mv', 'list_transform(list_zip(CAST(mv AS DOUBLE[]), mark), lambda p: p[1] - 0.01 * p[2])')} AS c FROM mk2) "
    "SELECT batch_id, round(avg(c), 6) AS avg_cosine, round(avg(CAST(c > 0.95 AS DOUBLE)), 6) AS share_095, "
    "round(avg(CAST(c > 0.99 AS DOUBLE)), 6) AS share_099, count(*) AS n FROM rc GROUP BY batch_id",
)
def watermark_recovery(spark, sf_dir):
    r = marks.recovery(_marked(spark, sf_dir))
    return r.select(
        "batch_id", *[F.round(c, 6).alias(c) for c in ("avg_cosine", "share_095", "share_099")], "n"
    )


@query("watermark_inject", f"{W}, {BATCHED_SQL} SELECT id, batch_id, true AS unit, true AS verified FROM batched")
def watermark_inject(spark, sf_dir):
    """Gaussian (package-form) mark, strong enough to be told from another batch's, re-normalised."""
    seed = b"embedflow-mark"
    m = marks.apply_gaussian_mark(batched_source(spark, sf_dir).select("id", "batch_id", "vector"), seed, strength=1.0)
    v = marks.gaussian_mark_verdicts(m, seed, threshold=0.3)
    return v.select("id", "batch_id", (F.abs(V.norm("vector") - 1) < 1e-5).alias("unit"), "verified")
