"""End-to-end job, target creation and generator queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import batching, knn, upsert
from ..session import scratch_path
from ..sources import generators
from .common import BATCH_SIZE, source, table
from .migrate import JobSpec, migrate
from .record_queries import CANON_SQL, W, canon_out
from .registry import query


@query("migrate_full", f"{W} SELECT {CANON_SQL} FROM src")
def migrate_full(spark, sf_dir):
    """Copy the whole table (batches by id hash: no data shuffle); return the target as re-read."""
    res = migrate(source(spark, sf_dir), scratch_path(spark, "migrate"), JobSpec(job_id="embeddings", semantic_verify=False, batch_size=BATCH_SIZE))
    return canon_out(res.target())


@query(
    "migrate_report",
    f"{W} SELECT 'embeddings' AS job_id, count(*) AS total_vectors, count(*) AS transferred, count(*) AS verified, "
    f"CAST(0 AS BIGINT) AS failed, CAST(ceil(count(*) / {BATCH_SIZE}) AS BIGINT) AS batches, CAST(100.0 AS DOUBLE) AS verification_rate_pct, "
    "CAST(100.0 AS DOUBLE) AS avg_overlap_pct, true AS passed FROM src",
)
def migrate_report(spark, sf_dir):
    """Integrity and semantic report of a migration that is run twice (the second run resumes: nothing left)."""
    root = scratch_path(spark, "migrate")
    src = source(spark, sf_dir)
    res = migrate(src, root, JobSpec(job_id="embeddings", batch_size=BATCH_SIZE, ordered_batches=True))
    again = migrate(src, root, JobSpec(job_id="embeddings", batch_size=BATCH_SIZE, semantic_verify=False))
    extra = again.batch_stats.agg(F.coalesce(F.sum("received"), F.lit(0)).alias("x")).first()["x"]
    if extra:
        raise AssertionError(f"resume copied {extra} rows twice")
    sem = res.semantic.first()  # the one-row semantic summary
    return res.integrity.withColumn("avg_overlap_pct", F.lit(sem["avg_overlap_pct"])).withColumn("passed", F.lit(sem["passed"])).select(
        "job_id", "total_vectors", "transferred", "verified", "failed", "batches", "verification_rate_pct", "avg_overlap_pct", "passed"
    )


@query(
    "migrate_resume",
    f"{W}, b AS (SELECT label >= 5 AS late, (row_number() OVER (PARTITION BY label >= 5 ORDER BY id) - 1) // {BATCH_SIZE} AS b FROM src) "
    "SELECT 'embeddings' AS job_id, count(*) AS total_vectors, count(*) AS transferred, count(*) AS verified, CAST(0 AS BIGINT) AS failed, "
    "count(DISTINCT (late, b)) AS batches FROM b",
)
def migrate_resume(spark, sf_dir):
    """A job in two runs, the second of which finds the first one's rows; the report covers both."""
    root, src = scratch_path(spark, "migrate"), source(spark, sf_dir)
    spec = JobSpec(job_id="embeddings", batch_size=BATCH_SIZE, semantic_verify=False, ordered_batches=True)
    migrate(src.where(F.col("metadata")["label"].cast("int") < 5), root, spec)
    return migrate(src, root, spec).cumulative.select("job_id", "total_vectors", "transferred", "verified", "failed", "batches")


@query("ensure_target", f"{W} SELECT count(*) AS n_rows, CAST(mode(len(vector)) AS VARCHAR) AS dim, 'cosine' AS metric FROM src")
def ensure_target(spark, sf_dir):
    src = source(spark, sf_dir)
    dim = knn.detect_dim(src)
    name = f"embedflow_target_{uuid.uuid4().hex[:10]}"
    props = upsert.ensure_target(spark, name, scratch_path(spark, "table"), dim, "COS")
    src.select("id", "vector", "metadata", "namespace").write.insertInto(name)
    upsert.ensure_target(spark, name, "unused", dim, "cosine")  # exists: properties are checked, not recreated
    rows = spark.table(name).agg(F.count("*").alias("n_rows")).first()["n_rows"]
    spark.sql(f"DROP TABLE {name}")  # external: its files stay in the scratch folder
    return spark.range(1).select(F.lit(rows).alias("n_rows"), F.lit(props["vector.dim"]).alias("dim"), F.lit(props["vector.metric"]).alias("metric"))


CLUSTER_SQL = (
    "CAST(('0x' || substr(sha256('42:' || vec_id), 1, 8))::BIGINT % 20 AS INTEGER)"
)


@query(
    "gen_clustered_vectors",
    "SELECT printf('doc_%07d', vec_id) AS id, "
    f"[{', '.join(repr(a) for a in generators.PRACTICE_AREAS)}][{CLUSTER_SQL} + 1] AS practice_area, "
    f"[{', '.join(repr(a) for a in generators.DOC_TYPES)}][vec_id % 7 + 1] AS doc_type, CAST(vec_id % 20 AS INTEGER) AS chunk_index, "
    "printf('firm_%03d', (vec_id // 1000) % 50) AS firm_id, CAST(2018 + vec_id % 7 AS INTEGER) AS year, "
    f"{CLUSTER_SQL} AS cluster, CAST(len(embedding) AS INTEGER) AS dim, true AS unit FROM embeddings",
)
def gen_clustered_vectors(spark, sf_dir):
    """A synthetic corpus shaped like ``embeddings``: one chunk per row, same dimension."""
    e = table(spark, sf_dir, "embeddings")
    dim = knn.detect_dim(e.select(F.col("embedding").alias("vector")))
    g = generators.gen_clustered_vectors(e.select(F.col("vec_id").alias("i")), dim)
    return g.select(
        "id", "practice_area", "doc_type", "chunk_index", "firm_id", "year", "cluster",
        F.size("vector").alias("dim"), (F.abs(V.norm("vector") - 1) < 1e-5).alias("unit"),
    )


@query(
    "gen_unit_batches",
    f"WITH b AS (SELECT (row_number() OVER (ORDER BY CAST(vec_id AS VARCHAR)) - 1) AS rn, len(embedding) AS d FROM embeddings) "
    f"SELECT printf('vec_%04d_%06d', rn // {BATCH_SIZE}, rn % {BATCH_SIZE}) AS id, rn // {BATCH_SIZE} AS batch_id, "
    f"rn % {BATCH_SIZE} AS pos, CAST(d AS INTEGER) AS dim, true AS unit FROM b",
)
def gen_unit_batches(spark, sf_dir):
    """Seeded unit batches, one generated vector per row of ``embeddings`` (batch = its batch)."""
    src = source(spark, sf_dir)
    dim = knn.detect_dim(src)
    b = batching.assign_batches(src.select("id"), BATCH_SIZE)
    g = generators.gen_unit_batches(b, dim, BATCH_SIZE)
    return g.select("id", "batch_id", "pos", F.size("vector").alias("dim"), (F.abs(V.norm("vector") - 1) < 1e-5).alias("unit"))
