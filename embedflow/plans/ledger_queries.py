"""Job ledger, progress, usage and report queries.

The ledger is derived from ``embeddings``: every namespace is one
account's migration job, copied in batches of ``JOB_BATCH`` records in id
order.  Jobs whose label leaves 8 or 9 after division by ten are not marked
completed yet.
Times are epoch seconds from a fixed start so results are reproducible.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..operators import batching, frames, guards, progress
from ..session import scratch_path
from .common import source, table
from . import sqlkit as S
from .record_queries import W
from .registry import query
from .transport_queries import tampered

JOB_BATCH = 16
JOB_KEY = 10_000_000  # a frame's number is label * JOB_KEY + batch; frames of different jobs may share one
EPOCH0 = 1767225600  # 2026-01-01T00:00:00Z
# Plans and their dimension-weighted-vector limits (-1 = unlimited).
PLANS = [("free", 200_000_000), ("starter", 2_000_000_000), ("pro", 25_000_000_000), ("enterprise", -1)]
DEFAULT_DIM = 1536


def _label(df):
    return F.col("metadata")["label"].cast("int")


def ledger(spark, sf_dir) -> DataFrame:
    """job_id, license_key, label, batch_id, n, verified, raw_bytes, wire_bytes, last_id, updated_at_s (committed batches).

    Every batch is sealed, some frames are damaged on the way (see ``transport_queries.tampered``), and what
    the receiver decodes and verifies is counted.
    """
    src = source(spark, sf_dir)
    return booked(src.withColumn("label", _label(src).cast("bigint")))


def booked(src: DataFrame) -> DataFrame:
    """The ledger of records with their ``label``; a batch is known by its namespace and frame number."""
    b = batching.assign_batches(src, JOB_BATCH, order=["id"], group="namespace")
    first = F.coalesce("label", F.lit(0)) * JOB_KEY
    keyed = b.withColumn("batch_id", first + F.col("batch_id"))
    got = frames.receive(tampered(frames.seal_batches(keyed, job="namespace")))
    last = keyed.groupBy("namespace", F.col("batch_id").alias("frame_id")).agg(F.max("id").alias("last_id"), F.max("label").cast("int").alias("label"))
    done = got.join(last, F.col("job").eqNullSafe(F.col("namespace")) & (F.col("batch_id") == F.col("frame_id")))
    done = done.withColumn("batch_id", F.col("batch_id") - first)
    return done.select(
        F.concat(F.lit("job-"), "namespace").alias("job_id"),
        F.concat(F.lit("key-"), F.col("label").cast("string")).alias("license_key"),
        "label",
        "batch_id",
        F.col("received").alias("n"),
        "verified",
        (F.col("sent") * F.col("dim") * 4).cast("bigint").alias("raw_bytes"),
        "wire_bytes",
        "last_id",
        (F.lit(EPOCH0) + F.col("label") * 3600 + (F.col("batch_id") + 1) * 60).cast("bigint").alias("updated_at_s"),
    )


def accounts(spark, sf_dir) -> DataFrame:
    src = source(spark, sf_dir)
    labels = src.select(_label(src).alias("label")).distinct()
    plan_names = F.array(*[F.lit(p) for p, _ in PLANS])
    return labels.select(
        F.concat(F.lit("key-"), F.col("label").cast("string")).alias("license_key"),
        F.concat(F.lit("org-"), F.floor(F.col("label") / 2).cast("string")).alias("org"),
        F.element_at(plan_names, (F.col("label") % len(PLANS) + 1).cast("int")).alias("plan"),
        "label",
    )


def plans(spark) -> DataFrame:
    names, limits = zip(*PLANS)
    return spark.createDataFrame(pa.table({"plan": pa.array(names), "dwv_limit": pa.array(limits, pa.int64())}))  # no Python workers


def jobs(spark, sf_dir) -> DataFrame:
    """One job per account."""
    src = source(spark, sf_dir)
    per = src.groupBy(_label(src).alias("label"), "namespace").agg(F.max(F.size("vector")).alias("dim"))
    return per.select(
        F.concat(F.lit("job-"), "namespace").alias("job_id"),
        F.concat(F.lit("key-"), F.col("label").cast("string")).alias("license_key"),
        F.col("dim").cast("int").alias("dim"),
        (F.col("label") % 10 < 8).alias("completed"),
        (F.lit(EPOCH0) + F.col("label") * 3600).cast("bigint").alias("created_at_s"),
    )


def reports(spark, sf_dir) -> DataFrame:
    led = ledger(spark, sf_dir)
    acc = accounts(spark, sf_dir).select("license_key", "org")
    r = led.groupBy("job_id", "license_key").agg(
        F.sum("n").cast("bigint").alias("transferred"),
        F.sum("verified").cast("bigint").alias("verified"),
        F.sum("wire_bytes").cast("bigint").alias("wire_bytes"),
        F.sum("raw_bytes").cast("bigint").alias("raw_bytes"),
        F.max("updated_at_s").alias("completed_at_s"),
    )
    return r.join(acc, "license_key").withColumn("failed", F.col("transferred") - F.col("verified")).withColumn(
        "verification_rate_pct", F.when(F.col("transferred") > 0, F.round(F.col("verified") / F.col("transferred") * 100, 4)).otherwise(0.0)
    ).withColumn("raw_over_wire", F.when(F.col("wire_bytes") > 0, F.round(F.col("raw_bytes") / F.col("wire_bytes"), 2)).otherwise(0.0))


# ── SQL side ─────────────────────────────────────────────────────────────────

LEDGER_SQL = (
    f"{W}, jb AS (SELECT *, (row_number() OVER (PARTITION BY namespace ORDER BY id) - 1) // {JOB_BATCH} AS batch_id FROM src), "
    f"jk AS (SELECT id, vector, meta_label, namespace, label * {JOB_KEY} + batch_id AS batch_id FROM jb), {S.batch_digest_ctes('jk')}, "
    "ledger AS (SELECT 'job-' || namespace AS job_id, 'key-' || label AS license_key, label, jb.batch_id, count(*) AS n, "
    "CAST(CASE WHEN substr(max(digest), 1, 1) < '4' THEN 0 ELSE count(*) END AS BIGINT) AS verified, "
    "CAST(sum(4 * len(vector)) AS BIGINT) AS raw_bytes, "
    "CAST(52 + sum(4 * len(vector) + 8 + strlen(id) + strlen('{\"label\":\"' || meta_label || '\"}') + strlen(namespace)) AS BIGINT) AS wire_bytes, "
    f"max(id) AS last_id, CAST({EPOCH0} + label * 3600 + (jb.batch_id + 1) * 60 AS BIGINT) AS updated_at_s "
    f"FROM jb JOIN dg ON dg.batch_id = label * {JOB_KEY} + jb.batch_id GROUP BY namespace, label, jb.batch_id), "
    "accounts AS (SELECT DISTINCT 'key-' || label AS license_key, 'org-' || (label // 2) AS org, "
    "['free', 'starter', 'pro', 'enterprise'][label % 4 + 1] AS plan, label FROM src), "
    "plans AS (SELECT * FROM (VALUES ('free', 200000000), ('starter', 2000000000), ('pro', 25000000000), ('enterprise', -1)) t(plan, dwv_limit)), "
    "jobs AS (SELECT 'job-' || namespace AS job_id, 'key-' || label AS license_key, CAST(max(len(vector)) AS INTEGER) AS dim, "
    f"label % 10 < 8 AS completed, CAST({EPOCH0} + label * 3600 AS BIGINT) AS created_at_s FROM src GROUP BY namespace, label), "
    "reports AS (SELECT r.*, a.org, transferred - verified AS failed, CASE WHEN transferred > 0 THEN round(verified / transferred * 100, 4) ELSE 0.0 END "
    "AS verification_rate_pct, CASE WHEN wire_bytes > 0 THEN round(raw_bytes / wire_bytes, 2) ELSE 0.0 END AS raw_over_wire FROM "
    "(SELECT job_id, license_key, CAST(sum(n) AS BIGINT) AS transferred, CAST(sum(verified) AS BIGINT) AS verified, "
    "CAST(sum(wire_bytes) AS BIGINT) AS wire_bytes, CAST(sum(raw_bytes) AS BIGINT) AS raw_bytes, max(updated_at_s) AS completed_at_s "
    "FROM ledger GROUP BY job_id, license_key) r JOIN accounts a USING (license_key)), "
    "prog AS (SELECT job_id, batch_id, last_id, updated_at_s, "
    "CAST(sum(n) OVER (PARTITION BY job_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS vectors_transferred, "
    "count(*) OVER (PARTITION BY job_id ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS batches_completed FROM ledger), "
    "totals AS (SELECT 'job-' || namespace AS job_id, count(*) AS total FROM src GROUP BY namespace)"
)


def progress_rows(spark, sf_dir) -> DataFrame:
    led = ledger(spark, sf_dir).withColumn("one", F.lit(1).cast("bigint"))
    run = progress.running_sum(led, "job_id", "batch_id", ["n", "one"])
    return run.select(
        "job_id",
        "batch_id",
        F.col("cum_n").cast("bigint").alias("vectors_transferred"),
        F.col("cum_one").cast("bigint").alias("batches_completed"),
        F.col("cum_n").cast("bigint").alias("last_offset"),
        "last_id",
        "updated_at_s",
    )


def totals(spark, sf_dir) -> DataFrame:
    src = source(spark, sf_dir)
    return src.groupBy(F.concat(F.lit("job-"), "namespace").alias("job_id")).agg(F.count("*").alias("total"))


@query(
    "checkpoint_progress",
    f"{LEDGER_SQL} SELECT job_id, batch_id, vectors_transferred, batches_completed, vectors_transferred AS last_offset, last_id, updated_at_s FROM prog",
)
def checkpoint_progress(spark, sf_dir):
    return progress_rows(spark, sf_dir)


@query(
    "migration_progress",
    f"{LEDGER_SQL} SELECT p.job_id, p.batch_id, p.vectors_transferred AS done, t.total, "
    "round(p.vectors_transferred / t.total * 100, 2) AS pct_done FROM prog p JOIN totals t USING (job_id)",
)
def migration_progress(spark, sf_dir):
    p = progress_rows(spark, sf_dir).join(totals(spark, sf_dir), "job_id")
    return p.select(
        "job_id", "batch_id", F.col("vectors_transferred").alias("done"), "total", F.round(F.col("vectors_transferred") / F.col("total") * 100, 2).alias("pct_done")
    )


@query(
    "job_status",
    f"{LEDGER_SQL} SELECT p.job_id, arg_max(vectors_transferred, updated_at_s) AS vectors_transferred, "
    "arg_max(batches_completed, updated_at_s) AS batches_completed, arg_max(vectors_transferred, updated_at_s) AS last_offset, "
    "arg_max(last_id, updated_at_s) AS last_id, arg_max(vectors_transferred, updated_at_s) = max(t.total) AS completed, "
    "max(updated_at_s) AS updated_at_s FROM prog p JOIN totals t USING (job_id) GROUP BY p.job_id",
)
def job_status(spark, sf_dir):
    last = progress.latest(progress_rows(spark, sf_dir), "job_id", ["updated_at_s"])
    return last.join(totals(spark, sf_dir), "job_id").select(
        "job_id",
        "vectors_transferred",
        "batches_completed",
        "last_offset",
        "last_id",
        (F.col("vectors_transferred") == F.col("total")).alias("completed"),
        "updated_at_s",
    )


@query(
    "latest_report",
    f"{LEDGER_SQL} SELECT org, arg_max(job_id, completed_at_s) AS job_id, max(completed_at_s) AS completed_at_s FROM reports GROUP BY org",
)
def latest_report(spark, sf_dir):
    r = reports(spark, sf_dir).select("org", "job_id", "completed_at_s")
    return progress.latest(r, "org", ["completed_at_s"]).select("org", "job_id", "completed_at_s")


@query(
    "pending_jobs",
    f"{LEDGER_SQL} SELECT license_key, arg_max(job_id, created_at_s) AS job_id, max(created_at_s) AS created_at_s "
    "FROM jobs WHERE NOT completed GROUP BY license_key",
)
def pending_jobs(spark, sf_dir):
    j = jobs(spark, sf_dir).where(~F.col("completed")).select("license_key", "job_id", "created_at_s")
    return progress.latest(j, "license_key", ["created_at_s"])


def _usage(spark, sf_dir) -> DataFrame:
    r = reports(spark, sf_dir).select("job_id", "license_key", "org", "transferred")
    j = jobs(spark, sf_dir).select("job_id", "dim")
    a = accounts(spark, sf_dir).select("license_key", "plan")
    return (
        r.join(j, "job_id", "left")
        .join(a, "license_key")
        .join(F.broadcast(plans(spark)), "plan")  # four rows
        .select(
            "job_id",
            "license_key",
            "org",
            "plan",
            F.coalesce("dim", F.lit(DEFAULT_DIM)).alias("dim"),
            (F.col("transferred") * F.coalesce("dim", F.lit(DEFAULT_DIM))).cast("bigint").alias("dwv"),
            "dwv_limit",
        )
    )


USAGE_SQL = (
    f"{LEDGER_SQL}, usage AS (SELECT r.job_id, r.license_key, r.org, a.plan, coalesce(j.dim, {DEFAULT_DIM}) AS dim, "
    f"CAST(r.transferred * coalesce(j.dim, {DEFAULT_DIM}) AS BIGINT) AS dwv, CAST(p.dwv_limit AS BIGINT) AS dwv_limit "
    "FROM reports r LEFT JOIN jobs j USING (job_id) JOIN accounts a ON r.license_key = a.license_key JOIN plans p ON a.plan = p.plan)"
)


@query("usage_by_plan", f"{USAGE_SQL} SELECT job_id, license_key, org, plan, CAST(dim AS INTEGER) AS dim, dwv, dwv_limit FROM usage")
def usage_by_plan(spark, sf_dir):
    return _usage(spark, sf_dir).withColumn("dim", F.col("dim").cast("int"))


@query(
    "usage_rollup",
    f"{USAGE_SQL}, u AS (SELECT license_key, CAST(sum(dwv) AS BIGINT) AS dwv_used FROM usage GROUP BY license_key) "
    "SELECT a.license_key, a.plan, coalesce(u.dwv_used, 0) AS dwv_used, CAST(p.dwv_limit AS BIGINT) AS dwv_limit, "
    "CASE WHEN p.dwv_limit > 0 THEN round(coalesce(u.dwv_used, 0) / p.dwv_limit * 100, 2) ELSE 0.0 END AS usage_pct, "
    "(SELECT count(*) FROM reports r WHERE r.org = a.org) AS reports_count, "
    "(SELECT count(*) FROM jobs j WHERE j.license_key = a.license_key) AS jobs_count "
    "FROM accounts a JOIN plans p USING (plan) LEFT JOIN u USING (license_key)",
)
def usage_rollup(spark, sf_dir):
    used = _usage(spark, sf_dir).groupBy("license_key").agg(F.sum("dwv").cast("bigint").alias("dwv_used"))
    acc = accounts(spark, sf_dir)
    rep = reports(spark, sf_dir).groupBy("org").agg(F.count("*").alias("reports_count"))
    jc = jobs(spark, sf_dir).groupBy("license_key").agg(F.count("*").alias("jobs_count"))
    u = F.coalesce("dwv_used", F.lit(0)).cast("bigint")
    return (
        acc.join(F.broadcast(plans(spark)), "plan")
        .join(used, "license_key", "left")
        .join(rep, "org", "left")
        .join(jc, "license_key", "left")
        .select(
            "license_key",
            "plan",
            u.alias("dwv_used"),
            "dwv_limit",
            F.when(F.col("dwv_limit") > 0, F.round(u / F.col("dwv_limit") * 100, 2)).otherwise(0.0).alias("usage_pct"),
            F.coalesce("reports_count", F.lit(0)).alias("reports_count"),
            F.coalesce("jobs_count", F.lit(0)).alias("jobs_count"),
        )
    )


@query("reports_by_org", f"{LEDGER_SQL} SELECT a.license_key, r.job_id FROM accounts a JOIN reports r ON a.org = r.org")
def reports_by_org(spark, sf_dir):
    acc = accounts(spark, sf_dir).select("license_key", "org")
    return acc.join(reports(spark, sf_dir).select("org", "job_id"), "org").select("license_key", "job_id")


@query(
    "region_summary",
    f"{LEDGER_SQL} SELECT CASE WHEN label < 5 THEN 'east' ELSE 'west' END AS region, count(*) AS batches, "
    "round(avg(wire_bytes), 2) AS avg_wire_bytes, round(avg(raw_bytes), 2) AS avg_raw_bytes, "
    "printf('%d/%d', count(*) FILTER (WHERE verified = n), count(*)) AS verified FROM ledger GROUP BY 1",
)
def region_summary(spark, sf_dir):
    led = ledger(spark, sf_dir).withColumn("region", F.when(F.col("label") < 5, "east").otherwise("west"))
    g = led.groupBy("region").agg(
        F.count("*").alias("batches"),
        F.round(F.avg("wire_bytes"), 2).alias("avg_wire_bytes"),
        F.round(F.avg("raw_bytes"), 2).alias("avg_raw_bytes"),
        F.count_if(F.col("verified") == F.col("n")).alias("n_verified"),
    )
    return g.select("region", "batches", "avg_wire_bytes", "avg_raw_bytes", F.format_string("%d/%d", "n_verified", "batches").alias("verified"))


@query(
    "write_report",
    f"{LEDGER_SQL} SELECT job_id, transferred, verified, failed, verification_rate_pct, raw_over_wire FROM reports",
)
def write_report(spark, sf_dir):
    """Reports as JSON lines in the shared folder, read back with an explicit schema."""
    path = scratch_path(spark, "reports")
    r = reports(spark, sf_dir)
    r.select(F.to_json(F.struct(*r.columns)).alias("value")).write.mode("errorifexists").text(path)
    schema = "job_id string, transferred bigint, verified bigint, failed bigint, verification_rate_pct double, raw_over_wire double"
    back = spark.read.text(path).select(F.from_json("value", schema).alias("r")).select("r.*")
    return back.select("job_id", "transferred", "verified", "failed", "verification_rate_pct", "raw_over_wire")


FIELDS = [
    ("transferred", "%d"),
    ("verified", "%d"),
    ("failed", "%d"),
    ("wire_bytes", "%d"),
    ("raw_bytes", "%d"),
    ("verification_rate_pct", "%.4f"),
    ("raw_over_wire", "%.2f"),
]


@query(
    "report_fields",
    f"{LEDGER_SQL} "
    + " UNION ALL ".join(f"SELECT job_id, '{f}' AS field, printf('{fmt}', {f}) AS value FROM reports" for f, fmt in FIELDS),
)
def report_fields(spark, sf_dir):
    r = reports(spark, sf_dir)
    stacked = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.format_string(fmt, f).alias("value")) for f, fmt in FIELDS]))
    return r.select("job_id", stacked.alias("kv")).select("job_id", "kv.field", "kv.value")


# ── counts, latency, throughput, order ───────────────────────────────────────


@query("count_vectors", f"{W} SELECT count(*) AS n_vectors, count(DISTINCT id) AS n_ids FROM src")
def count_vectors(spark, sf_dir):
    return source(spark, sf_dir).agg(F.count("*").alias("n_vectors"), F.count_distinct("id").alias("n_ids"))


@query(
    "count_by_namespace",
    f"{W}, moved AS (SELECT CASE WHEN namespace IN ('ns3', 'ns4') THEN 'archive' ELSE namespace END AS namespace FROM src), "
    "names AS (SELECT DISTINCT namespace FROM src UNION SELECT 'archive') "
    "SELECT n.namespace, count(m.namespace) AS n FROM names n LEFT JOIN moved m USING (namespace) GROUP BY n.namespace",
)
def count_by_namespace(spark, sf_dir):
    src = source(spark, sf_dir)
    moved = src.withColumn("namespace", F.when(F.col("namespace").isin("ns3", "ns4"), F.lit("archive")).otherwise(F.col("namespace")))
    names = src.select("namespace").union(spark.createDataFrame([("archive",)], "namespace string")).distinct()
    counts = moved.groupBy("namespace").agg(F.count("*").alias("n"))
    return names.join(counts, "namespace", "left").select("namespace", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "latency_percentiles",
    "WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) - 1 AS k, "
    "count(*) OVER (PARTITION BY event_type) AS n FROM events) "
    "SELECT event_type, n, round(max(value) FILTER (WHERE k = least(floor(n * 50 / 100.0), n - 1)), 2) AS p50, "
    "round(max(value) FILTER (WHERE k = least(floor(n * 95 / 100.0), n - 1)), 2) AS p95, "
    "round(max(value) FILTER (WHERE k = least(floor(n * 99 / 100.0), n - 1)), 2) AS p99, round(avg(value), 2) AS avg "
    "FROM r GROUP BY event_type, n",
)
def latency_percentiles(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    p = progress.nearest_rank(ev.select("event_type", "value", "event_id"), "event_type", "value", [50, 95, 99], tie="event_id")
    a = ev.groupBy("event_type").agg(F.round(F.avg("value"), 2).alias("avg"))
    return p.join(a, "event_type").select(
        "event_type", "n", F.round("p50", 2).alias("p50"), F.round("p95", 2).alias("p95"), F.round("p99", 2).alias("p99"), "avg"
    )


@query(
    "throughput",
    "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total_ms, "
    "CASE WHEN sum(value) > 0 THEN round(count(*) / (sum(value) / 1000), 1) ELSE 0.0 END AS per_second FROM events GROUP BY event_type",
)
def throughput(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.groupBy("event_type").agg(
        F.count("*").alias("n"),
        F.round(F.sum("value"), 2).alias("total_ms"),
        F.when(F.sum("value") > 0, F.round(F.count("*") / (F.sum("value") / 1000), 1)).otherwise(0.0).alias("per_second"),
    )


@query("order_changes", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS position FROM events")
def order_changes(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return batching.number_rows(ev.select("event_id", "ts"), ["ts", "event_id"]).select("event_id", F.col("rn").alias("position"))


# ── metric guard over a per-namespace catalog ────────────────────────────────

# Metric names declared per namespace (index = label) on the source and target side.
SOURCE_METRICS = ["cosine", "COS", "dot_product", "ip", "l2", "Euclidean", "euclid", "dot", "cosine", "manhattan"]
TARGET_METRICS = ["cos", "cosine", "dot", "dot", "euclidean", "l2", "cosine", "l2", "dot", "manhattan"]
OVERRIDE_LABELS = [7]


def _catalog(spark, sf_dir):
    src = source(spark, sf_dir)
    per = src.groupBy("namespace", _label(src).alias("label")).agg(F.count("*").alias("n_vectors"))
    sm, tm = F.array(*[F.lit(m) for m in SOURCE_METRICS]), F.array(*[F.lit(m) for m in TARGET_METRICS])
    idx = (F.col("label") % len(SOURCE_METRICS) + 1).cast("int")
    return per.select(
        "namespace",
        "n_vectors",
        F.element_at(sm, idx).alias("source_metric"),
        F.element_at(tm, idx).alias("target_metric"),
        F.col("label").isin(OVERRIDE_LABELS).alias("override"),
    )


_ALIAS_SQL = "CASE lower({m}) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in V.METRIC_ALIASES.items()) + " ELSE lower({m}) END"
CATALOG_SQL = (
    f"{W}, cat AS (SELECT namespace, count(*) AS n_vectors, "
    f"[{', '.join(repr(m) for m in SOURCE_METRICS)}][label % {len(SOURCE_METRICS)} + 1] AS source_metric, "
    f"[{', '.join(repr(m) for m in TARGET_METRICS)}][label % {len(SOURCE_METRICS)} + 1] AS target_metric, label IN ({', '.join(map(str, OVERRIDE_LABELS))}) AS override "
    "FROM src GROUP BY namespace, label)"
)


@query(
    "metric_normalise",
    f"{CATALOG_SQL} SELECT namespace, source_metric AS raw, {_ALIAS_SQL.format(m='source_metric')} AS metric FROM cat",
)
def metric_normalise(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return c.select("namespace", F.col("source_metric").alias("raw"), V.metric_normalise_col("source_metric").alias("metric"))


@query(
    "metric_guard",
    f"{CATALOG_SQL} SELECT namespace, n_vectors, {_ALIAS_SQL.format(m='source_metric')} AS source_metric, "
    f"{_ALIAS_SQL.format(m='target_metric')} AS target_metric, CASE WHEN {_ALIAS_SQL.format(m='source_metric')} = "
    f"{_ALIAS_SQL.format(m='target_metric')} THEN 'ok' WHEN override THEN 'override' ELSE 'mismatch' END AS verdict FROM cat",
)
def metric_guard(spark, sf_dir):
    c = _catalog(spark, sf_dir)
    return c.select(
        "namespace",
        "n_vectors",
        V.metric_normalise_col("source_metric").alias("source_metric"),
        V.metric_normalise_col("target_metric").alias("target_metric"),
        guards.metric_verdict("source_metric", "target_metric", "override").alias("verdict"),
    )
