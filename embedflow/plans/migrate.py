"""End-to-end migration job (X1, X2): guard → resume → write → verify → commit → report.

    result = migrate(source_df, "/shared/targets/docs", JobSpec(job_id="docs"))

Target layout under ``target_root``:
    data/run=<n>/   canonical rows + ``batch_id`` and ``row_digest`` lineage, one folder per run
    _expected/run=<n>/  per batch: the rows and digest sums of the source
    _batches/       append-only batch statistics (the job ledger); a run counts once it is here

Modes: ``full`` copies what the target doesn't hold yet (``resume``) or everything again; ``incremental``
copies new ids and those whose row digest differs.  A later run's row takes the place of an earlier one's
with the same id (``read_target``), so a copy is an upsert; runs that never committed aren't read.  A null
id is an id like any other, and rows that share one are copied and replaced together.

Batches are known from the rows themselves: by a hash of the id (no data shuffle; a retried or re-planned
task finds the same ones), or by global id order.  Each row's digest, over vector bits, id, metadata and
namespace, is computed as it is written.  The source's side of the proof is made from the source: one pass
over it adds up, per batch, the rows and the keyed digests of what is to be copied.  Verification re-reads
the target once, digests what it finds and compares the sums, so a row that is lost, repeated or altered on
the way fails its batch, whatever else is right; a batch that is missing has failed.  All rows of a repeated
id are one hash batch; sums are added up in every task, so no task holds a batch's rows.
"""

from __future__ import annotations

import json
import operator
import os
from collections.abc import Callable
from dataclasses import asdict, dataclass, fields
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.digest import DIGEST_SEED, with_row_digests
from ..operators import batching, frames, guards, knn
from ..schema import CANONICAL

DATA = "data"
EXPECTED = "_expected"
BATCHES = "_batches"
STORED = T.StructType(
    [T.StructField(f.name, f.dataType) for f in CANONICAL.fields]
    + [T.StructField("batch_id", T.StringType()), T.StructField("row_digest", T.StringType())]
)
STATS = (
    "job_id string, run bigint, batch_id string, sent bigint, received bigint, verified bigint, failed bigint, "
    "wire_bytes bigint, raw_bytes bigint, last_id string"
)


@dataclass
class JobSpec:
    """Job settings with the reference's defaults."""

    job_id: str = "job"
    mode: str = "full"  # or "incremental"
    batch_size: int = 256
    resume: bool = True
    metric_override: bool = False
    semantic_verify: bool = True
    semantic_probes: int = 100
    semantic_top_k: int = 5
    source_metric: str = "cosine"
    target_metric: str = "cosine"
    source_dim: int = 0
    target_dim: int = 0
    seed: str = DIGEST_SEED
    ordered_batches: bool = False  # True: batches in global id order (one extra data shuffle); False: by id hash

    @classmethod
    def from_dict(cls, d: dict) -> "JobSpec":
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in d.items() if k in known})

    @classmethod
    def from_json(cls, text_or_path: str) -> "JobSpec":
        if os.path.exists(text_or_path):
            with open(text_or_path) as f:
                return cls.from_dict(json.load(f))
        return cls.from_dict(json.loads(text_or_path))

    def to_dict(self) -> dict:
        return asdict(self)


@dataclass
class MigrationResult:
    """What a run did: its batches and their roll-up, and the roll-up of all the job's runs."""

    target_root: str
    batch_stats: DataFrame
    integrity: DataFrame
    cumulative: DataFrame
    probe_scores: DataFrame | None = None
    semantic: DataFrame | None = None

    def target(self) -> DataFrame:
        return read_target(self.batch_stats.sparkSession, self.target_root)


def _read(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The table at ``path``; None if there is none (any other error is raised)."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _runs(spark: SparkSession, target_root: str) -> list[int]:
    """Numbers of the committed runs."""
    stats = _read(spark, os.path.join(target_root, BATCHES), STATS)
    return [] if stats is None else sorted(r["run"] for r in stats.select("run").distinct().collect())


def _stored(spark: SparkSession, target_root: str, runs: list[int]) -> DataFrame:
    """Rows of the given runs with their run number."""
    parts = [spark.read.schema(STORED).parquet(os.path.join(target_root, DATA, f"run={n}")).withColumn("run", F.lit(n).cast("bigint")) for n in runs]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _current(stored: DataFrame, runs: list[int]) -> DataFrame:
    """The rows that no later run replaces; only ids and run numbers are aggregated."""
    if len(runs) < 2:
        return stored
    last = stored.groupBy(F.col("id").alias("last_id")).agg(F.max("run").alias("last_run"))
    return stored.join(last, F.col("id").eqNullSafe(F.col("last_id")) & (F.col("run") == F.col("last_run")), "left_semi")


def read_target(spark: SparkSession, target_root: str) -> DataFrame:
    """The target table: committed runs, each id as its last run wrote it (with lineage columns)."""
    runs = _runs(spark, target_root)
    if not runs:
        return spark.createDataFrame([], STORED)
    return _current(_stored(spark, target_root, runs), runs).select(*STORED.fieldNames())


def rollup(stats: DataFrame, total: int) -> DataFrame:
    """One row per job over batch statistics."""
    t = F.sum("received")
    return stats.groupBy("job_id").agg(
        F.lit(total).cast("bigint").alias("total_vectors"),
        t.cast("bigint").alias("transferred"),
        F.sum("verified").cast("bigint").alias("verified"),
        F.sum("failed").cast("bigint").alias("failed"),
        F.count_if(F.col("sent") > 0).alias("batches"),
        F.sum("wire_bytes").cast("bigint").alias("wire_bytes"),
        F.sum("raw_bytes").cast("bigint").alias("raw_bytes"),
        F.when(t > 0, F.round(F.sum("verified") / t * 100, 4)).otherwise(F.lit(0.0)).alias("verification_rate_pct"),
        F.when(F.sum("wire_bytes") > 0, F.round(F.sum("raw_bytes") / F.sum("wire_bytes"), 2)).otherwise(F.lit(0.0)).alias("raw_over_wire"),
    )


def _digest_sums(digest: str, seed: str, name: str) -> list[Column]:
    """Sums of the four 64-bit parts of keyed row digests: equal for the same rows in any order, and added up in
    every task, so a batch may have any number of rows."""
    keyed = F.sha2(F.concat_ws(":", F.lit(seed), F.col("batch_id"), F.col(digest)), 256)
    parts = [F.conv(F.substring(keyed, 16 * i + 1, 16), 16, 10).cast("decimal(20,0)") for i in range(4)]
    return [F.sum(F.when(F.col(digest).isNotNull(), p)).alias(f"{name}{i}") for i, p in enumerate(parts)]


def source_batches(batched: DataFrame, seed: str = DIGEST_SEED) -> DataFrame:
    """``batch_id, sent, src0..src3`` of source rows with a ``batch_id``: what the target must prove to hold."""
    digested = with_row_digests(batched, ["batch_id"], out="rd")
    return digested.groupBy("batch_id").agg(F.count("*").alias("sent"), *_digest_sums("rd", seed, "src"))


def verify_run(spark: SparkSession, target_root: str, run: int, expected: DataFrame, spec: JobSpec) -> DataFrame:
    """Statistics of every batch of ``expected`` (:func:`source_batches`) from one re-read of the run's folder.

    An ``expected`` that has counts alone is compared with the digests that were stored with the rows: that
    proves no more than that the rows that are there are as they were written.
    """
    stored = [] if "src0" in expected.columns else _digest_sums("row_digest", spec.seed, "src")
    target = _stored(spark, target_root, [run])
    rows = target.withColumns({"d": F.size("vector"), "record_bytes": frames.sealed_record_bytes()})
    now = with_row_digests(rows, ["batch_id", "id", "d", "record_bytes", "row_digest"], out="rd_now")
    got = now.groupBy("batch_id").agg(
        F.count("*").alias("received"),
        *stored,
        *_digest_sums("rd_now", spec.seed, "tgt"),
        (4 * F.sum("d")).cast("bigint").alias("raw_bytes"),
        (F.lit(frames.SEALED_HEADER) + F.sum("record_bytes")).cast("bigint").alias("wire_bytes"),
        F.max("id").alias("last_id"),
    )
    sent, received = F.coalesce("sent", F.lit(0)), F.coalesce("received", F.lit(0))
    same = [F.col(f"src{i}") == F.col(f"tgt{i}") for i in range(4)]
    ok = F.coalesce(reduce(operator.and_, same, sent == received), F.lit(False))
    return expected.join(got, "batch_id", "full_outer").select(
        F.lit(spec.job_id).alias("job_id"),
        F.lit(run).cast("bigint").alias("run"),
        "batch_id",
        sent.cast("bigint").alias("sent"),
        received.cast("bigint").alias("received"),
        F.when(ok, received).otherwise(F.lit(0)).cast("bigint").alias("verified"),
        F.when(ok, F.lit(0)).otherwise(F.greatest(sent, received)).cast("bigint").alias("failed"),
        F.coalesce("wire_bytes", F.lit(0)).cast("bigint").alias("wire_bytes"),
        F.coalesce("raw_bytes", F.lit(0)).cast("bigint").alias("raw_bytes"),
        "last_id",
    )


def migrate(
    source: DataFrame,
    target_root: str,
    spec: JobSpec | None = None,
    on_progress: Callable[[dict], None] | None = None,
    on_batch: Callable[[DataFrame], None] | None = None,
) -> MigrationResult:
    """Copy ``source`` into ``target_root``; see the module docstring.

    ``on_progress(metrics)`` is called once the write commits, with counters
    observed while writing (no extra pass); ``on_batch(batch_stats)`` with
    the verified per-batch statistics.  Vectors of another length than the
    first one's, or than the declared dimensions, raise before the run
    commits; an empty vector counts as having none.
    """
    spec = spec or JobSpec()
    spark = source.sparkSession
    if spec.mode not in ("full", "incremental"):
        raise ValueError(f"unknown mode {spec.mode!r}; streaming.sync has the live one")
    guards.validate_metrics(spec.source_metric, spec.target_metric, spec.metric_override)
    guards.validate_dimensions(spec.source_dim, spec.target_dim)
    dim = knn.first_dim(source)
    for declared in (spec.source_dim, spec.target_dim):
        guards.validate_dimensions(declared or dim, dim)

    runs = _runs(spark, target_root)
    run = (runs[-1] if runs else 0) + 1
    todo = source.select("id", "vector", "metadata", "namespace")
    if runs and (spec.mode == "incremental" or spec.resume):
        have = _current(_stored(spark, target_root, runs), runs)
        known = have.select(F.col("id").alias("known_id"), F.col("row_digest").alias("known_rd"))
        same_id = F.col("id").eqNullSafe(F.col("known_id"))
        if spec.mode == "incremental":  # all rows of an id that has new ones: the run takes the place of its old ones
            new = with_row_digests(todo, todo.columns).join(known, same_id & (F.col("rd") == F.col("known_rd")), "left_anti")
            new_ids = new.select(F.col("id").alias("known_id")).distinct()
            todo = todo.join(new_ids, same_id, "left_semi")
        else:
            todo = todo.join(known, same_id, "left_anti")  # J5: what is still to copy

    if spec.ordered_batches:
        numbering: dict = {}
        batched = batching.assign_batches(todo, spec.batch_size, stats=numbering)
        n_todo = int(numbering["rows"])
    else:
        n_todo = todo.count()
        batched = batching.hash_batches(todo, max(1, -(-n_todo // spec.batch_size)))
    batched = batched.withColumn("batch_id", F.concat_ws("-", F.lit(str(run)), F.col("batch_id").cast("string")))
    expected = source_batches(batched, spec.seed)  # a row per batch, kept beside the run: it is read again below
    expected.write.mode("overwrite").parquet(os.path.join(target_root, EXPECTED, f"run={run}"))
    expected = spark.read.schema(expected.schema).parquet(os.path.join(target_root, EXPECTED, f"run={run}"))
    rows = with_row_digests(batched, ["id", "vector", "metadata", "namespace", "batch_id"], out="row_digest")
    obs = Observation(f"migrate-{spec.job_id}-{run}")
    d = F.nullif(F.size("vector"), F.lit(0))
    rows = rows.observe(
        obs,
        F.count(F.lit(1)).alias("rows_written"),
        F.coalesce(F.sum(4 * F.size("vector")), F.lit(0)).cast("bigint").alias("raw_bytes"),
        F.min(d).alias("min_dim"),
        F.max(d).alias("max_dim"),
    )
    rows.write.mode("overwrite").parquet(os.path.join(target_root, DATA, f"run={run}"))  # what a crashed run left goes
    seen = obs.get
    for found in (seen["min_dim"], seen["max_dim"]):
        guards.validate_dimensions(dim, found)
    if on_progress is not None:
        told = {k: seen[k] for k in ("rows_written", "raw_bytes")}
        on_progress({**told, "total": n_todo, "batches": expected.count(), "job_id": spec.job_id, "run": run})

    stats_path = os.path.join(target_root, BATCHES)
    stats = verify_run(spark, target_root, run, expected, spec)
    if n_todo == 0:  # a run without rows commits too
        null = F.lit(None).cast("string")
        zero = F.lit(0).cast("bigint")
        stats = spark.range(1).select(
            F.lit(spec.job_id).alias("job_id"), F.lit(run).cast("bigint").alias("run"), F.lit(f"{run}-none").alias("batch_id"),
            *[zero.alias(c) for c in ("sent", "received", "verified", "failed", "wire_bytes", "raw_bytes")], null.alias("last_id"),
        )
    stats.write.mode("append").parquet(stats_path)
    every = spark.read.schema(STATS).parquet(stats_path)
    stats = every.where((F.col("run") == run) & (F.col("sent") + F.col("received") > 0))
    total = n_todo if not runs else source.count()
    job = every.where(F.col("job_id") == spec.job_id)
    if on_batch is not None:
        on_batch(stats)
    result = MigrationResult(target_root, stats, rollup(job.where(F.col("run") == run), total), rollup(job, total))
    if spec.semantic_verify:
        scores, summary = knn.semantic_validate(
            source, result.target(), spec.semantic_probes, spec.semantic_top_k, metric=spec.source_metric
        )
        result.probe_scores, result.semantic = scores, summary
    return result
