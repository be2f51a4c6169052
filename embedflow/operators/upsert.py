"""Writers' semantics as DataFrame rewrites (K1-K7).

Plain Parquet has no MERGE, so an upsert is a rewrite: the new version is
computed as a join on ``id`` (one shuffle of both sides by id, or none
when both are bucketed by id) and written to a new folder; the caller
switches to it.  Never overwrite the folder being read.  Tables in a
format that supports it can use ``DataFrame.mergeInto`` instead.  A null id
is an id like any other, here as in ``migrate`` and ``reconcile``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import stable_point_id
from ..schema import CANONICAL_COLUMNS
from .joins import null_safe_join


def latest_per_id(df: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """Last write wins: keep the row with the largest ``order`` per id.

    ``max_by`` is a partial aggregate, so a hot id is combined map-side and
    never collected into one task.
    """
    cols = [c for c in df.columns if c != id_col]
    key = F.struct(*[F.col(c) for c in order])
    picked = df.groupBy(id_col).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), key).alias("_r"))
    return picked.select(id_col, *[F.col(f"_r.{c}").alias(c) for c in cols])


def _unique_source(source: DataFrame, id_col: str, dedupe: bool, order: list[str] | None) -> DataFrame:
    if not dedupe:
        return source
    if order:
        return latest_per_id(source, order, id_col)
    from .reconcile import one_row_per_id

    return one_row_per_id(source, id_col).drop("n_rows")


def upsert_replace(
    target: DataFrame, source: DataFrame, id_col: str = "id", dedupe: bool = True, order: list[str] | None = None
) -> DataFrame:
    """Insert-or-replace whole records by id (vector and metadata).

    With ``dedupe`` the source is first reduced to one row per id: the last
    one by the ``order`` columns, or, as a table has no order of its own, the
    one with the smallest content hash.
    """
    source = _unique_source(source, id_col, dedupe, order)
    cols = target.columns
    kept = null_safe_join(target, source.select(id_col), [id_col], "left_anti")
    return kept.select(*cols).unionByName(source.select(*cols))


def upsert_vector_only(
    target: DataFrame, source: DataFrame, id_col: str = "id", dedupe: bool = True, order: list[str] | None = None
) -> DataFrame:
    """On id conflict replace only the vector; existing metadata and namespace are kept.

    The target is a keyed table (one row per id); the source is reduced to
    one row per id with ``dedupe``, so the full outer join is 1:1.
    """
    source = _unique_source(source, id_col, dedupe, order)
    t = target.select(id_col, *[F.col(c).alias(f"t_{c}") for c in target.columns if c != id_col], F.lit(True).alias("_t"))
    s = source.select(id_col, *[F.col(c).alias(f"s_{c}") for c in source.columns if c != id_col], F.lit(True).alias("_s"))
    j = null_safe_join(t, s, [id_col], "full_outer")
    out = [F.col(id_col)]
    for c in [c for c in target.columns if c != id_col]:
        if c == "vector":
            out.append(F.when(F.col("_s"), F.col("s_vector")).otherwise(F.col("t_vector")).alias("vector"))
        else:
            out.append(F.when(F.col("_t"), F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")).alias(c))
    return j.select(*out)


def append_records(target: DataFrame, source: DataFrame) -> DataFrame:
    """Insert without conflict handling (duplicates stay)."""
    return target.unionByName(source.select(*target.columns))


def project_metadata_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Write only the configured metadata keys as columns; a missing key is NULL."""
    keep = [c for c in df.columns if c != "metadata"]
    return df.select(*keep, *[F.try_element_at("metadata", F.lit(c)).alias(c) for c in columns])


def id_map(df: DataFrame, id_col: str = "id") -> DataFrame:
    """id, point_id, n_sharing: the target-domain id of every source id and how many ids share it."""
    m = df.select(F.col(id_col).alias("id")).distinct().withColumn("point_id", stable_point_id("id"))
    shared = m.groupBy("point_id").agg(F.count("*").alias("n_sharing"))
    return m.join(shared, "point_id").select("id", "point_id", "n_sharing")


def ensure_target(
    spark: SparkSession, name: str, location: str, dim: int, metric: str = "cosine", partition_by: str | None = "namespace"
) -> dict:
    """CREATE TABLE IF NOT EXISTS with vector.dim / vector.metric properties; verify them if it exists.

    Returns the table properties.  Raises if an existing table disagrees.
    """
    from ..functions.vectors import normalise_metric_name
    from .guards import DimensionMismatchError, MetricMismatchError

    metric = normalise_metric_name(metric)
    part = f"PARTITIONED BY ({partition_by})" if partition_by else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} (id STRING, vector ARRAY<FLOAT>, metadata MAP<STRING,STRING>, "
        f"namespace STRING) USING parquet {part} LOCATION '{location}' "
        f"TBLPROPERTIES ('vector.dim'='{dim}', 'vector.metric'='{metric}')"
    )
    props = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if props.get("vector.dim") not in (None, str(dim)):
        raise DimensionMismatchError(f"{name} has dimension {props['vector.dim']}, data has {dim}")
    if props.get("vector.metric") not in (None, metric):
        raise MetricMismatchError(f"{name} has metric {props['vector.metric']}, source uses {metric}")
    return props


def write_version(df: DataFrame, path: str, partition_by: str | None = "namespace") -> str:
    """Write one immutable version of a table (the pointer switch is the caller's)."""
    w = df.select(*CANONICAL_COLUMNS).write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    return path


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x
