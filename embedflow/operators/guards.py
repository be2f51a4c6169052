"""Pre-flight guards: metric, dimension, normalisation and dimension-order checks.

Driver-side guards (``validate_metrics``, ``validate_dimensions``) act on
declared properties before any data moves; the data-side profiles are
ordinary aggregations with partial (map-side) aggregation, so a hot
namespace or dimension costs one combined row per task.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V

log = logging.getLogger("embedflow.guards")

UNIT_TOLERANCE = 1e-3


class MetricMismatchError(ValueError):
    """Source and target use different distance metrics."""


class DimensionMismatchError(ValueError):
    """Source and target declare different vector dimensions."""


def validate_metrics(source_metric: str, target_metric: str, override: bool = False) -> str:
    """'ok', or 'override' (logged) when names differ and override is set; else raise."""
    src, tgt = V.normalise_metric_name(source_metric), V.normalise_metric_name(target_metric)
    if src == tgt:
        return "ok"
    if override:
        log.warning("distance metric mismatch: source=%r target=%r; proceeding because override is set", src, tgt)
        return "override"
    raise MetricMismatchError(
        f"distance metric mismatch: source={src!r}, target={tgt!r}. Neighbour queries on the target would "
        f"return different results. Set the same metric on both sides, or pass override=True."
    )


def metric_verdict(source_col, target_col, override_col=None) -> Column:
    """Column form of validate_metrics: 'ok' | 'override' | 'mismatch'."""
    same = V.metric_normalise_col(source_col) == V.metric_normalise_col(target_col)
    ov = F.lit(False) if override_col is None else F.coalesce(F.col(override_col) if isinstance(override_col, str) else override_col, F.lit(False))
    return F.when(same, "ok").when(ov, "override").otherwise("mismatch")


def validate_dimensions(source_dim: int | None, target_dim: int | None) -> None:
    """Both declared (non-zero) and different → error."""
    if source_dim and target_dim and source_dim != target_dim:
        raise DimensionMismatchError(f"dimension mismatch: source={source_dim}, target={target_dim}")


def vector_status(vector_col: str = "vector") -> Column:
    """'kept', or 'rejected' for an empty or NULL vector."""
    return F.when(F.coalesce(F.size(vector_col), F.lit(0)) > 0, "kept").otherwise("rejected")


def dimension_profile(df: DataFrame, vector_col: str = "vector") -> DataFrame:
    """dim, n: how many vectors have each length."""
    return df.groupBy(F.size(vector_col).alias("dim")).agg(F.count("*").alias("n"))


def dimension_summary(df: DataFrame, side: str, vector_col: str = "vector") -> DataFrame:
    """One row: side, modal dim (ties → smaller, empty vectors ignored), rows, ragged rows."""
    prof = dimension_profile(df, vector_col)
    key = F.when(F.col("dim") > 0, F.struct(F.col("n"), -F.col("dim")))
    return prof.agg(
        F.max_by(F.col("dim"), key).alias("modal_dim"),
        F.sum("n").alias("n_rows"),
        F.max_by(F.col("n"), key).alias("n_modal"),
    ).select(
        F.lit(side).alias("side"),
        F.col("modal_dim").cast("int").alias("modal_dim"),
        F.coalesce(F.col("n_rows"), F.lit(0)).cast("bigint").alias("n_rows"),
        (F.coalesce(F.col("n_rows"), F.lit(0)) - F.coalesce(F.col("n_modal"), F.lit(0))).cast("bigint").alias("n_ragged"),
    )


def dimension_check(source: DataFrame, target: DataFrame, declared_source: int = 0, declared_target: int = 0) -> DataFrame:
    """side, modal_dim, n_rows, n_ragged, verdict ('ok' | 'mismatch' | 'ragged') over the two summary rows."""
    both = dimension_summary(source, "source").unionByName(dimension_summary(target, "target"))
    pair = both.agg(F.collect_list(F.struct("side", "modal_dim", "n_rows", "n_ragged")).alias("s"))  # two rows
    dims = F.transform("s", lambda r: r["modal_dim"])
    declared = [d for d in (declared_source, declared_target) if d]
    decl_ok = F.lit(len(set(declared)) <= 1)
    rows = pair.select(F.explode("s").alias("r"), (F.array_min(dims) != F.array_max(dims)).alias("differ"))
    verdict = F.when(F.col("differ") | ~decl_ok, "mismatch").when(F.col("r.n_ragged") > 0, "ragged").otherwise("ok")
    return rows.select("r.side", "r.modal_dim", "r.n_rows", "r.n_ragged", verdict.alias("verdict"))


def norm_profile(df: DataFrame, side: str, vector_col: str = "vector") -> DataFrame:
    """side, min/avg/max L2 norm, share of unit vectors (|norm-1| < 1e-3)."""
    n = V.norm(vector_col)
    return df.select(n.alias("norm")).agg(
        F.lit(side).alias("side"),
        F.min("norm").alias("min_norm"),
        F.avg("norm").alias("avg_norm"),
        F.max("norm").alias("max_norm"),
        F.avg((F.abs(F.col("norm") - 1) < UNIT_TOLERANCE).cast("double")).alias("unit_share"),
    )


def normalisation_verdict(profiles: DataFrame) -> Column:
    """'normalised on one side only' is a stated cause of failed search: flag it."""
    return F.when(F.col("unit_share") == 1.0, "unit").when(F.col("unit_share") == 0.0, "not_unit").otherwise("mixed")


def dimension_order_check(source: DataFrame, target: DataFrame, vector_col: str = "vector") -> DataFrame:
    """Per dimension over ids on both sides: max |source - target|, rows differing there, and
    ``n_permuted``: rows whose sorted values agree while the vectors differ (shuffled order)."""
    from .reconcile import one_row_per_id

    s = one_row_per_id(source.select("id", F.col(vector_col).alias("sv"))).drop("n_rows")
    t = one_row_per_id(target.select("id", F.col(vector_col).alias("tv"))).drop("n_rows")
    j = s.join(t, "id").where(F.size("sv") == F.size("tv"))
    j = j.withColumn("permuted", (F.array_sort("sv") == F.array_sort("tv")) & (F.col("sv") != F.col("tv")))
    diffs = j.select(
        "permuted",
        F.posexplode(F.zip_with("sv", "tv", lambda a, b: F.abs(a.cast("double") - b.cast("double")))).alias("dim_index", "d"),
    )
    return diffs.groupBy("dim_index").agg(
        F.max("d").alias("max_abs_diff"),
        F.count_if(F.col("d") > 0).alias("n_rows_differ"),
        F.count_if("permuted").alias("n_permuted"),
    )
