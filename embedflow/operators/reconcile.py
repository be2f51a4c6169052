"""Row-by-row reconciliation of a source and a target table.

One full outer join on id; statuses are decided per row with JVM-side
array functions.  ``allclose`` follows numpy: |a - b| <= atol + rtol * |b|.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .joins import null_safe_join

STATUSES = ("missing", "extra", "duplicate", "vector_differs", "metadata_differs", "match")


def one_row_per_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """One row per id plus ``n_rows`` (how many the id had).

    The kept row is the one with the smallest content hash, so the choice is
    deterministic.  It is a partial aggregate: a duplicated hot id is reduced
    map-side, and a later join on id is 1:1 (never all pairs of duplicates).
    A null id is an id like any other.
    """
    cols = [c for c in df.columns if c != id_col]
    repeated = df.groupBy(id_col).agg(F.count("*").alias("n_rows")).where("n_rows > 1")
    if repeated.isEmpty():  # the usual case: ids alone are counted, no vector is sorted or moved
        return df.select(id_col, *cols, F.lit(1).cast("bigint").alias("n_rows"))
    key = F.xxhash64(*[F.to_json(c) if dict(df.dtypes)[c].startswith("map") else F.col(c) for c in cols])
    several = null_safe_join(df, repeated.select(id_col), [id_col], "left_semi")
    g = several.groupBy(id_col).agg(F.count("*").alias("n_rows"), F.min_by(F.struct(*cols), key).alias("_r"))
    picked = g.select(id_col, *[F.col(f"_r.{c}").alias(c) for c in cols], "n_rows")
    once = null_safe_join(df, repeated.select(id_col), [id_col], "left_anti").select(id_col, *cols, F.lit(1).cast("bigint").alias("n_rows"))
    return once.unionByName(picked)


def vectors_close(a, b, atol: float = 0.0, rtol: float = 0.0) -> Column:
    a, b = (F.col(a) if isinstance(a, str) else a), (F.col(b) if isinstance(b, str) else b)
    far = F.exists(
        F.zip_with(a, b, lambda x, y: F.abs(x.cast("double") - y.cast("double")) > F.lit(atol) + F.lit(rtol) * F.abs(y.cast("double"))),
        lambda t: t,
    )
    return (F.size(a) == F.size(b)) & ~far


def reconcile_status(atol: float = 0.0, rtol: float = 0.0) -> Column:
    """Status of a joined row with ``_s, sv, sm`` of the source and ``_t, tv, tm`` of the target (_s, _t: rows of the id)."""
    meta_same = F.coalesce(F.array_sort(F.map_entries("sm")) == F.array_sort(F.map_entries("tm")), F.lit(False)) | (
        F.col("sm").isNull() & F.col("tm").isNull()
    )
    return (
        F.when(F.col("_t").isNull(), "missing")
        .when(F.col("_s").isNull(), "extra")
        .when((F.col("_s") > 1) | (F.col("_t") > 1), "duplicate")
        .when(~vectors_close("sv", "tv", atol, rtol), "vector_differs")
        .when(~meta_same, "metadata_differs")
        .otherwise("match")
    )


def reconcile(source: DataFrame, target: DataFrame, atol: float = 0.0, rtol: float = 0.0) -> DataFrame:
    """id, status: missing (source only) | extra (target only) | duplicate (id repeated on a side) |
    vector_differs | metadata_differs | match.  Null ids are one id, on both sides."""
    src = one_row_per_id(source.select("id", "vector", "metadata"))
    tgt = one_row_per_id(target.select("id", "vector", "metadata"))
    s = src.select("id", F.col("vector").alias("sv"), F.col("metadata").alias("sm"), F.col("n_rows").alias("_s"))
    t = tgt.select("id", F.col("vector").alias("tv"), F.col("metadata").alias("tm"), F.col("n_rows").alias("_t"))
    j = null_safe_join(s, t, ["id"], "full_outer")
    return j.select("id", reconcile_status(atol, rtol).alias("status"))


def reconcile_summary(rec: DataFrame) -> DataFrame:
    return rec.groupBy("status").agg(F.count("*").alias("n"))
