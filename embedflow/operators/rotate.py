"""Orthogonal rotation of vectors (M7-M9).

The key is a product of two Householder reflections whose unit normals
come from a text seed (functions.hashing), so the rotation is:

* exactly orthogonal by construction (K·Kᵀ = I up to rounding),
* O(dim) per vector as a JVM expression (two dot products), with no
  dim × dim matrix to broadcast,
* reproducible in plain SQL.

An arbitrary orthogonal key matrix (e.g. from QR of a seeded Gaussian, as
callers may already hold) is supported by ``rotate_with_matrix``: the key
table ``(j, col)`` is collected once (dim² doubles, size-checked) and
applied as one BLAS call per Arrow batch.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..functions.hashing import hash_uniform_vector

# Default key seed.
KEY_SEED = "embedflow-key"
MAX_KEY_CELLS = 16 * 1024 * 1024


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def key_normals(seed: str, dim) -> tuple[Column, Column]:
    """The two reflection normals (not normalised; reflect() divides by u·u)."""
    return hash_uniform_vector(F.lit(seed), F.lit("k1"), dim), hash_uniform_vector(F.lit(seed), F.lit("k2"), dim)


def reflect(v: Column, u: Column) -> Column:
    """v - 2 (v·u)/(u·u) u  (a Householder reflection, its own inverse); O(dim) per row."""
    c = F.lit(-2.0) * _dot(v, u) / _dot(u, u)
    return V.axpy(c, u, v)


def key_normal_values(spark, seed: str, dim: int) -> tuple[list[float], list[float]]:
    """The two normals as driver-side lists (2 × dim doubles), computed once by Spark."""
    u1, u2 = key_normals(seed, dim)
    row = spark.range(1).select(u1.alias("u1"), u2.alias("u2")).first()
    return list(row["u1"]), list(row["u2"])


def rotate_col(vector_col, seed: str, dim, inverse: bool = False, normals=None) -> Column:
    """v @ K (or v @ Kᵀ when inverse) with K = H1·H2, as float32.

    ``normals`` (from key_normal_values) turns the key into literals; without
    it the normals are recomputed from the seed on every row.
    """
    if normals is None:
        u1, u2 = key_normals(seed, dim)
    else:
        u1, u2 = (F.array(*[F.lit(float(x)) for x in u]) for u in normals)
    v = (F.col(vector_col) if isinstance(vector_col, str) else vector_col).cast("array<double>")
    first, second = (u2, u1) if inverse else (u1, u2)
    return reflect(reflect(v, first), second).cast("array<float>")


def rotate(df: DataFrame, seed: str, dim: int, inverse: bool = False, vector_col: str = "vector") -> DataFrame:
    normals = key_normal_values(df.sparkSession, seed, dim)
    return df.withColumn(vector_col, rotate_col(vector_col, seed, dim, inverse, normals))


def key_table(spark, seed: str, dim: int) -> DataFrame:
    """j INT, col ARRAY<DOUBLE>: column j of K = H1 H2 (so (v @ K)[j] = v · col_j)."""
    u1, u2 = key_normals(seed, dim)
    lit = lambda u: F.array(*[F.lit(float(x)) for x in u])
    n1, n2 = key_normal_values(spark, seed, dim)
    e_j = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), lambda i: F.when(i == F.col("j"), F.lit(1.0)).otherwise(F.lit(0.0)))
    return spark.range(dim).select(F.col("id").cast("int").alias("j")).select("j", reflect(reflect(e_j, lit(n2)), lit(n1)).alias("col"))


def collect_key(key: DataFrame) -> np.ndarray:
    n = key.count()
    if n * n > MAX_KEY_CELLS:
        raise ValueError(f"key of dimension {n} exceeds the broadcast bound")
    rows = key.orderBy("j").collect()
    return np.array([r["col"] for r in rows], dtype=np.float64).T  # K[:, j] = col_j


def rotate_with_matrix(df: DataFrame, K: np.ndarray, inverse: bool = False, vector_col: str = "vector") -> DataFrame:
    """Block form: X @ K (or X @ Kᵀ) per Arrow batch; other columns pass through."""
    M = K.T if inverse else K
    dim = M.shape[0]
    schema = T.StructType([f if f.name != vector_col else T.StructField(vector_col, T.ArrayType(T.FloatType())) for f in df.schema.fields])

    def apply(batches):
        for pdf in batches:
            if len(pdf) == 0:
                continue
            vecs = pdf[vector_col].to_numpy()
            ok = np.fromiter((v is not None and len(v) == dim for v in vecs), bool, len(vecs))
            out = list(vecs)
            if ok.any():
                X = np.stack([np.asarray(v, dtype=np.float64) for v in vecs[ok]])
                Y = (X @ M).astype(np.float32)
                for i, y in zip(np.nonzero(ok)[0], Y):
                    out[i] = y
            pdf[vector_col] = out
            yield pdf

    return df.mapInPandas(apply, schema)
