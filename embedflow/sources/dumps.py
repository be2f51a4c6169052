"""Normalisers: embedding dumps of different shapes → canonical records.

Each vendor's export shape becomes one DataFrame transformation; reading
the dump itself is ``spark.read.<format>`` (or a user's Python
``DataSource`` for a store with a network API).  All of them are narrow
(no shuffle) except ``fetch_by_ids`` and ``from_positional`` which join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .canonical import canonicalize, metadata_map


def empty_meta() -> Column:
    return F.create_map().cast("map<string,string>")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def parse_text_vector(col) -> Column:
    """'[a,b,...]', 'a, b' or '[]' → array<float> (NULL stays NULL)."""
    body = F.regexp_replace(F.trim(_c(col)), r"^\[|\]$", "")
    return F.from_json(F.concat(F.lit("["), body, F.lit("]")), T.ArrayType(T.FloatType()))


def format_text_vector(col) -> Column:
    """array<float> → '[a,b,...]' (shortest text that reads back to the same float)."""
    return F.to_json(_c(col))


def from_text_vectors(df: DataFrame, id_col: str, vector_col: str, metadata_cols=None, namespace=None) -> DataFrame:
    """Relational rows with the vector as text (or already an array) plus chosen metadata columns."""
    vtype = df.schema[vector_col].dataType
    vec = parse_text_vector(vector_col) if isinstance(vtype, T.StringType) else F.col(vector_col)
    return canonicalize(df.withColumn(vector_col, vec), id_col, vector_col, list(metadata_cols or []), namespace)


def from_parallel_arrays(
    pages: DataFrame, ids="ids", embeddings="embeddings", metadatas="metadatas", namespace=None
) -> DataFrame:
    """Pages of parallel arrays ``ids[]``, ``embeddings[]``, ``metadatas[]`` → one row per record.

    A NULL ``metadatas`` array or NULL element becomes ``{}``.
    """
    metas = F.coalesce(_c(metadatas), F.array_repeat(empty_meta(), F.size(_c(ids))))
    ns = F.lit(None).cast("string") if namespace is None else _c(namespace).cast("string")
    z = pages.select(
        ns.alias("namespace"),
        F.inline(F.arrays_zip(_c(ids).alias("id"), _c(embeddings).alias("vector"), metas.alias("metadata"))),
    )
    return canonicalize(z, "id", "vector", F.coalesce(F.col("metadata"), empty_meta()), "namespace")


POINT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("payload", T.MapType(T.StringType(), T.StringType())),
    ]
)


def from_points(df: DataFrame, value_col: str = "value", namespace=None) -> DataFrame:
    """JSON point documents ``{id, vector, payload}``; numeric ids become text."""
    p = df.select(F.from_json(_c(value_col), POINT_SCHEMA).alias("p")).select("p.*")
    return canonicalize(p, "id", "vector", "payload", namespace)


def from_named_vectors(
    df: DataFrame, id_col="uuid", vectors_col="vector", name="default", properties_col="properties", namespace=None
) -> DataFrame:
    """Objects with named vectors: take ``name``; a missing name gives an empty vector."""
    vec = F.coalesce(F.try_element_at(_c(vectors_col), F.lit(name)), F.array().cast("array<float>"))
    return canonicalize(df.withColumn("_v", vec), id_col, "_v", properties_col, namespace)


def from_positional(vectors: DataFrame, ids: DataFrame | None = None, pos_col="pos", vector_col="vector", id_col="id") -> DataFrame:
    """Vectors addressed by position plus an optional position → id table; default id = position.

    Returns canonical columns plus ``pos``.
    """
    v = vectors.select(F.col(pos_col).cast("bigint").alias("pos"), F.col(vector_col).alias("vector"))
    if ids is not None:
        v = v.join(ids.select(F.col(pos_col).cast("bigint").alias("pos"), F.col(id_col).alias("_id")), "pos", "left")
        rid = F.coalesce(F.col("_id").cast("string"), F.col("pos").cast("string"))
    else:
        rid = F.col("pos").cast("string")
    return v.select(
        rid.alias("id"),
        F.col("vector").cast("array<float>").alias("vector"),
        empty_meta().alias("metadata"),
        F.lit(None).cast("string").alias("namespace"),
        "pos",
    )


JSON_BATCH_SCHEMA = T.StructType(
    [
        T.StructField("ids", T.ArrayType(T.StringType())),
        T.StructField("vectors", T.ArrayType(T.ArrayType(T.FloatType()))),
    ]
)


def from_json_batches(df: DataFrame, value_col: str = "value", batch_col: str = "batch_id") -> DataFrame:
    """JSON bodies ``{"ids": [...], "vectors": [[...]]}`` → rows with batch_id, pos, received, wire_bytes."""
    b = df.select(
        F.col(batch_col).alias("batch_id"),
        F.octet_length(_c(value_col)).cast("bigint").alias("wire_bytes"),
        F.from_json(_c(value_col), JSON_BATCH_SCHEMA).alias("b"),
    )
    return b.select(
        "batch_id",
        "wire_bytes",
        F.size("b.ids").cast("bigint").alias("received"),
        F.posexplode(F.arrays_zip(F.col("b.ids").alias("id"), F.col("b.vectors").alias("vector"))).alias("pos", "r"),
    ).select(
        "batch_id",
        F.col("pos").cast("bigint").alias("pos"),
        F.col("r.id").alias("id"),
        F.col("r.vector").cast("array<float>").alias("vector"),
        "received",
        "wire_bytes",
    )


def to_json_batches(batched: DataFrame) -> DataFrame:
    """Inverse of from_json_batches over rows with (batch_id, pos, id, vector): one body per batch."""
    g = batched.groupBy("batch_id").agg(F.sort_array(F.collect_list(F.struct("pos", "id", "vector"))).alias("rs"))
    return g.select(
        "batch_id",
        F.to_json(
            F.struct(F.transform("rs", lambda r: r["id"]).alias("ids"), F.transform("rs", lambda r: r["vector"]).alias("vectors"))
        ).alias("value"),
    )


def fetch_by_ids(records: DataFrame, ids: DataFrame, namespace: str | None = None, id_col: str = "id") -> DataFrame:
    """Records whose id is in ``ids`` (left semi join), optionally within one namespace."""
    r = records if namespace is None else records.where(F.col("namespace") == F.lit(namespace))
    return r.join(ids.select(F.col(id_col).alias("id")), "id", "left_semi")


def scan_ids_then_fetch(records: DataFrame, namespace: str) -> DataFrame:
    """List the ids of one namespace, then fetch their records."""
    ids = records.where(F.col("namespace") == F.lit(namespace)).select("id")
    return fetch_by_ids(records, ids, namespace)


__all__ = [
    "parse_text_vector",
    "format_text_vector",
    "from_text_vectors",
    "from_parallel_arrays",
    "from_points",
    "from_named_vectors",
    "from_positional",
    "from_json_batches",
    "to_json_batches",
    "fetch_by_ids",
    "scan_ids_then_fetch",
    "metadata_map",
]
