"""Seeded generators that grow with an input table.

Each generated row is keyed by a row of the input (an id or a batch
position), so the work partitions with that table.  Randomness comes from
numpy generators seeded per row or per batch inside Arrow UDFs; cluster
assignment and metadata are SQL expressions.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import hash_unit_vector

# Practice areas (20 clusters) and document types of the demo corpus.
PRACTICE_AREAS = [
    "contracts", "litigation", "intellectual_property", "mergers_acquisitions",
    "employment", "real_estate", "tax_law", "bankruptcy", "securities",
    "antitrust", "environmental", "healthcare_law", "immigration",
    "criminal_defense", "family_law", "insurance", "privacy_data",
    "regulatory_compliance", "arbitration", "international_trade",
]
DOC_TYPES = ["contract", "motion", "brief", "deposition", "exhibit", "opinion", "memo"]
CORPUS_SEED = "42"
NOISE = 0.3


def cluster_of(i: Column, n_clusters: int, seed: str = CORPUS_SEED) -> Column:
    h = F.sha2(F.concat_ws(":", F.lit(seed), i.cast("string")), 256)
    return F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint"), F.lit(n_clusters)).cast("int")


def corpus_metadata(i: Column, cluster: Column) -> list[Column]:
    areas = F.array(*[F.lit(a) for a in PRACTICE_AREAS])
    types = F.array(*[F.lit(t) for t in DOC_TYPES])
    return [
        F.format_string("doc_%07d", i).alias("id"),
        F.element_at(areas, cluster + 1).alias("practice_area"),
        F.element_at(types, (F.pmod(i, F.lit(len(DOC_TYPES))) + 1).cast("int")).alias("doc_type"),
        F.pmod(i, F.lit(20)).cast("int").alias("chunk_index"),
        F.format_string("firm_%03d", F.pmod(F.floor(i / 1000), F.lit(50))).alias("firm_id"),
        (F.lit(2018) + F.pmod(i, F.lit(7))).cast("int").alias("year"),
    ]


def gen_clustered_vectors(keys: DataFrame, dim: int, n_clusters: int = 20, noise: float = NOISE, seed: str = CORPUS_SEED, key_col: str = "i") -> DataFrame:
    """One document chunk per input key: unit(center[cluster] + noise·N(0, I)), metadata by rule."""
    spark = keys.sparkSession
    centers_rows = (
        spark.range(n_clusters)
        .select(F.col("id").alias("c"), hash_unit_vector(f"{seed}-center", F.col("id"), dim).alias("v"))
        .orderBy("c")
        .collect()
    )
    centers = np.array([r["v"] for r in centers_rows], dtype=np.float64)
    i = F.col(key_col).cast("bigint")
    base = keys.select(i.alias("i"), cluster_of(i, n_clusters, seed).alias("cluster"))
    seed_int = int(seed) if seed.isdigit() else int.from_bytes(hashlib.sha256(seed.encode("utf-8")).digest()[:8], "big")

    def draw(batches):
        for pdf in batches:
            draws = np.array([np.random.default_rng([seed_int, int(k)]).standard_normal(dim) for k in pdf["i"]]).reshape(len(pdf), dim)
            v = centers[pdf["cluster"].to_numpy(dtype=np.int64)] + noise * draws
            pdf["vector"] = list((v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32))
            yield pdf

    schema = T.StructType(base.schema.fields + [T.StructField("vector", T.ArrayType(T.FloatType()))])
    g = base.mapInPandas(draw, schema)
    return g.select(*corpus_metadata(F.col("i"), F.col("cluster")), "cluster", "vector")


def gen_unit_batches(batched: DataFrame, dim: int, batch_size: int) -> DataFrame:
    """Row ``pos`` of batch ``b`` = row pos of unit(N(0,1) draws of shape (batch_size, dim) seeded by b)."""
    base = batched.select(F.col("batch_id").cast("bigint").alias("batch_id"), F.col("pos").cast("bigint").alias("pos"))

    def draw(batches):
        last, unit = None, None
        for pdf in batches:
            vecs = [None] * len(pdf)
            for b, at in pdf.groupby("batch_id", sort=True).indices.items():
                if b != last:  # rows arrive batch by batch, so each is drawn once and one is held
                    rows = np.random.default_rng(int(b)).standard_normal((batch_size, dim)).astype(np.float32)
                    last, unit = b, rows / (np.linalg.norm(rows, axis=1, keepdims=True) + 1e-9)
                for i, v in zip(at, unit[pdf["pos"].to_numpy()[at]]):
                    vecs[i] = v
            pdf["vector"] = vecs
            yield pdf

    schema = T.StructType(base.schema.fields + [T.StructField("vector", T.ArrayType(T.FloatType()))])
    g = base.repartition("batch_id").sortWithinPartitions("batch_id").mapInPandas(draw, schema)
    return g.select(F.format_string("vec_%04d_%06d", "batch_id", "pos").alias("id"), "batch_id", "pos", "vector")
