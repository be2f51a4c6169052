"""Inputs shared by the registered queries."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.canonical import from_embeddings

# Parameters of the registered checks (the reference's defaults).
N_PROBES = 100
TOP_K = 5
BATCH_SIZE = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical records of ``embeddings``."""
    return from_embeddings(table(spark, sf_dir, "embeddings"))


def rounded_copy(df: DataFrame, digits: int = 2) -> DataFrame:
    """A lossy migration target: each element rounded to ``digits`` decimals."""
    return df.withColumn(
        "vector", F.transform("vector", lambda x: F.round(x.cast("double"), digits).cast("float"))
    )
