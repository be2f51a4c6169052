"""A corpus pipeline over ``documents``: five stages, each of which works on what the one before it kept.

Every stage but the last returns the columns of documents.  Nulls, empty and very long texts, repeated rows
and empty tables are handled as the stages' operators define: a document without words fails the quality
rules; repeated rows count as one near-duplicate group; an empty table stays empty through all stages.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from embedflow.llm import bpe, decontam, quality, secret_scan, simhash  # noqa: E402
from embedflow.llm.queries import vocabulary  # noqa: E402
from embedflow.llm.tables import table, written  # noqa: E402
from embedflow.session import ship_package  # noqa: E402


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is good enough."""
    return quality.good_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: that with the smallest id."""
    ship_package(spark)
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates."""
    ship_package(spark)
    return decontam.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and n_chars brought up to date."""
    ship_package(spark)
    return secret_scan.redacted(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and whether they decode to its text's very bytes.

    The ids are written and read again before they are decoded: an encoding and a decoding task are then
    not up at once, so an executor has one Python worker a core and not two.
    """
    ship_package(spark)
    vocab = vocabulary(spark)
    known = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    kept = ["doc_id", "lang", "source", "n_chars", "text_sha256"]
    encoded = bpe.encode(known, vocab, carry=kept)
    named = written(encoded, "token-ids").withColumn("packed", F.col("ids"))
    decoded = bpe.decode(named, vocab, "ids", carry=[*kept, "packed", "n_tokens", "ids_sha256"])
    round_trip = (F.sha2("bytes", 256) == F.col("text_sha256")).alias("round_trip")
    return decoded.select("doc_id", "lang", "source", "n_chars", F.col("packed").alias("ids"), "n_tokens", "ids_sha256", round_trip)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("tokens", tokens),
]

#: Posterior estimates, 64-bit fingerprints and byte merges are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another over ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
