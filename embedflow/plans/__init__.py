"""Registered queries (name → fn(spark, sf_dir)) and their oracle SQL."""

from . import job_queries, knn_queries, ledger_queries, record_queries, store_queries, structure_queries, sync_queries, transport_queries  # noqa: F401  (register on import)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
