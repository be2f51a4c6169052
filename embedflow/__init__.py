"""embedflow: moving, syncing and checking embedding tables on Spark.

Names and sub-packages are loaded when they are first asked for: a Python worker imports this package for one
operator's functions, and the others (and pandas with them) would take some 35 MB in every worker.
"""

from __future__ import annotations

import importlib

__version__ = "0.1.0"

_HOMES = {
    "DimensionMismatchError": "operators.guards",
    "JobSpec": "plans.migrate",
    "MetricMismatchError": "operators.guards",
    "MigrationResult": "plans.migrate",
    "SyncTarget": "streaming.sync",
    "knn_topk": "operators.knn",
    "make_probes": "operators.knn",
    "migrate": "plans.migrate",
    "reader": "sources",
    "reconcile": "operators.reconcile",
    "semantic_validate": "operators.knn",
    "start_sync_stream": "streaming.sync",
    "sync_once": "streaming.sync",
    "upsert_replace": "operators.upsert",
    "upsert_vector_only": "operators.upsert",
    "validate_dimensions": "operators.guards",
    "validate_metrics": "operators.guards",
}
_PARTS = ("functions", "operators", "plans", "schema", "session", "sources", "storage", "streaming")

__all__ = sorted(_HOMES)


def __getattr__(name: str):
    if name in _PARTS:
        return importlib.import_module(f".{name}", __name__)
    if name not in _HOMES:
        raise AttributeError(f"module {__name__!r} has no attribute {name!r}")
    value = getattr(importlib.import_module(f".{_HOMES[name]}", __name__), name)
    globals()[name] = value
    return value


def __dir__() -> list[str]:
    return sorted({*globals(), *__all__, *_PARTS})
