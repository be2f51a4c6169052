"""Readers: canonical scan, dump normalisers, change scans, generators.

``reader(name)`` looks a normaliser up by store-shape name (case-insensitive);
an unknown name raises ValueError listing the known ones.  A store with a
network API plugs in as a Python ``pyspark.sql.datasource.DataSource`` whose
output is passed to one of these normalisers.
"""

from __future__ import annotations

from . import canonical, changes, dumps

# name -> function(DataFrame, **options) -> canonical DataFrame
READERS = {
    "canonical": canonical.canonicalize,
    "text_vectors": dumps.from_text_vectors,
    "relational": dumps.from_text_vectors,
    "parallel_arrays": dumps.from_parallel_arrays,
    "points": dumps.from_points,
    "named_vectors": dumps.from_named_vectors,
    "positional": dumps.from_positional,
    "json_batches": dumps.from_json_batches,
}


def reader(name: str):
    key = name.lower()
    if key not in READERS:
        raise ValueError(f"unknown reader {name!r}; available: {', '.join(sorted(READERS))}")
    return READERS[key]


__all__ = ["READERS", "reader", "canonical", "changes", "dumps"]
