"""Equi-joins in which null is a key like any other."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` joined to ``right`` on equal ``keys``, nulls equal to nulls; each key stands once in the result.

    Spark takes such conditions as join keys, so they are hashed, sorted or broadcast as others are.
    """
    held = {k: f"__right_{k}" for k in keys}
    named = right.withColumnsRenamed(held)
    on = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(h)) for k, h in held.items()])
    out = left.join(named, on, how)
    if how in ("left_semi", "left_anti"):
        return out
    if how == "full_outer":  # equal where both are there, so the other one's is null only if it is null or missing
        out = out.withColumns({k: F.coalesce(k, h) for k, h in held.items()})
    elif how == "right":
        out = out.withColumns({k: F.col(h) for k, h in held.items()})
    return out.drop(*held.values())
