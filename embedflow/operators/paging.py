"""Ordered pages and caps (P5, P6, P8): limits here are the feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def page_offset(df: DataFrame, offset: int, size: int, order: str = "id") -> DataFrame:
    """ORDER BY order LIMIT size OFFSET offset (Catalyst plans a TakeOrderedAndProject)."""
    return df.orderBy(order).offset(offset).limit(size)


def page_keyset(df: DataFrame, after, size: int, order: str = "id") -> DataFrame:
    """Cursor page: rows with order > after, first ``size`` of them; after=None → first page."""
    rows = df if after is None else df.where(F.col(order) > F.lit(after))
    return rows.orderBy(order).limit(size)


def limit_records(df: DataFrame, n: int, order: str = "id") -> DataFrame:
    """The first n records in ``order``: a deterministic cap on the input."""
    return df.orderBy(order).limit(n)
