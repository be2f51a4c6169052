"""Change reads (S11): rows newer than a high-water mark, in commit order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scan_changes(df: DataFrame, since, ts_col: str = "updated_at", id_col: str = "id", ordered: bool = True) -> DataFrame:
    """Rows with ``ts_col > since`` (NULL since → all rows), ordered by (ts, id)."""
    out = df if since is None else df.where(F.col(ts_col) > F.lit(since).cast(df.schema[ts_col].dataType))
    return out.orderBy(ts_col, id_col) if ordered else out


def high_water_mark(df: DataFrame, ts_col: str = "updated_at"):
    """max(ts) of what was read: the next ``since``."""
    return df.agg(F.max(ts_col)).first()[0]
