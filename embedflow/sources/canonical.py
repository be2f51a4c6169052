"""The canonical record table and the basic scan contract."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import CANONICAL_COLUMNS


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def metadata_map(cols: list[str]) -> Column:
    """map(name -> value as text) over the given columns; no columns → empty map."""
    if not cols:
        return F.create_map().cast("map<string,string>")
    pairs = []
    for c in cols:
        pairs += [F.lit(c), F.col(c).cast("string")]
    return F.create_map(*pairs)


def canonicalize(
    df: DataFrame,
    id_col="id",
    vector_col="vector",
    metadata=None,
    namespace=None,
) -> DataFrame:
    """Cast to the canonical layout: id → string, vector → array<float>, null metadata → {}."""
    if metadata is None:
        meta = F.create_map().cast("map<string,string>")
    elif isinstance(metadata, (list, tuple)):
        meta = metadata_map(list(metadata))
    else:
        meta = _c(metadata).cast("map<string,string>")
    ns = F.lit(None).cast("string") if namespace is None else _c(namespace).cast("string")
    return df.select(
        _c(id_col).cast("string").alias("id"),
        _c(vector_col).cast("array<float>").alias("vector"),
        F.coalesce(meta, F.create_map().cast("map<string,string>")).alias("metadata"),
        ns.alias("namespace"),
    )


def from_embeddings(embeddings: DataFrame) -> DataFrame:
    """The driver's ``embeddings(vec_id, embedding, label)`` as canonical records.

    ``label`` becomes both metadata (``{"label": "3"}``) and the namespace
    (``ns3``), so namespaces model a partitioned store.
    """
    return canonicalize(
        embeddings,
        id_col="vec_id",
        vector_col="embedding",
        metadata=["label"],
        namespace=F.concat(F.lit("ns"), F.col("label").cast("string")),
    )


def select_canonical(df: DataFrame) -> DataFrame:
    return df.select(*CANONICAL_COLUMNS)
