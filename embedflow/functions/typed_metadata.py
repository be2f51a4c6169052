"""Metadata with types: VARIANT columns instead of maps of strings (S1, K6, SURVEY §2.9).

A JSON text becomes a VARIANT, which keeps numbers, booleans, nulls and nesting; fields are taken out by path
with the type that is asked for, and a table's metadata has a schema of its own.  Spark reads a path from the
binary form without parsing the text again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_metadata(text: str | Column) -> Column:
    """A VARIANT of a JSON text; null for null or for what is no JSON."""
    return F.try_parse_json(F.col(text) if isinstance(text, str) else text)


def metadata_text(v: str | Column) -> Column:
    """The JSON text of a VARIANT."""
    return F.to_json(F.col(v) if isinstance(v, str) else v)


def field(v: str | Column, path: str, kind: str) -> Column:
    """The value at a path such as ``$.k`` or ``$.tags[0]``; null if it is missing or can't be cast to it."""
    return F.try_variant_get(F.col(v) if isinstance(v, str) else v, path, kind)


def project_fields(df: DataFrame, fields: dict[str, tuple[str, str]], column: str = "metadata") -> DataFrame:
    """``df`` with a column per entry of ``{name: (path, type)}`` in place of the VARIANT."""
    kept = [c for c in df.columns if c != column and c not in fields]
    return df.select(*[F.col(f"`{c}`") for c in kept], *[field(F.col(column), path, kind).alias(name) for name, (path, kind) in fields.items()])


def where_field(df: DataFrame, path: str, kind: str, test, column: str = "metadata") -> DataFrame:
    """Rows whose field passes ``test(Column)``; rows without it don't."""
    return df.where(test(field(F.col(column), path, kind)))


def metadata_schema(df: DataFrame, column: str = "metadata") -> DataFrame:
    """One row, ``schema``: the merged schema of all values, as Spark writes it; null of an empty table."""
    return df.agg(F.schema_of_variant_agg(F.col(column)).alias("schema"))


def to_strings(v: str | Column) -> Column:
    """The canonical map of strings: top-level fields as text, nested ones as JSON text; null stays null."""
    whole = F.col(v) if isinstance(v, str) else v
    fields = F.try_variant_get(whole, "$", "map<string,variant>")
    text = lambda x: F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x))
    return F.transform_values(fields, lambda _, x: text(x))


def from_strings(metadata: str | Column) -> Column:
    """A VARIANT object of a map of strings, whose numbers and booleans get their types back; null stays null."""
    whole = F.col(metadata) if isinstance(metadata, str) else metadata
    return F.to_variant_object(F.transform_values(whole, lambda _, x: F.coalesce(F.try_parse_json(x), x.cast("variant"))))


CANONICAL_VARIANT = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("vector", T.ArrayType(T.FloatType())),
        T.StructField("metadata", T.VariantType()),
        T.StructField("namespace", T.StringType()),
    ]
)
