"""Shared pieces of the operators' tests."""

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def docs(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


#: Rows that every operator must take: nulls, empty and blank texts, ties, repeated rows, a very long text.
ODD_TEXTS = [None, "", " \n\t ", "a", "one two", "x" * 50_000, "same words here again", "same words here again", "é中\U0001f600 \x00\x1c  ", "w " * 20_000]


def odd(spark):
    return docs(spark, ODD_TEXTS + ["same words here again", None], list(range(len(ODD_TEXTS))) + [7, None])


def clashing(df):
    """``df`` with extra columns named like what operators make."""
    from pyspark.sql import functions as F

    names = "carry row id fp root tie known component_id value ids n_tokens bytes spans items n_words votes kept posterior clean changed host path kind w u v _"
    return df.select("*", *[F.lit(f"extra {n}").alias(n) for n in names.split()])
