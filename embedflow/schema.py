"""Canonical record layout shared by every reader and writer."""

from pyspark.sql import types as T

VECTOR = T.ArrayType(T.FloatType(), containsNull=False)
METADATA = T.MapType(T.StringType(), T.StringType(), valueContainsNull=True)

CANONICAL = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("vector", VECTOR, False),
        T.StructField("metadata", METADATA, True),
        T.StructField("namespace", T.StringType(), True),
    ]
)

CANONICAL_COLUMNS = [f.name for f in CANONICAL.fields]

# One row per committed batch of a job; the append-only progress ledger.
BATCH_STATS = T.StructType(
    [
        T.StructField("job_id", T.StringType(), False),
        T.StructField("batch_id", T.LongType(), False),
        T.StructField("sent", T.LongType(), False),
        T.StructField("received", T.LongType(), False),
        T.StructField("verified", T.LongType(), False),
        T.StructField("failed", T.LongType(), False),
        T.StructField("wire_bytes", T.LongType(), False),
        T.StructField("raw_bytes", T.LongType(), False),
        T.StructField("last_id", T.StringType(), True),
    ]
)
