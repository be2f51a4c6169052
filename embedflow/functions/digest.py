"""Keyed batch digests (M12), defined once for Spark columns and for Python.

Row message   = id, metadata JSON and namespace, each as '<bytes>:<UTF-8>' (null: '-:'), then the
                IEEE-754 bits of each float32 element as 4 big-endian bytes (any NaN: 7fc00000)
Row digest    = sha256(row message), hex
Batch message = batch_id '|' count '|' dim '|' row digests in order, comma-joined
Batch key     = sha256(seed ':' batch_id)
Batch digest  = HMAC-SHA256(key, message), hex

The message covers the batch id, count and dimension as well as every
field of every row, so dropping, duplicating, moving or editing anything
in a batch, down to one bit of one element, changes the digest.  Metadata
JSON is canonical: keys sorted, nulls kept, and a null map counts as an
empty one.  Only 64-hex row digests are collected per batch, and batches
are bounded by the batch size.
"""

from __future__ import annotations

import hashlib
import hmac

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .hashing import batch_key_hex, hmac_sha256_hex

# Default session seed for batch keys.
DIGEST_SEED = "embedflow"


def meta_json(col="metadata") -> Column:
    """Canonical JSON of a string map."""
    c = F.col(col) if isinstance(col, str) else col
    ordered = F.map_from_entries(F.array_sort(F.map_entries(c)))
    return F.coalesce(F.to_json(ordered, {"ignoreNullFields": "false"}), F.lit("{}"))


def float_bits_hex(x: Column) -> Column:
    """IEEE-754 bits of a float32 as 8 hex digits, in exact double arithmetic."""
    d = x.cast("double")
    a = F.abs(d)
    two = lambda e: F.pow(F.lit(2.0), e)
    guess = F.floor(F.log2(F.when(a > 0, a).otherwise(F.lit(1.0)))).cast("double")
    e = guess + F.when(two(guess + 1) <= a, 1).when((two(guess) > a) & (a > 0), -1).otherwise(0)
    normal = (e + 127) * 8388608.0 + (a / two(e) - 1) * 8388608.0
    size = F.when(a == F.lit(float("inf")), F.lit(float(0x7F800000))).when(a < 2.0**-126, a * 2.0**149).otherwise(normal)
    negative = (d < 0) | ((d == 0) & d.cast("string").startswith("-"))
    bits = size + F.when(negative, 2147483648.0).otherwise(0.0)
    return F.when(F.isnan(d), F.lit("7FC00000")).otherwise(F.lpad(F.hex(bits.cast("bigint")), 8, "0"))


def _field(c: Column) -> Column:
    return F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-:"))


def row_digest(id_col="id", vector_col="vector", meta: Column | None = None, namespace: Column | None = None) -> Column:
    """The SQL definition (JVM) of a row digest; ``meta`` is JSON text."""
    null = F.lit(None).cast("string")
    rid = F.col(id_col) if isinstance(id_col, str) else id_col
    head = F.concat(*[_field(null if c is None else c) for c in (rid, meta, namespace)])
    hexes = F.array_join(F.transform(vector_col, float_bits_hex), "")
    return F.sha2(F.concat(F.encode(head, "UTF-8"), F.coalesce(F.unhex(hexes), F.unhex(F.lit("")))), 256)


def _head(*fields: str | None) -> bytes:
    parts = [b"-:" if f is None else b"%d:%s" % (len(b := f.encode("utf-8")), b) for f in fields]
    return b"".join(parts)


def float_bits(flat: np.ndarray) -> bytes:
    """Big-endian bits of float32 values, NaNs alike."""
    v = np.asarray(flat, dtype=np.float32)
    bits = v.view(np.uint32)
    if np.isnan(v).any():
        bits = np.where(np.isnan(v), np.uint32(0x7FC00000), bits)
    return bits.astype(">u4").tobytes()


def row_messages_digest(ids, metas, namespaces, flat: np.ndarray, offsets: np.ndarray) -> list[str]:
    """Row digests from a flat float array and row offsets (Arrow list layout)."""
    be = float_bits(flat)
    sha = hashlib.sha256
    out = []
    for i, (rid, meta, ns) in enumerate(zip(ids, metas, namespaces)):
        h = sha(_head(rid, meta, ns))
        h.update(be[offsets[i] * 4 : offsets[i + 1] * 4])
        out.append(h.hexdigest())
    return out


def flat_floats(arr) -> tuple[np.ndarray, np.ndarray]:
    """A list array's values as one float32 array, and the offsets of its rows (sliced or with nulls as well)."""
    import pyarrow as pa

    from .arrowvec import list_lengths, numbers

    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    flat = numbers(arr.flatten()).astype(np.float32, copy=False)
    return flat, np.r_[0, np.cumsum(np.maximum(list_lengths(arr), 0))]


def _described(df: DataFrame) -> list[Column]:
    """id, vector, canonical metadata JSON and namespace of a frame that may lack the last two."""
    null = F.lit(None).cast("string")
    meta = F.col("meta_json") if "meta_json" in df.columns else meta_json() if "metadata" in df.columns else null
    return [F.col("id"), F.col("vector"), meta.alias("_meta"), (F.col("namespace") if "namespace" in df.columns else null).alias("_ns")]


def with_row_digests(df: DataFrame, keep: list[str], out: str = "rd") -> DataFrame:
    """``keep`` columns plus the row digest ``out``, computed on Arrow buffers (same value as row_digest).

    The digest covers id, vector, metadata (or meta_json) and namespace, as far as ``df`` has them.  The
    vector column is read as one flat float32 buffer per batch; Python only calls sha256 per row.
    """
    import pyarrow as pa

    schema = T.StructType([f for f in df.select(*keep).schema.fields] + [T.StructField(out, T.StringType())])
    told = [c.alias(f"_d{i}") for i, c in enumerate(_described(df))]

    def run(batches):
        for b in batches:
            flat, offs = flat_floats(b.column("_d1"))
            rd = row_messages_digest(*[b.column(c).to_pylist() for c in ("_d0", "_d2", "_d3")], flat, offs)
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(keep))] + [pa.array(rd, type=pa.string())], names=keep + [out])

    return df.select(*keep, *told).mapInArrow(run, schema)


def digest_of(batch_id: Column, count: Column, dim: Column, digests: Column, seed: str = DIGEST_SEED) -> Column:
    """Keyed digest from an array of row digests (any order)."""
    msg = F.concat_ws("|", batch_id.cast("string"), count.cast("string"), dim.cast("string"), F.array_join(F.array_sort(digests), ","))
    return hmac_sha256_hex(batch_key_hex(seed, batch_id), msg)


def batch_digests(batched: DataFrame, seed: str = DIGEST_SEED, batch_col: str = "batch_id") -> DataFrame:
    """batch_id, count, dim, digest for rows carrying (batch_id, id, vector[, metadata, namespace])."""
    base = batched.withColumn("batch_id", F.col(batch_col)).withColumn("d", F.size("vector"))
    g = with_row_digests(base, ["batch_id", "d"]).groupBy("batch_id").agg(
        F.count("*").alias("count"), F.max("d").alias("dim"), F.collect_list("rd").alias("digests")
    )
    return g.select(
        "batch_id",
        F.col("count").cast("bigint").alias("count"),
        F.col("dim").cast("int").alias("dim"),
        digest_of(F.col("batch_id"), F.col("count"), F.col("dim"), F.col("digests"), seed).alias("digest"),
    )


# ── the same definition in Python, for frame codecs running inside tasks ─────


def row_digests_matrix(ids, vectors: list[np.ndarray], metas=None, namespaces=None) -> list[str]:
    """Row digests of decoded vectors (any lengths)."""
    none = [None] * len(vectors)
    offsets = np.r_[0, np.cumsum(np.array([len(v) for v in vectors], dtype=np.int64))].astype(np.int64)
    flat = np.concatenate([np.asarray(v, np.float32) for v in vectors]) if len(vectors) else np.zeros(0, np.float32)
    return row_messages_digest(list(ids), none if metas is None else metas, none if namespaces is None else namespaces, flat, offsets)


def batch_digest_from_rows(batch_id, row_digests: list[str], dim: int, seed: str = DIGEST_SEED) -> str:
    msg = f"{batch_id}|{len(row_digests)}|{dim}|" + ",".join(sorted(row_digests))
    key = hashlib.sha256(f"{seed}:{batch_id}".encode("utf-8")).digest()
    return hmac.new(key, msg.encode("utf-8"), hashlib.sha256).hexdigest()


def row_digest_py(rid: str, v: np.ndarray, meta: str | None = None, namespace: str | None = None) -> str:
    return row_digests_matrix([rid], [np.asarray(v, np.float32)], [meta], [namespace])[0]


def batch_digest_py(batch_id: int, ids, vectors, metas=None, namespaces=None, seed: str = DIGEST_SEED) -> str:
    dim = max((len(v) for v in vectors), default=0)
    return batch_digest_from_rows(batch_id, row_digests_matrix(ids, vectors, metas, namespaces), dim, seed)
