"""Per-key state that tells new changes from stale ones without reading the target (ST3).

``classify_changes`` keeps, per key, the (updated_at, seq) of the last change that it let through, in a map
state of the stream's own.  Of a key's rows in one trigger the latest is an ``insert`` (no state yet) or an
``update`` if it comes after the state; all others are ``stale``: an upsert of the inserts and updates is
"only if newer than the target", with no join and no look at the target.  Rows pass through in
chunks and only the best so far of each key is held, so a key may have any number of rows in a trigger.

Keys are grouped by a hash into ``BUCKETS``, and a bucket's map has an entry per key: a group of Spark's costs
some milliseconds, so a group per key took most of the time.  A key's entry is read once in a trigger, and
written once if the key has a newer change.  What a row holds beside its key, time and seq goes through the state's worker as one JSON text, which
keeps every value (nulls, NaNs and all 64 bits) and costs it no conversions.

The state lives in the checkpoint, so it survives restarts; with ``ttl_ms`` it expires that long after a
key's last change, and the key's next change is an insert again.  A query with a TTL makes empty batches on
its own to expire state, so ``processAllAvailable`` does not return on it; stop it instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

INSERT, UPDATE, STALE = "insert", "update", "stale"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Groups of keys.  A checkpoint's state is kept by them, so this number can't change under one.
BUCKETS = 1024
_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timeZone": "UTC"}
_OUT = "row_json string, change string"


def _told(rows: list[str], changes: list[str]) -> pd.DataFrame:
    return pd.DataFrame({"row_json": rows, "change": changes}, dtype=object)


class ChangeClassifier(StatefulProcessor):
    """Rows of a bucket of keys → the same rows with what they are: insert, update or stale."""

    def __init__(self, ttl_ms: int | None = None):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getMapState("last", "state_key string", "us bigint, seq bigint", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known, newest, best = set(), {}, {}
        stale: list[str] = []
        for chunk in rows:
            if stale:  # a chunk's by itself
                yield _told(stale, [STALE] * len(stale))
                stale = []
            for k, us, seq, row in zip(*(chunk[c].tolist() for c in ("state_key", "us", "seq", "row_json"))):
                k = k if isinstance(k, str) else None  # pandas has a null as NaN
                if k not in newest:
                    state = self.last.getValue((k,))
                    newest[k] = None if state is None else tuple(state)
                    if state is not None:
                        known.add(k)
                if newest[k] is not None and (us, seq) <= newest[k]:
                    stale.append(row)
                    continue
                if k in best:
                    stale.append(best[k])
                best[k], newest[k] = row, (us, seq)
        for k in best:
            self.last.updateValue((k,), newest[k])
        changes = [STALE] * len(stale) + [UPDATE if k in known else INSERT for k in best]
        yield _told([*stale, *best.values()], changes)

    def close(self) -> None:
        pass


def use_rocksdb(spark: SparkSession) -> None:
    """Keep this session's streaming state in RocksDB, as state with a TTL needs."""
    spark.conf.set(PROVIDER, ROCKSDB)


def _key_text(changes: DataFrame, key: str) -> Column:
    """A key as text, the same for the same keys alone; null stays null."""
    kind, c = changes.schema[key].dataType, F.col(key)
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        c = c + F.lit(0.0)  # -0.0 and 0.0 are one key
    if isinstance(kind, T.TimestampType):
        c = F.unix_micros(c)
    return F.when(c.isNotNull(), F.to_json(F.struct(c.alias("key")), {**_EXACT, "ignoreNullFields": "false"}))


def classify_changes(changes: DataFrame, key: str, ts_col: str, seq_col: str, ttl_ms: int | None = None) -> DataFrame:
    """A streaming ``changes`` with ``change``: insert, update or stale.

    Null keys are one key; a null time comes before all others, a null seq before all of its time.  Equal
    (time, seq) pairs are repeats of one change: the first to arrive counts, the others are stale.
    """
    use_rocksdb(changes.sparkSession)
    times = {f.name for f in changes.schema if isinstance(f.dataType, T.TimestampType)}  # as micros: JSON has no year 10,000
    carried = [F.unix_micros(c).alias(c) if c in times else F.col(c) for c in changes.columns]
    text = _key_text(changes, key)
    packed = changes.select(
        F.pmod(F.xxhash64(text), F.lit(BUCKETS)).cast("int").alias("bucket"),
        text.alias("state_key"),
        F.coalesce(F.unix_micros(F.col(ts_col).cast("timestamp")), F.lit(-(2**63))).alias("us"),
        F.coalesce(F.col(seq_col).cast("bigint"), F.lit(-(2**63))).alias("seq"),
        F.to_json(F.struct(*carried), _EXACT).alias("row_json"),
    )
    mode = "ProcessingTime" if ttl_ms else "None"
    found = packed.groupBy("bucket").transformWithStateInPandas(ChangeClassifier(ttl_ms), _OUT, "Append", mode)
    schema = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in changes.schema])
    row = F.from_json("row_json", schema, _EXACT)
    back = found.select(row.alias("row"), "change")
    return back.select(*[(F.timestamp_micros(f"row.{c}") if c in times else F.col(f"row.{c}")).alias(c) for c in changes.columns], "change")
