"""Incremental and continuous sync of a change feed into a merge-on-read target (ST1-ST5).

Target layout (all under one root in shared storage):

    root/delta/<stream>-<epoch>/  the epoch's changes, one (latest) row per key
    root/base/<id>/               a compacted snapshot covering every commit up to its ``upto``
    root/_ledger/<commit>.json    one entry per commit: stream, epoch, kind ('delta' | 'base'), path,
                                  n_changes, hw_ts, hw_seq, committed_at; a base's also has ``upto`` and the
                                  epochs that are behind it
    root/_ledger/_newest          the number of the last base: a hint that saves reading older entries

* An epoch (``foreachBatch``) costs O(its changes): last change per key
  (max_by over (updated_at, seq), a partial aggregate), written to its own
  folder, then one ledger entry.  Epochs are numbered by each stream for
  itself, so a stream's commits are known by (stream, epoch).  A retried
  epoch rewrites its own folder and is committed once, so retries are
  idempotent and no folder that readers use is ever overwritten.
* A commit's number is its entry's name, which is made whole and once: of two
  writers (a load, streams, a compaction) that want the same number one gets
  it and the other takes the next.  Every stream has one writer.
* The current table is the last row per key over the newest base and the
  deltas numbered beyond its ``upto`` (one aggregation; hot keys combine
  map-side), so late changes find their place whenever they arrive.
  ``compact`` fixes ``upto`` before it reads and folds the deltas up to it,
  so what is committed meanwhile stays a delta of the new base; streams can
  compact every N epochs.
* An operation reads the ledger once, in one job, from the newest base on:
  what that takes does not grow with the epochs behind it.
* High-water marks are (updated_at, seq) pairs.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import uuid
import zlib
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import storage
from ..operators.progress import latest

ENTRY = (
    "commit bigint, stream string, epoch bigint, kind string, path string, n_changes bigint, hw_us bigint, hw_seq bigint, "
    "committed_us bigint, upto bigint, epochs map<string,array<array<bigint>>>"
)
LEDGER_COLUMNS = ["commit", "stream", "epoch", "kind", "path", "n_changes", "hw_ts", "hw_seq", "committed_at"]
#: High water of changes without a time: year 1.
NO_TIME = -62_135_596_800_000_000
#: Stream name of changes that are applied by hand.
BATCH = "batch"


def _add_epoch(spans: list[list[int]], epoch: int) -> list[list[int]]:
    """``spans`` of epochs [first, last], ascending, with one more in."""
    out: list[list[int]] = []
    for a, b in sorted([*spans, [epoch, epoch]]):
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


@dataclass
class State:
    """What a ledger says: the last commit, what the current table consists of, committed epochs, high water."""

    commit: int = -1
    base: str | None = None
    upto: int = -1
    deltas: list[str] = field(default_factory=list)
    epochs: dict[str, list[list[int]]] = field(default_factory=dict)
    high_water: tuple[int, int] | None = None  # (microseconds, seq)

    def has(self, stream: str, epoch: int) -> bool:
        return any(a <= epoch <= b for a, b in self.epochs.get(stream, []))

    def next_epoch(self, stream: str) -> int:
        return max((b for _, b in self.epochs.get(stream, [])), default=-1) + 1

    def paths(self) -> list[str]:
        return ([self.base] if self.base else []) + sorted(self.deltas)


@dataclass
class SyncTarget:
    """A merge-on-read table at ``root`` keyed by ``key``; rows ordered by (ts_col, seq_col)."""

    root: str
    key: str = "id"
    ts_col: str = "updated_at"
    seq_col: str = "seq"

    @property
    def ledger_path(self) -> str:
        return os.path.join(self.root, "_ledger")

    def entry_path(self, commit: int) -> str:
        return os.path.join(self.ledger_path, f"{commit:020d}.json")

    def _entries(self, spark: SparkSession, start: int = 0) -> DataFrame | None:
        """Entries from commit ``start`` on, pruned by file name; None if there is no ledger (other errors are raised)."""
        try:
            every = spark.read.schema(ENTRY).option("mode", "FAILFAST").json(self.ledger_path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return None
        return every.where(F.col("_metadata.file_name") >= f"{start:020d}.json") if start else every

    def ledger(self, spark: SparkSession) -> DataFrame | None:
        """The commits; None if there is no ledger yet."""
        every = self._entries(spark)
        if every is None:
            return None
        times = {"hw_ts": F.timestamp_micros("hw_us"), "committed_at": F.timestamp_micros("committed_us")}
        return every.withColumns(times).select(*LEDGER_COLUMNS)

    def state(self, spark: SparkSession) -> State:
        """The ledger's state in one job: the newest base and what came after its ``upto``."""
        hint = storage.read_text(spark, os.path.join(self.ledger_path, "_newest"))
        start = json.loads(hint)["start"] if hint else 0
        entries = self._entries(spark, start)
        rows = [] if entries is None else sorted(entries.collect(), key=lambda r: r["commit"])  # commits since a compaction
        out = State(commit=max((r["commit"] for r in rows), default=-1))
        bases = [r for r in rows if r["kind"] == "base"]
        if bases:
            newest = max(bases, key=lambda r: (r["upto"], r["commit"]))
            out.base, out.upto = newest["path"], newest["upto"]
            out.epochs = {k: [list(x) for x in v] for k, v in (newest["epochs"] or {}).items()}
            out.high_water = (newest["hw_us"], newest["hw_seq"])
        for r in rows:
            if r["kind"] == "delta" and r["commit"] > out.upto:
                out.deltas.append(r["path"])
                out.epochs[r["stream"]] = _add_epoch(out.epochs.get(r["stream"], []), r["epoch"])
                out.high_water = max(out.high_water or (r["hw_us"], r["hw_seq"]), (r["hw_us"], r["hw_seq"]))
        return out

    def committed(self, spark: SparkSession, stream: str, epoch: int) -> bool:
        return self.state(spark).has(stream, epoch)

    def last_commit(self, spark: SparkSession) -> int:
        """Number of the last commit, -1 if there is none."""
        return self.state(spark).commit

    def next_epoch(self, spark: SparkSession, stream: str) -> int:
        return self.state(spark).next_epoch(stream)

    def high_water(self, spark: SparkSession):
        """(hw_ts, hw_seq) over all committed changes, or None."""
        hw = self.state(spark).high_water
        return None if hw is None else (dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=hw[0]), hw[1])

    def current(self, spark: SparkSession, schema=None, state: State | None = None) -> DataFrame | None:
        paths = (state or self.state(spark)).paths()
        if not paths:
            return None
        reader = spark.read if schema is None else spark.read.schema(schema)
        return latest_per_key(reader.parquet(*paths), self.key, self.ts_col, self.seq_col)


def latest_per_key(changes: DataFrame, key: str, ts_col: str, seq_col: str) -> DataFrame:
    """ST3: several changes of one key → the last one wins (by ts, then seq)."""
    return latest(changes, key, [ts_col, seq_col])


def _commit(spark: SparkSession, target: SyncTarget, after: int, entry: dict) -> int:
    """Publish a ledger entry under the first free number beyond ``after``."""
    number = after + 1
    while True:
        now = int(dt.datetime.now(dt.timezone.utc).timestamp() * 1_000_000)
        if storage.publish(spark, target.entry_path(number), json.dumps({"commit": number, "committed_us": now, **entry}) + "\n"):
            return number
        number += 1


def apply_changes(spark: SparkSession, target: SyncTarget, batch: DataFrame, epoch: int, stream: str = BATCH, state: State | None = None) -> int:
    """Commit one epoch of a stream's changes (idempotent per stream and epoch). Returns keys changed."""
    state = state or target.state(spark)
    if state.has(stream, epoch):
        return 0
    changes = latest_per_key(batch, target.key, target.ts_col, target.seq_col)
    path = os.path.join(target.root, "delta", f"{stream}-{epoch}")
    changes.write.mode("overwrite").parquet(path)
    us = F.coalesce(F.unix_micros(F.col(target.ts_col).cast("timestamp")), F.lit(NO_TIME))
    mark = F.struct(us, F.coalesce(F.col(target.seq_col).cast("bigint"), F.lit(0)))
    stats = spark.read.schema(changes.schema).parquet(path).agg(F.count("*").alias("n"), F.max(mark).alias("hw")).first()
    n = int(stats["n"])
    if n == 0:
        return 0
    _commit(spark, target, state.commit, {"stream": stream, "epoch": epoch, "kind": "delta", "path": path, "n_changes": n, "hw_us": stats["hw"][0], "hw_seq": stats["hw"][1]})
    return n


def compact(spark: SparkSession, target: SyncTarget) -> str | None:
    """Fold the base and the deltas since into a new base (None if there are no deltas since).

    The base covers the commits that were there when it began; later ones stay its deltas.
    """
    state = target.state(spark)
    if not state.deltas:
        return None
    path = os.path.join(target.root, "base", f"{state.commit}-{uuid.uuid4().hex[:8]}")
    target.current(spark, state=state).write.parquet(path)
    us, seq = state.high_water
    entry = {"stream": "base", "epoch": state.commit, "kind": "base", "path": path, "n_changes": spark.read.parquet(path).count(), "hw_us": us, "hw_seq": seq}
    _commit(spark, target, state.commit, {**entry, "upto": state.commit, "epochs": state.epochs})
    storage.replace(spark, os.path.join(target.ledger_path, "_newest"), json.dumps({"start": state.commit + 1}))
    return path


def sync_once(spark: SparkSession, target: SyncTarget, changes: DataFrame) -> int:
    """ST1: one catch-up pass over a feed: commits the changes that the target's keys haven't seen (batch form).

    A change counts if its key is new or if it comes after the key's current row, so late changes of other
    keys than those that moved the high-water mark aren't lost.
    """
    state = target.state(spark)
    have = target.current(spark, state=state)
    if have is not None:
        seen = have.select(F.col(target.key).alias("_key"), F.struct(target.ts_col, target.seq_col).alias("_seen"))
        newer = F.struct(F.col(target.ts_col), F.col(target.seq_col)) > F.col("_seen")
        changes = changes.join(seen, F.col(target.key).eqNullSafe(F.col("_key")), "left").where(F.col("_seen").isNull() | newer).drop("_key", "_seen")
    return apply_changes(spark, target, changes, state.next_epoch(BATCH), state=state)


def start_sync_stream(
    stream: DataFrame,
    target: SyncTarget,
    checkpoint_location: str,
    trigger: dict | None = None,
    query_name: str | None = None,
    compact_every: int | None = None,
    stream_id: str | None = None,
):
    """ST2/ST5: readStream → foreachBatch(delta + ledger).  Offsets live in ``checkpoint_location``.

    ``stream_id`` names the stream in the ledger; by default it follows from the checkpoint location, which
    is what makes two runs the same stream.
    """
    spark = stream.sparkSession
    name = stream_id or f"stream{zlib.crc32(checkpoint_location.encode('utf-8')):08x}"

    def each(batch_df: DataFrame, epoch_id: int):
        apply_changes(spark, target, batch_df, int(epoch_id), name)
        if compact_every and (int(epoch_id) + 1) % compact_every == 0:
            compact(spark, target)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint_location)
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(**(trigger or {"availableNow": True}))
    return w.start()


class ProgressListener:
    """Forward streaming progress to a callback: ``callback(query_name, batch_id, rows, progress_json)``.

    Replaces a polling loop: register with ``spark.streams.addListener(ProgressListener(cb).listener())``.
    """

    def __init__(self, callback):
        self.callback = callback

    def listener(self):
        from pyspark.sql.streaming import StreamingQueryListener

        cb = self.callback

        class _L(StreamingQueryListener):
            def onQueryStarted(self, event):
                pass

            def onQueryProgress(self, event):
                p = event.progress
                cb(p.name, p.batchId, p.numInputRows, p.json)

            def onQueryIdle(self, event):
                pass

            def onQueryTerminated(self, event):
                pass

        return _L()


def dedup_late(stream: DataFrame, keys: list[str], ts_col: str, delay: str) -> DataFrame:
    """ST4: drop re-delivered rows (same keys) seen within the watermark delay; rows older than the watermark are dropped as late."""
    return stream.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark(keys)
