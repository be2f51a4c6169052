"""Exact k-NN with pruning: blocks around pivots, searched in the order of what they can promise.

An index deals vectors out to their nearest pivot, and around each pivot into shells by distance; a block is
a shell, and a folder of the table.  For a probe, a block's best possible score follows from the probe's
distance to the pivot and the shell's radii (the triangle inequality), or, for dot products, from the
pivot's own product and the radius.  Search goes in rounds: every probe reads the unread blocks that promise
most, its k-th best score so far rises, and blocks that cannot reach it for a probe are never scored for it;
blocks that no probe wants are never read.  Bounds carry a slack that is far above rounding errors, so the
result is that of ``knn_topk`` over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vectors as V
from ..session import scratch_path
from . import knn

PIVOTS, SHELLS = 64, 8
SLACK = 1e-6
#: Block of the vectors that no bound holds for (non-finite ones, and zero vectors of a cosine index): always read.
UNBOUNDED = -1


@dataclass
class SearchReport:
    """Blocks and (block, probe) pairs there are, and how many of them a search read and scored."""

    blocks: int = 0
    blocks_read: int = 0
    pairs: int = 0
    pairs_scored: int = 0
    rounds: int = 0
    read: list[int] = field(default_factory=list)

    @property
    def pairs_skipped_share(self) -> float:
        return 1.0 - self.pairs_scored / self.pairs if self.pairs else 0.0


def _unit(x: np.ndarray) -> np.ndarray:
    n = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, n, out=np.zeros_like(x), where=n > 0)


@dataclass
class PivotIndex:
    """Blocks of one table for one metric; ``bounds`` has a row per block: pivot, least and greatest distance, rows."""

    spark: SparkSession
    path: str
    metric: str
    pivots: np.ndarray
    bounds: np.ndarray  # block, pivot, r_min, r_max, n

    @classmethod
    def build(cls, data: DataFrame, metric: str = "cosine", pivots: int = PIVOTS, shells: int = SHELLS) -> "PivotIndex":
        """Index ``data(id, vector)``; vectors of another length than most are left out, as in ``knn_topk``.

        Pivots are ``pivots`` vectors with the smallest hashes of their ids: a bounded, repeatable sample.
        They decide how much is pruned, not what is found.
        """
        metric = V.normalise_metric_name(metric)
        if metric not in ("cosine", "dot", "l2"):
            raise ValueError(f"unsupported metric {metric!r}")
        spark, dim = data.sparkSession, knn.detect_dim(data) or 0
        base = data.select(F.col("id").cast("string").alias("id"), F.col("vector").cast("array<float>").alias("vector")).where((F.size("vector") == dim) & (F.size("vector") > 0))
        sound = base.where(~F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
        seeds = sound.orderBy(F.xxhash64("id"), "id", "vector").limit(pivots).collect()  # bounded by the number of pivots
        centres = np.array([r["vector"] for r in seeds], np.float64).reshape(len(seeds), dim)
        if metric == "cosine":
            centres = _unit(centres)
        schema = T.StructType([*base.schema.fields, T.StructField("pivot", T.IntegerType()), T.StructField("r", T.DoubleType())])

        def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from ..functions.arrowvec import as_matrix

            for b in batches:
                x = as_matrix(b.column("vector"), np.arange(b.num_rows), dim, np.float32).astype(np.float64)
                with np.errstate(invalid="ignore", over="ignore"):
                    ok = np.isfinite(x).all(axis=1)
                    norm = np.linalg.norm(np.where(ok[:, None], x, 0.0), axis=1)
                    ok &= np.isfinite(norm) & ((norm > 0) | (metric != "cosine"))
                    y = np.where(ok[:, None], _unit(x) if metric == "cosine" else x, 0.0)
                    d = np.sqrt(np.maximum((y**2).sum(axis=1)[:, None] + (centres**2).sum(axis=1)[None] - 2 * y @ centres.T, 0.0))
                    near = d.argmin(axis=1) if len(centres) else np.zeros(len(y), int)
                    r = np.linalg.norm(y - centres[near], axis=1) if len(centres) else np.zeros(len(y))
                pivot = np.where(ok, near, UNBOUNDED)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(pivot, pa.int32()), pa.array(np.where(ok, r, 0.0))], names=schema.fieldNames())

        path = scratch_path(spark, "pivot-index")
        assigned = base.mapInArrow(assign, schema)
        assigned.write.parquet(path + "-assigned")
        assigned = spark.read.schema(schema).parquet(path + "-assigned")
        widest = F.broadcast(assigned.groupBy("pivot").agg(F.max("r").alias("widest")))  # a row per pivot
        shell = F.least(F.floor(F.coalesce(F.try_divide(F.col("r") * shells, F.col("widest")), F.lit(0.0))), F.lit(shells - 1))
        block = F.when(F.col("pivot") == UNBOUNDED, F.lit(UNBOUNDED)).otherwise(F.col("pivot") * shells + shell).cast("int")
        dealt = assigned.join(widest, "pivot").withColumn("block", block).drop("widest")
        dealt.write.partitionBy("block").parquet(path)
        stored = spark.read.schema(T.StructType([*schema.fields, T.StructField("block", T.IntegerType())])).parquet(path)
        rows = stored.groupBy("block").agg(F.first("pivot"), F.min("r"), F.max("r"), F.count(F.lit(1))).collect()  # pivots * shells + 1 at most
        bounds = np.array(sorted(tuple(r) for r in rows), np.float64).reshape(-1, 5)
        return cls(spark, path, metric, centres, bounds)

    def blocks(self) -> DataFrame:
        return self.spark.read.schema("id string, vector array<float>, pivot int, r double, block int").parquet(self.path)

    def promises(self, q: np.ndarray) -> np.ndarray:
        """[block, probe]: a score that no row of the block can exceed."""
        pivot, low, high = self.bounds[:, 1].astype(int), self.bounds[:, 2, None], self.bounds[:, 3, None]
        free = pivot == UNBOUNDED
        pivot = np.where(free, 0, pivot)
        if not len(self.pivots):
            return np.full((len(pivot), len(q)), np.inf)
        norm = np.linalg.norm(q, axis=1)
        probes = _unit(q) if self.metric == "cosine" else q
        scale = 1.0 + np.abs(self.pivots).max() + np.abs(probes).max(initial=0.0)
        if self.metric == "dot":
            best = (self.pivots @ q.T)[pivot] + high * norm[None] + SLACK * scale * scale * q.shape[1]
        else:
            d = np.sqrt(np.maximum((self.pivots**2).sum(axis=1)[:, None] + (probes**2).sum(axis=1)[None] - 2 * self.pivots @ probes.T, 0.0))[pivot]
            least = np.maximum(np.maximum(d - high, low - d) - SLACK * scale * scale * q.shape[1], 0.0)
            # knn_topk's cosine has an epsilon under the line, which draws scores towards 0: never above max(cosine, 0)
            best = np.maximum(1.0 - least**2 / 2, 0.0) + SLACK if self.metric == "cosine" else SLACK - least
        best[free] = np.inf
        return np.where(np.isfinite(best), best, np.inf)

    def search(self, probes: DataFrame, k: int = 5, first: int = 2) -> tuple[DataFrame, SearchReport]:
        """``probe_id, rank, id, score`` as ``knn_topk``, and what the search took.

        Probes are a stated query set; they and their k best so far are held on the driver, in blocks of
        ``knn.MAX_PROBE_CELLS``.  A round reads, for every probe, the ``first`` unread blocks that promise
        most (twice as many each round).
        """
        report, out = SearchReport(blocks=len(self.bounds)), None
        for ids, q in knn._probe_blocks(probes):
            part = self._search(ids, q, k, first, report)
            out = part if out is None else out.unionByName(part)
        return out, report

    def _search(self, ids: np.ndarray, q: np.ndarray, k: int, first: int, report: SearchReport) -> DataFrame:
        spark, schema = self.spark, "probe_id bigint, id string, score double, key double"
        numbers = self.bounds[:, 0].astype(int)
        if not len(ids) or not len(numbers) or q.shape[1] != (self.pivots.shape[1] if len(self.pivots) else q.shape[1]):
            return spark.createDataFrame([], schema).select("probe_id", F.lit(0).alias("rank"), "id", "score")
        promise = self.promises(q)
        order = np.argsort(-promise, axis=0, kind="stable")
        done = np.zeros(promise.shape, bool)
        kth = np.full(len(ids), -np.inf)
        found = None
        report.pairs += promise.size
        while True:
            wanted = (promise >= kth[None] - SLACK) & ~done
            if not wanted.any():
                break
            rank = np.cumsum(np.take_along_axis(wanted, order, axis=0), axis=0)
            pick = np.zeros_like(wanted)
            np.put_along_axis(pick, order, np.take_along_axis(wanted, order, axis=0) & (rank <= first), axis=0)
            # A block that is read serves every probe that knows what it has to beat and still wants it.
            pick |= wanted & (pick.any(axis=1)[:, None] & np.isfinite(kth)[None] | (self.bounds[:, 1] == UNBOUNDED)[:, None])
            active = {int(numbers[i]): np.flatnonzero(pick[i]) for i in np.flatnonzero(pick.any(axis=1))}
            part = self._scored(active, ids, q, k)
            merged = part if found is None else part.unionByName(found)
            w = Window.partitionBy("probe_id").orderBy(F.col("key").desc(), F.col("id").asc())
            path = scratch_path(spark, "pivot-top")
            merged.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).write.parquet(path)
            top = spark.read.schema(schema + ", rank int").parquet(path)
            found = top.drop("rank")
            for r in top.where(F.col("rank") == k).select("probe_id", "key").collect():  # a row per probe
                kth[np.searchsorted(ids, r["probe_id"])] = r["key"]
            done |= pick
            report.rounds, first = report.rounds + 1, 2 * first
        report.read = sorted({*report.read, *numbers[done.any(axis=1)].tolist()})
        report.blocks_read = len(report.read)
        report.pairs_scored += int(done.sum())
        return top.select("probe_id", "rank", "id", "score")

    def _scored(self, active: dict[int, np.ndarray], ids: np.ndarray, q: np.ndarray, k: int) -> DataFrame:
        """Candidates of the given blocks, each scored for the probes that want it; other folders aren't read."""
        metric = self.metric

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                block = b.column("block").to_numpy()
                for n in np.unique(block).tolist():
                    some = active[n]
                    part = b.filter(pa.array(block == n))
                    yield from knn._block_scorer(ids[some], q[some], k, metric)(iter([part]))

        rows = self.blocks().where(F.col("block").isin([int(n) for n in active]))
        return rows.select("id", "vector", "block").mapInArrow(run, knn.CANDIDATES)
