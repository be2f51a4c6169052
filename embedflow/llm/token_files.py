"""Token-id files: ids in blocks of canonical, length-limited Huffman codes, in ascending order of id.

A folder holds three tables.  ``code`` has the length of each token id's code, from global counts, from which
the codes follow.  ``blocks`` has the coded ids: documents in order within a range of document ids, a block
for about ``BLOCK_BYTES`` of them, decodable by itself, with the bit offset of every 256th id (checkpoints)
and the documents' own lengths.  ``ranges`` has the ids before each range; it is written last, and a folder
without it holds nothing.  All three are written and read by Spark, so tasks can be retried and any store
that Spark reads will do.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .huffman import LANE, canonical, code_lengths, decode_lanes, decoding_table, lane_counts, lane_lengths, pack

#: Coded bytes from which a block is closed, and bytes of ids or blocks that a task works on at once.
BLOCK_BYTES, GROUP_BYTES = 1 << 20, 4 << 20
#: Largest token id: the code table, which goes to every task, has an entry of one byte for each up to it.
MAX_ID = (1 << 22) - 1


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of a binary array without nulls, offsets from 0."""
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8), at - at[0]


def _groups(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Stretches of rows of up to ``limit`` bytes together; a larger row is one by itself."""
    begin = total = 0
    for i, n in enumerate(sizes.tolist()):
        if i > begin and total + n > limit:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(sizes):
        yield begin, len(sizes)


def _binary(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])


def _ids(ids: pa.Array, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(ids, ids of each row)`` of a column of little-endian ids; two bytes an id or four, as the rows' counts say."""
    data, offsets = _flat(ids)
    total = int(counts.sum())
    size = len(data) // total if total else 4
    return data.view(f"<u{size}"), np.diff(offsets) // size


def count_ids(tokens: DataFrame, ids: str = "ids", n_tokens: str = "n_tokens") -> DataFrame:
    """``(token_id, n)``: how often each id occurs in all rows; summed in every task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            flat, _ = _ids(batch.column(0), batch.column(1).to_numpy())
            if len(flat) and int(flat.max()) > MAX_ID:
                raise ValueError(f"token ids may go up to {MAX_ID}")
            n = np.bincount(flat, minlength=len(total))
            n[: len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["token_id", "n"])

    counted = tokens.select(ids, F.col(n_tokens).cast("bigint")).mapInArrow(run, "token_id bigint, n bigint")
    return counted.groupBy("token_id").agg(F.sum("n").alias("n"))


class TokenFiles:
    """Token-id files in a folder that driver and executors share."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(os.path.join(self.path, name))

    def write(self, tokens: DataFrame, id_col: Column | str, ids: str = "ids", n_tokens: str = "n_tokens") -> None:
        """Write the ids of all rows, in ascending order of ``id_col``.

        ids are binary, little-endian, two bytes each or four, n_tokens of them; null ids or counts count as none.
        Null document ids come first; rows of equal ids stand in the order of their content, so repeated rows
        are interchangeable and a hot id is spread over many ranges.  Rows without ids keep their place.  An
        empty table leaves files without blocks.  A row lies in one block, whatever its length.
        """
        ident = F.col(id_col) if isinstance(id_col, str) else id_col
        none = F.col(ids).isNull() | F.col(n_tokens).isNull()
        rows = tokens.select(
            ident.alias("id"),
            F.when(none, F.expr("X''")).otherwise(F.col(ids)).alias("ids"),
            F.when(none, F.lit(0)).otherwise(F.col(n_tokens)).cast("bigint").alias("n"),
            F.monotonically_increasing_id().alias("row"),
        )
        # The rows are read twice, for the counts and the codes; ids cost less to keep than to make again.
        path = os.path.join(self.path, "rows")
        rows.write.option("compression", "zstd").parquet(path)
        rows = self.spark.read.schema(rows.schema).parquet(path)
        # One row per id of the vocabulary at most.
        counted = np.array([tuple(r) for r in count_ids(rows, "ids", "n").collect()], np.int64).reshape(-1, 2)
        counts = np.zeros(int(counted[:, 0].max(initial=-1)) + 1, np.int64)
        counts[counted[:, 0]] = counted[:, 1]
        lengths = code_lengths(counts)
        code = self.spark.createDataFrame([(i, int(lengths[i]), int(counts[i])) for i in np.flatnonzero(lengths).tolist()], "token_id bigint, bits int, n bigint")
        code.coalesce(1).write.parquet(os.path.join(self.path, "code"))  # bounded as the counts are
        # Ids are moved, and coded behind the shuffle: finding the ranges reads the rows once more, without Python.
        keys = ["id", "tie", "row"]
        spread = rows.withColumn("tie", F.xxhash64("ids")).repartitionByRange(*keys).sortWithinPartitions(*keys)
        _blocks(spread, lengths).write.parquet(os.path.join(self.path, "blocks"))
        ranges = sorted(tuple(r) for r in self._table("blocks").groupBy("range").agg(F.sum("n_ids")).collect())  # one row a task
        before = np.cumsum([0, *(n for _, n in ranges)]).tolist()
        placed = [(r, n, b) for (r, n), b in zip(ranges, before)]
        self.spark.createDataFrame(placed, "range int, n_ids bigint, before bigint").coalesce(1).write.parquet(os.path.join(self.path, "ranges"))

    def _lengths(self) -> np.ndarray:
        rows = np.array([(r.token_id, r.bits) for r in self._table("code").collect()], np.int64).reshape(-1, 2)
        lengths = np.zeros(int(rows[:, 0].max(initial=-1)) + 1, np.uint8)
        lengths[rows[:, 0]] = rows[:, 1]
        return lengths

    def _placed(self) -> DataFrame:
        """The blocks, with the ids of all blocks before each one's range."""
        ranges = F.broadcast(self._table("ranges").select("range", "before"))  # one row a task that wrote blocks
        return self._table("blocks").join(ranges, "range")

    def documents(self) -> DataFrame:
        """``id, start, n_tokens`` of every document, from the index alone; no codes are read."""
        docs = F.arrays_zip("ids", "starts", "n_tokens")
        each = self._placed().select((F.col("before") + F.col("first")).alias("base"), F.explode(docs).alias("d"))
        return each.select(F.col("d.ids").alias("id"), (F.col("base") + F.col("d.starts")).alias("start"), "d.n_tokens")

    def read(self) -> DataFrame:
        """``id, start, n_tokens, ids`` of every document: the ids before its own, and its ids (little-endian, four bytes)."""
        lengths = self._lengths()
        blocks = self._placed().select("ids", "n_tokens", "checkpoints", "payload", (F.col("before") + F.col("first")).alias("first"))
        ident = blocks.schema["ids"].dataType.elementType
        schema = T.StructType([T.StructField("id", ident), *(T.StructField(c, T.LongType()) for c in ("start", "n_tokens")), T.StructField("ids", T.BinaryType())])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, bits = decoding_table(lengths)
            for batch in batches:
                for part in _cut(batch, "payload"):
                    counts = part.column("n_tokens").flatten().to_numpy()
                    data, base = _flat(part.column("payload"))
                    marks = _checkpoints(part, base)
                    decoded = decode_lanes(data, marks, lane_lengths(counts), table, bits)
                    docs = part.column("n_tokens").value_lengths().to_numpy()
                    first = np.repeat(part.column("first").to_numpy(), docs)
                    starts = first + _within(counts, docs)
                    yield from _sized([part.column("ids").flatten(), pa.array(starts), pa.array(counts)], decoded, counts)

        return blocks.mapInArrow(run, schema)

    def window(self, first: int, count: int) -> DataFrame:
        """``(first, ids)``: the ids from place ``first`` on, ``count`` of them, in pieces, one a block.

        Only blocks that meet the window are decoded, and of these only from the checkpoint before it on.
        """
        lengths = self._lengths()
        at = F.col("before") + F.col("first")
        blocks = self._placed().where((at < first + count) & (at + F.col("n_ids") > first)).select("n_tokens", "checkpoints", "payload", at.alias("first"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, bits = decoding_table(lengths)
            for batch in batches:
                for i in range(batch.num_rows):
                    part = batch.slice(i, 1)
                    data, base = _flat(part.column("payload"))
                    size = lane_lengths(part.column("n_tokens").flatten().to_numpy())
                    start = part.column("first")[0].as_py()
                    begins = start + np.cumsum(size) - size
                    lanes = np.flatnonzero((begins < first + count) & (begins + size > first))
                    got = decode_lanes(data, _checkpoints(part, base)[lanes], size[lanes], table, bits)
                    lo, begin = max(first, start), int(begins[lanes[0]])
                    got = got[lo - begin : first + count - begin]
                    yield pa.RecordBatch.from_arrays([pa.array([lo]), _binary(got.view(np.uint8), np.array([4 * len(got)]))], names=["first", "ids"])

        return blocks.mapInArrow(run, "first bigint, ids binary")


def _within(counts: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Ids before each document in its own block; docs are the blocks' numbers of documents."""
    before = np.concatenate([[0], np.cumsum(counts)])
    stop = np.cumsum(docs)
    return before[:-1] - np.repeat(before[stop - docs], docs)


def _cut(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    _, at = _flat(batch.column(column))
    for a, b in _groups(np.diff(at), GROUP_BYTES):
        yield batch.slice(a, b - a)


def _sized(columns: list[pa.Array], ids: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    cuts = np.concatenate([[0], np.cumsum(counts)])
    for a, b in _groups(4 * counts, 4 * GROUP_BYTES):
        binary = _binary(ids[cuts[a] : cuts[b]].view(np.uint8), 4 * counts[a:b])
        yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in columns), binary], names=["id", "start", "n_tokens", "ids"])


def _checkpoints(part: pa.RecordBatch, base: np.ndarray) -> np.ndarray:
    """Bit offsets of all lanes of the part's blocks in their joined payloads."""
    data, at = _flat(part.column("checkpoints"))
    return data.view("<u8").astype(np.int64) + np.repeat(8 * base[:-1], np.diff(at) // 8)


def _blocks(spread: DataFrame, lengths: np.ndarray) -> DataFrame:
    """Blocks of the documents of every partition, in their order; every document's codes begin at a byte."""
    ident = T.ArrayType(spread.schema["id"].dataType)
    schema = T.StructType(
        [
            T.StructField("range", T.IntegerType()),
            T.StructField("block", T.IntegerType()),
            *(T.StructField(c, T.LongType()) for c in ("first", "n_ids")),
            T.StructField("ids", ident),
            *(T.StructField(c, T.ArrayType(T.LongType())) for c in ("n_tokens", "starts")),
            *(T.StructField(c, T.BinaryType()) for c in ("checkpoints", "payload")),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        codes, _ = canonical(lengths)
        here, block, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for part in _cut(batch, "ids"):
                counts = part.column("n").to_numpy()
                flat, _ = _ids(part.column("ids"), counts)
                data, sizes, part_bits = pack(flat, counts, codes, lengths)
                at = np.concatenate([[0], np.cumsum(sizes)])
                lane_at = np.concatenate([[0], np.cumsum(lane_counts(counts))])
                for a, b in _groups(sizes, BLOCK_BYTES):
                    n = counts[a:b]
                    lane_bits = part_bits[lane_at[a] : lane_at[b]].astype(np.int64)
                    marks = np.cumsum(lane_bits) - lane_bits
                    lanes = lane_counts(n)
                    some = np.flatnonzero(lanes)
                    begin = (np.cumsum(lanes) - lanes)[some]  # documents begin at a byte
                    marks += np.repeat(8 * (at[a:b][some] - at[a]) - marks[begin], lanes[some])
                    arrays = [pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), x) for x in (part.column("id").slice(a, b - a), pa.array(n), pa.array(np.cumsum(n) - n))]
                    total = int(n.sum())
                    numbers = [pa.array([here], pa.int32()), pa.array([block], pa.int32()), pa.array([first]), pa.array([total])]
                    payload = data[at[a] : at[b]]
                    yield pa.RecordBatch.from_arrays(
                        [*numbers, *arrays, _binary(marks.astype("<u8").view(np.uint8), np.array([8 * len(marks)])), _binary(payload, np.array([len(payload)]))],
                        names=schema.fieldNames(),
                    )
                    block, first = block + 1, first + total

    return spread.select("id", "n", "ids").mapInArrow(run, schema)
