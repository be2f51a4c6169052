"""Benchmark decontamination: a prefix-filtered containment join of item windows with documents.

A window is ``WINDOW`` consecutive words of an item (an item of fewer words is one window).  A document
contains a window if it contains all the window's shingles at their places, so with the shingles ordered
by rarity over the whole corpus, the necessary prefix is one shingle: the rarest.  Only documents that
hold it are candidates, at the one start its offset gives; starts that leave no room for the window
before the text's beginning or past its end are dropped, and the rest are compared word by word.

The window index is made in blocks of bounded size.  Each block is collected, indexed and broadcast, and
run against all documents; a benchmark of more than one block takes as many passes, each of which is
written to the shared scratch folder so that one block at a time is in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import written
from .textmap import held, map_text

WINDOW, SHINGLE = 13, 5
#: Windows (with one item each) in a block that is broadcast: some 50 MB.
BLOCK_ROWS = 100_000
#: A document is contaminated from this share of hit words on: one in so many.
ONE_IN = 20
#: Candidate places compared at a time.
CHUNK = 1 << 16

_DELIMITERS = bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80))
_FOLD = bytes.maketrans(
    _DELIMITERS + bytes(range(0x41, 0x5B)), b" " * len(_DELIMITERS) + bytes(range(0x61, 0x7B))
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(raw: bytes | None) -> list[bytes]:
    """Words of UTF-8 text: A-Z lower-cased, runs of digits, letters and anything beyond ASCII.  Null: none."""
    return raw.translate(_FOLD).split() if raw else []


def _windows(items: DataFrame, id_col: str, text: str, window: int) -> DataFrame:
    """Distinct ``(item, words)``: every window of every item."""

    def make():
        def one(raw):
            w = words(raw)
            n = len(w)
            return ([b" ".join(w[i : i + window]) for i in range(max(1, n - window + 1))] if n else [],)

        return one

    out = T.StructType([T.StructField("windows", T.ArrayType(T.BinaryType()))])
    cut = map_text(items, text, out, make, [id_col])
    return cut.select(F.col(f"carry.`{id_col}`").cast("string").alias("item"), F.explode("windows").alias("words")).distinct()


class _Block:
    """Index of a block of windows: vocabulary, windows as word numbers, and shingles by length."""

    def __init__(self, rows: pa.Table, shingle: int):
        by_words: dict[bytes, list[str]] = {}
        for item, w in zip(rows["item"].to_pylist(), rows["words"].to_pylist()):
            own = by_words.setdefault(w, [])
            if item is not None:
                own.append(item)
        self.items = list(by_words.values())
        self.vocab: dict[bytes, int] = {}
        number = lambda x: self.vocab.setdefault(x, len(self.vocab) + 1)
        self.windows = [np.array([number(x) for x in w.split(b" ")], dtype=np.int64) for w in by_words]
        self.lengths = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.shingle = shingle

    def shingles(self) -> Iterator[tuple[int, int, np.ndarray]]:
        for i, w in enumerate(self.windows):
            s = min(self.shingle, len(w))
            yield i, s, hashes(w, s)

    def wanted(self) -> dict[int, np.ndarray]:
        """Sorted shingle hashes of the block's windows, by shingle length."""
        out: dict[int, list[np.ndarray]] = {}
        for _, s, h in self.shingles():
            out.setdefault(s, []).append(h)
        return {s: np.unique(np.concatenate(h)) for s, h in out.items()}

    def prefixes(self, count: dict[tuple[int, int], int]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """By shingle length: sorted hashes of the windows' rarest shingles, with window and offset of each."""
        out: dict[int, list[tuple[int, int, int]]] = {}
        for i, s, h in self.shingles():
            values = h.tolist()
            at = min(range(len(values)), key=lambda j: (count.get((s, values[j]), 0), values[j], j))
            if count.get((s, values[at]), 0):  # a window with a shingle that occurs nowhere occurs nowhere
                out.setdefault(s, []).append((values[at], i, at))
        made = {}
        for s, found in out.items():
            found.sort()
            made[s] = (np.array([x[0] for x in found], dtype=np.uint64), np.array([x[1] for x in found]), np.array([x[2] for x in found]))
        return made


def hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word numbers (equal runs have equal hashes)."""
    n = len(ids) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        h = (h ^ ids[i : i + n].astype(np.uint64)) * _MIX
        h ^= h >> np.uint64(29)
    return h


def _numbers(raw: bytes | None, vocab: dict[bytes, int]) -> np.ndarray:
    w = words(raw)
    get = vocab.get
    return np.fromiter((get(x, 0) for x in w), dtype=np.int64, count=len(w))


def _known(ids: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of ``size`` words that are all in the vocabulary."""
    total = np.concatenate(([0], np.cumsum(ids > 0)))
    return np.nonzero(total[size:] - total[:-size] == size)[0] if len(ids) >= size else np.zeros(0, dtype=np.int64)


def _present(ids: np.ndarray, size: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a document's shingles that are among the sorted ``wanted``."""
    at = _known(ids, size)
    if not len(at) or not len(wanted):
        return at[:0], np.zeros(0, dtype=np.uint64)
    h = hashes(ids, size)[at]
    k = np.searchsorted(wanted, h)
    hit = wanted[np.minimum(k, len(wanted) - 1)] == h
    return at[hit], h[hit]


def _occurrences(ids: np.ndarray, block: _Block, prefixes: dict) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Exact occurrences in a document: starts and windows, some at a time."""
    for size, (keys, window, offset) in prefixes.items():
        at, h = _present(ids, size, keys)
        low, high = np.searchsorted(keys, h, "left"), np.searchsorted(keys, h, "right")
        for a in range(0, len(at), CHUNK // 16):
            part = slice(a, a + CHUNK // 16)
            many = high[part] - low[part]
            # a common shingle may be the prefix of many windows
            for b in range(0, int(many.max(initial=0)), 16):
                some = np.clip(many - b, 0, 16)
                row = np.repeat(np.arange(len(many)), some)
                k = low[part][row] + b + np.arange(len(row)) - np.repeat(np.cumsum(some) - some, some)
                w, start = window[k], at[part][row] - offset[k]
                fits = (start >= 0) & (start + block.lengths[w] <= len(ids))
                w, start = w[fits], start[fits]
                for length in np.unique(block.lengths[w]):
                    of = block.lengths[w] == length
                    there = np.stack([block.windows[i] for i in w[of]])
                    same = (ids[start[of][:, None] + np.arange(length)] == there).all(axis=1)
                    if same.any():
                        yield start[of][same], w[of][same]


def _merge(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [{"start": a, "end": b} for a, b in out]


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def _frequencies(docs: DataFrame, text: str, block) -> dict[tuple[int, int], int]:
    """How often each of the block's shingles occurs in all documents (at most as many rows as it has shingles)."""

    def count(batches):
        index, wanted = block.value
        totals = {s: np.zeros(len(w), dtype=np.int64) for s, w in wanted.items()}
        for batch in batches:
            raw = batch.column(0).cast(pa.binary())
            for i in range(len(raw)):
                ids = _numbers(raw[i].as_py(), index.vocab)
                for s, keys in wanted.items():
                    _, h = _present(ids, s, keys)
                    np.add.at(totals[s], np.searchsorted(keys, h), 1)
        for s, t in totals.items():
            some = np.nonzero(t)[0]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s), pa.int32()), pa.array(wanted[s][some].view(np.int64)), pa.array(t[some])], names=["size", "h", "n"])

    counted = docs.select(F.col(f"`{text}`").cast("string").alias("t")).mapInArrow(count, "size int, h bigint, n bigint")
    total = counted.groupBy("size", "h").agg(F.sum("n").alias("n")).toArrow()
    return {(s, h % (1 << 64)): n for s, h, n in zip(*(total[c].to_pylist() for c in ("size", "h", "n")))}


def hit_spans(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    carry: list[str] | None = None,
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``struct carry``, ``n_words``, ``spans`` and ``items`` of every row of ``docs``.

    spans are the word ranges (end exclusive) inside occurrences of any window, merged within a block, and items the sorted
    distinct ids (as strings) of the items whose windows occur.  Null and empty texts have no words and
    hit nothing; an item without words has no window; an item with a null id hits words but isn't listed;
    repeated items count once, repeated documents stay repeated; with an empty ``items`` nothing is hit.
    """
    spark = docs.sparkSession
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    rows = written(_windows(items, item_id, item_text, window), "windows")
    blocks = max(1, -(-rows.count() // block_rows))

    def prefixes(b: int):
        part = rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == b)
        index = _Block(part.toArrow(), shingle)
        wanted = spark.sparkContext.broadcast((index, index.wanted()))
        return spark.sparkContext.broadcast((index, index.prefixes(_frequencies(docs, text, wanted))))

    if blocks == 1:
        return _pass(docs, text, prefixes(0), carry)
    state = docs.select(held(carry).alias("held"), F.col(f"`{text}`").alias("text"), *[F.array().cast(t).alias(n) for n, t in (("spans", SPANS), ("items", "array<string>"))])
    for b in range(blocks):
        found = _pass(state, "text", prefixes(b), ["held", "text", "spans", "items"])
        both = [F.concat("carry.spans", "spans").alias("spans"), F.array_sort(F.array_union("carry.items", "items")).alias("items")]
        state = written(found.select("carry.held", "carry.text", "n_words", *both), "block")
    return state.select(F.col("held").alias("carry"), "n_words", "spans", "items")


def _pass(docs: DataFrame, text: str, block, carry: list[str]) -> DataFrame:
    def make():
        index, prefixes = block.value

        def one(raw):
            ids = _numbers(raw, index.vocab)
            spans: set[tuple[int, int]] = set()
            found: set[int] = set()
            if prefixes and ids.any():
                for starts, windows in _occurrences(ids, index, prefixes):
                    spans.update(zip(starts.tolist(), (starts + index.lengths[windows]).tolist()))
                    found.update(windows.tolist())
            return len(ids), _merge(list(spans)), sorted({x for w in found for x in index.items[w]})

        return one

    out = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS), T.StructField("items", T.ArrayType(T.StringType()))])
    return map_text(docs, text, out, make, carry)


def judged(hits: DataFrame, one_in: int = ONE_IN) -> DataFrame:
    """``n_hit``, ``n_items``, ``items_sha256`` and ``contaminated`` beside the columns of :func:`hit_spans`."""
    none = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("upto"))
    grown = F.aggregate(  # spans from several blocks may overlap
        F.array_sort("spans"),
        none,
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0).cast("bigint"), x["end"] - F.greatest(x["start"], acc["upto"]))).alias("n"),
            F.greatest(acc["upto"], x["end"]).alias("upto"),
        ),
    )
    n_hit = grown["n"]
    return hits.withColumns(
        {"n_hit": n_hit, "n_items": F.size("items").cast("bigint"), "items_sha256": F.sha2(F.array_join("items", ","), 256)}
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(one_in) * F.col("n_hit") >= F.col("n_words")))


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", **settings) -> DataFrame:
    """The documents that aren't contaminated, with their columns."""
    found = judged(hit_spans(docs, items, text, item_id, carry=docs.columns, **settings))
    return found.where(~F.col("contaminated")).select(*[F.col(f"carry.`{c}`").alias(c) for c in docs.columns])
