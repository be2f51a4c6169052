"""Vector codes: product quantisation in whole numbers, with a GNAT over every codebook's entries.

Components become integers, vectors are cut into equal parts, and each part position has a codebook that some
rounds of exact integer k-means refine.  The nearest entry of a part is searched in a GNAT (geometric near-
neighbour access tree): a node's split points are entries, every other entry is a child of its nearest split
point, and for each child and each split point the node stores the least and the greatest distance between
them.  A query that knows its distances to the split points drops a child as a whole if the triangle
inequality puts all of it strictly beyond the best entry so far.  Distances for that are square roots, rounded
so that they can only keep too much; what is left is compared by exact squared integers, ties by index.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import join_totals, written

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: Split points of a node; a node of no more entries is a leaf.
DEGREE = 4
#: Relative error that square roots of squared distances are allowed, far above what they have.
SLACK = 1e-9
#: Sums travel in limbs of so many bits, so that Spark's 64-bit sums of them stay exact.
LIMB, LIMBS = 40, 5
#: Rows that a task works on at once.
GROUP_ROWS = 4096


def integers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x), exactly: 64-bit where they are small enough for squared distances, else Python's integers."""
    y = np.floor(x.astype(np.float64) * SCALE)
    if not y.size or _fits(float(np.abs(y).max()), y.shape[-1]):
        return y.astype(np.int64)
    return np.array([int(v) for v in y.ravel()], object).reshape(y.shape)


def _fits(top: float, width: int) -> bool:
    """Do sums of ``width`` squared differences of numbers up to ``top`` fit 63 bits?"""
    return 4.0 * top * top * max(width, 1) < 2.0**62


def _common(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    top = max((float(max(abs(int(x.max())), abs(int(x.min())))) for x in (a, b) if x.size), default=0.0)
    kind = np.int64 if _fits(top, a.shape[-1]) else object
    return a.astype(kind), b.astype(kind)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of every row of a to the vector b."""
    d = a - b
    return (d * d).sum(axis=1)


class Gnat:
    """A GNAT over the rows of ``entries`` (integers)."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries = entries
        self.root = self._node(np.arange(len(entries)), degree)

    def _node(self, members: np.ndarray, degree: int):
        """``(splits, children, low, high)``: entries, nodes, and bounds of roots [split, child] in between."""
        if not len(members):
            return None
        splits = [0]  # far apart: each next one is the farthest from those before it
        near = squared(self.entries[members], self.entries[members[0]])
        to = [near]
        while len(splits) < min(degree, len(members)):
            left = [k for k in range(len(members)) if k not in splits]
            k = max(left, key=lambda k: (near[k], -k))
            splits.append(k)
            to.append(squared(self.entries[members], self.entries[members[k]]))
            near = np.minimum(near, to[-1])
        to = np.array(to)
        owner = np.array([min(range(len(splits)), key=lambda s: (to[s][k], s)) for k in range(len(members))])
        rest = np.ones(len(members), bool)
        rest[splits] = False
        groups = [np.flatnonzero(rest & (owner == s)) for s in range(len(splits))]
        root = np.sqrt(to.astype(np.float64))
        low = np.array([[root[s][g].min() if len(g) else np.inf for g in groups] for s in range(len(splits))]) * (1 - SLACK)
        high = np.array([[root[s][g].max() if len(g) else 0.0 for g in groups] for s in range(len(splits))]) * (1 + SLACK)
        children = [self._node(members[g], degree) for g in groups]
        return members[splits], children, low, high

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """``(index, squared distance, distances computed)`` of each query's nearest entry; ties: the lower index."""
        queries, entries = _common(queries, self.entries)
        best = np.full(len(queries), -1, np.int64)
        least = np.zeros(len(queries), queries.dtype)
        computed = 0

        def visit(node, rows):
            nonlocal computed
            splits, children, low, high = node
            own = queries[rows]
            roots = []
            for s in splits.tolist():
                d = squared(own, entries[s])
                computed += len(rows)
                closer = (best[rows] < 0) | (d < least[rows]) | ((d == least[rows]) & (s < best[rows]))
                best[rows[closer]] = s
                least[rows[closer]] = d[closer]
                roots.append(np.sqrt(d.astype(np.float64)))
            for j, child in enumerate(children):
                if child is None:
                    continue
                reach = np.sqrt(least[rows].astype(np.float64)) * (1 + SLACK)
                alive = np.ones(len(rows), bool)
                for s, root in enumerate(roots):  # |d(q, split) - d(split, entry)| > reach: strictly beyond
                    alive &= (root * (1 - SLACK) - high[s, j] <= reach) & (low[s, j] - root * (1 + SLACK) <= reach)
                if alive.any():
                    visit(child, rows[alive])

        if self.root is not None and len(queries):
            visit(self.root, np.arange(len(queries)))
        return best, least, computed


class Codebooks:
    """A codebook per part position: lists of entries, each a tuple of Python integers."""

    def __init__(self, books: list[list[tuple[int, ...]]]):
        self.books = books

    def searchers(self) -> list[Gnat]:
        out = []
        for book in self.books:
            entries = np.array(book, object).reshape(len(book), -1)
            top = max((abs(v) for e in book for v in e), default=0)
            out.append(Gnat(entries.astype(np.int64) if _fits(float(top), entries.shape[1]) else entries))
        return out

    def sha256(self) -> str:
        numbers = (str(v) for book in self.books for entry in book for v in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def part_width(dimension: int, parts: int) -> int:
    """Components of a part: zeros fill up vectors that don't divide evenly."""
    return -(-dimension // parts)


def _parts(x: np.ndarray, parts: int) -> list[np.ndarray]:
    """The integers of each part of the rows of x."""
    width = part_width(x.shape[1], parts)
    padded = np.zeros((len(x), width * parts), x.dtype)
    padded[:, : x.shape[1]] = x
    return [integers(padded[:, k * width : (k + 1) * width]) for k in range(parts)]


def _matrix(col: pa.Array, dimension: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dimension)


def kept_vectors(vectors: DataFrame, id_col: str, vector: str, label: Column) -> DataFrame:
    """``id, label, v, size`` of the rows whose vector is there, without null or non-finite components."""
    src = vectors.select(F.col(f"`{id_col}`").alias("id"), label.alias("label"), F.col(f"`{vector}`").cast("array<float>").alias("v"))
    schema = T.StructType([*src.schema.fields, T.StructField("size", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = batch.column("v")
            flat = v.flatten()
            bad = ~np.isfinite(flat.fill_null(np.nan).to_numpy(zero_copy_only=False))
            size = v.value_lengths().fill_null(0).to_numpy()
            count = np.concatenate([[0], np.cumsum(bad)])
            stop = np.cumsum(size)
            keep = pa.array((count[stop] == count[stop - size]) & v.is_valid().to_numpy(zero_copy_only=False))
            out = [batch.column(c).filter(keep) for c in ("id", "label", "v")] + [pa.array(size.astype(np.int32)).filter(keep)]
            yield pa.RecordBatch.from_arrays(out, names=schema.fieldNames())

    return src.mapInArrow(run, schema)


def _limbs(total: int) -> Iterator[tuple[int, int]]:
    sign, total, k = (-1 if total < 0 else 1), abs(total), 0
    while total:
        yield k, sign * (total & ((1 << LIMB) - 1))
        total, k = total >> LIMB, k + 1


def _refined(kept: DataFrame, books: Codebooks, dimension: int) -> Codebooks:
    """One round: every part goes to its nearest entry; each entry that is used becomes the floor of its parts' mean.

    A task adds up its own parts first; what is shuffled and collected is bounded by the codebooks' size.
    """
    parts, width = len(books.books), part_width(dimension, len(books.books))
    entries = max(len(b) for b in books.books)
    cell = lambda part, entry, place, limb: ((part * entries + entry) * (width + 1) + place) * LIMBS + limb

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.searchers()
        sums = np.zeros((parts, entries, width + 1), object)  # last place: the count
        for batch in batches:
            for i in range(0, batch.num_rows, GROUP_ROWS):
                for p, x in enumerate(_parts(_matrix(batch.column("v").slice(i, GROUP_ROWS), dimension), parts)):
                    near, _, _ = trees[p].nearest(x)
                    for e in np.unique(near).tolist():
                        mine = x[near == e]
                        sums[p, e, :width] += mine.sum(axis=0).astype(object)
                        sums[p, e, width] += len(mine)
        rows = [(cell(p, e, k, limb), v) for (p, e, k), total in np.ndenumerate(sums) for limb, v in _limbs(int(total))]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in (0, 1)], names=["cell", "amount"])

    found = kept.select("v").mapInArrow(run, "cell bigint, amount bigint").groupBy("cell").agg(F.sum("amount").alias("amount"))
    total = np.zeros((parts, entries, width + 1), object)
    for c, amount in found.collect():
        place, limb = divmod(c, LIMBS)
        total.flat[place] += amount << (LIMB * limb)
    new = []
    for p, book in enumerate(books.books):
        new.append([tuple(int(s) // int(total[p, e, width]) for s in total[p, e, :width]) if total[p, e, width] else entry for e, entry in enumerate(book)])
    return Codebooks(new)


def fit_codebooks(kept: DataFrame, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks of :func:`kept_vectors` of one dimension, refined over all rows in every round.

    They start as the parts of the rows with the smallest ids, ascending (equal ids: by vector; null ids last).
    """
    first = kept.select("id", "v").orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    x = np.array([r.v for r in first], np.float32).reshape(len(first), dimension)
    books = Codebooks([[tuple(int(v) for v in row) for row in part] for part in _parts(x, parts)])
    for _ in range(rounds):
        books = _refined(kept, books, dimension)
    return books


def coded(kept: DataFrame, books: Codebooks, dimension: int) -> DataFrame:
    """``id, label, code, error``: the entries' indexes, two hex digits each, and the summed squared distances.

    Vectors of another length have no code and no error; an error beyond 63 bits is null.
    """
    parts = len(books.books)
    schema = T.StructType([*(kept.schema[c] for c in ("id", "label")), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = books.searchers()
        for batch in batches:
            same = pa.array(batch.column("size").to_numpy() == dimension)
            for part in (batch.filter(same), batch.filter(pc.invert(same))):
                for i in range(0, part.num_rows, GROUP_ROWS):
                    some = part.slice(i, GROUP_ROWS)
                    code = error = [None] * some.num_rows
                    if part.column("size")[0].as_py() == dimension:
                        found = [t.nearest(x)[:2] for t, x in zip(trees, _parts(_matrix(some.column("v"), dimension), parts))]
                        digits = np.stack([near for near, _ in found], axis=1).astype(np.uint8)
                        code = [row.tobytes().hex() for row in digits]
                        error = [e if e < 1 << 63 else None for e in map(int, sum(d.astype(object) for _, d in found))]
                    yield pa.RecordBatch.from_arrays([some.column("id"), some.column("label"), pa.array(code, pa.string()), pa.array(error, pa.int64())], names=schema.fieldNames())

    return kept.mapInArrow(run, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks]:
    """``(id, label, code, error, label_error)`` of all rows with a usable vector, and the codebooks.

    Rows whose vector is null or has null or non-finite components are left out.  Components are taken as
    32-bit floats.  The dimension is that of most vectors (ties: the greater); vectors of another length,
    empty ones among them, stay without code and error.  Dimensions that ``parts`` does not divide are filled
    up with zeros.  With fewer rows than entries the codebooks are smaller.  label_error sums the errors of
    equal labels, null labels together (null beyond 63 bits, or if no row has an error).  Repeated rows each
    count; nearest entries that tie go by index.  An empty table gives an empty one and empty codebooks.
    Other columns are ignored, whatever their names.
    """
    if entries > 256:
        raise ValueError("codes have two hex digits a part: 256 entries at most")
    kept = written(kept_vectors(vectors, id_col, vector, F.col(f"`{label}`")), "vectors")
    sizes = kept.where("size > 0").groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), F.desc("size")).limit(1).collect()
    dimension = most[0]["size"] if most else 0
    if dimension:
        books = fit_codebooks(kept.where(F.col("size") == dimension), dimension, parts, entries, rounds)
    else:
        books = Codebooks([[] for _ in range(parts)])
    if dimension:
        codes = coded(kept, books, dimension)
    else:
        codes = kept.select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    codes = written(codes, "codes")
    exact = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = codes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), exact.try_cast("bigint").alias("label_error"))
    return join_totals(codes, totals, ["label"], "n").select("id", "label", "code", "error", "label_error"), books
