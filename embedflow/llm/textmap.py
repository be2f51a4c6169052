"""Run a per-text Python function over Arrow batches, with bounded output batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.arrowvec import built

#: Rows and bytes after which a partial output batch is handed back to Spark.
OUT_ROWS, OUT_BYTES = 2048, 4 << 20
#: White space that divides words: space, tab to carriage return.
_TO_SPACE = bytes(0x20 if 0x09 <= b <= 0x0D else b for b in range(256))


def held(columns: Iterable[str]):
    """The named columns as one struct, in which no name can clash with a new column's."""
    fields = [F.col(f"`{c}`").alias(c) for c in columns]
    return F.struct(*(fields or [F.lit(None).cast("int").alias("none")]))


def map_text(
    df: DataFrame,
    value: str,
    out: T.StructType,
    make: Callable[[], Callable[[bytes | None], tuple]],
    carry: Iterable[str],
) -> DataFrame:
    """``struct carry`` (the named columns, untouched) plus ``out``, one row per input row.

    ``make()`` runs once per task and returns ``fn(raw) -> tuple`` of ``out``'s values; raw is the value's
    bytes (UTF-8 for text) or None.  A worker needs no pandas for it.  Carried columns travel inside one struct, so none of their names can
    clash with ``out``'s.
    """
    src = df.select(held(carry).alias("carry"), F.col(f"`{value}`").alias("value"))
    schema = T.StructType([src.schema["carry"], *out.fields])
    from pyspark.sql.pandas.types import to_arrow_type

    types = [to_arrow_type(f.dataType) for f in out.fields]
    names = ["carry", *out.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            carried, raw = batch.column(0), batch.column(1).cast(pa.binary())
            done, rows, size = 0, [], 0

            def flush(upto):
                cols = [built([r[i] for r in rows], t) for i, t in enumerate(types)]
                return pa.RecordBatch.from_arrays([carried.slice(done, upto - done), *cols], names=names)

            for i in range(len(raw)):
                rows.append(row := fn(raw[i].as_py()))
                size += sum(len(x) for x in row if isinstance(x, (bytes, str, list)))
                if len(rows) >= OUT_ROWS or size >= OUT_BYTES:
                    yield flush(i + 1)
                    done, rows, size = i + 1, [], 0
            if rows:
                yield flush(len(raw))

    return src.mapInArrow(run, schema)


def ragged_index(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of the stretches ``[start, start + length)``, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def split_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bytes, ends, counts)``: all words, each with one space behind it; where each ends; words of each text."""
    buf = np.frombuffer((b" ".join(texts) + b" ").translate(_TO_SPACE), np.uint8)
    space = buf == 0x20
    closes = space.copy()
    closes[0] = False
    closes[1:] &= ~space[:-1]
    at = np.flatnonzero(closes)
    limits = np.cumsum([len(x) + 1 for x in texts])
    counts = np.diff(np.searchsorted(at, limits, "left"), prepend=0)
    if len(at) == np.count_nonzero(space):
        return buf, at + 1, counts
    kept = buf[~space | closes]
    return kept, np.flatnonzero(kept == 0x20) + 1, counts


def map_text_groups(
    df: DataFrame,
    value: str,
    out: T.StructType,
    make: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
    carry: Iterable[str],
    group_bytes: int,
) -> DataFrame:
    """As :func:`map_text`, but ``make()`` returns a function of many texts at once, giving ``out``'s columns.

    Consecutive rows of a batch go together until they have ``group_bytes``; a longer text goes alone.
    """
    src = df.select(held(carry).alias("carry"), F.col(f"`{value}`").alias("value"))
    schema = T.StructType([src.schema["carry"], *out.fields])
    names = ["carry", *out.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = make()
        for batch in batches:
            carried, raw = batch.column(0), batch.column(1).cast(pa.binary())
            done, group, size = 0, [], 0
            for i in range(len(raw)):
                x = raw[i].as_py()
                if group and size + len(x or b"") > group_bytes:
                    yield pa.RecordBatch.from_arrays([carried.slice(done, len(group)), *fn(group)], names=names)
                    done, group, size = i, [], 0
                group.append(x)
                size += len(x or b"")
            if group:
                yield pa.RecordBatch.from_arrays([carried.slice(done, len(group)), *fn(group)], names=names)

    return src.mapInArrow(run, schema)
