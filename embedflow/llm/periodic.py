"""Periodic runs of words, found with string synchronising sets.

A run is a maximal stretch of words with smallest period q that is at least ``REPEATS`` times q, and
``MIN_WORDS``, long.  At every dyadic scale t a set of positions is selected by hash: i is in the set if the
least hash of the t-word windows that start in [i, i + t] is that at i or at i + t; windows that are highly
periodic themselves (period up to t / 4) don't take part.  Whether i is selected depends on the 2t words from
i alone, and every stretch that isn't highly periodic has a selected position among any t.  So in a run of
period q in [t, 2t) some selected position of its first t meets its next equal context exactly q words on:
neighbours among equal contexts propose all such periods.  Proposals are verified on the words themselves.
What is highly periodic at a scale is known from the scales below it, and the periods below the first scale
are found by comparing words 1, 2 and 3 apart.

Many texts go through together, as one sequence with a unique separator after each; texts of fewer words than
a scale's shortest run drop out of it.  Contexts are compared by 64-bit hashes: an accidental equality could
hide a run (it can't make one up), at odds below 1e-6 for a text of a million words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_text_groups, ragged_index, split_words

#: A run has so many words at least, and so many times its period.  The method needs four times.
MIN_WORDS, REPEATS = 6, 4
#: The first scale; periods below it are found directly.
FIRST = 4
#: Bytes of text that are worked on together, in one task; a longer text is worked on alone.
GROUP_BYTES = 4 << 20
_EXCLUDED = np.uint64(1 << 63)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit mixing of every element."""
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def _stretches(same: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends (exclusive) of the stretches of true."""
    edge = np.diff(same.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def _small_periods(w: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """``(start, end, period)`` of the runs with periods below ``FIRST``, by comparing words that far apart."""
    ones = np.concatenate([[0], np.cumsum(w[:-1] == w[1:])])
    for q in range(1, FIRST):
        if len(w) < REPEATS * q:
            return
        a, b = _stretches(w[:-q] == w[q:])
        long = b - a >= (REPEATS - 1) * q
        a, b = a[long], b[long] + q
        if q > 1:  # 2 and 3 are prime: a smaller period of so long a stretch is 1
            proper = ones[b - 1] - ones[a] < b - 1 - a
            a, b = a[proper], b[proper]
        yield from zip(a.tolist(), b.tolist(), [q] * len(a))


def _extended(w: np.ndarray, i: int, known: int, d: int) -> tuple[int, int]:
    """The maximal stretch with period d around words [i, i + known), which are equal to those d further on."""
    left, size = i, 32
    while left:
        begin = max(0, left - size)
        differ = np.flatnonzero(w[begin:left] != w[begin + d : left + d])
        if len(differ):
            left = begin + int(differ[-1]) + 1
            break
        left, size = begin, 2 * size
    right, size = i + known, 32
    last = len(w) - d
    while right < last:
        stop = min(last, right + size)
        differ = np.flatnonzero(w[right:stop] != w[right + d : stop + d])
        if len(differ):
            right += int(differ[0])
            break
        right, size = stop, 2 * size
    return left, right + d


def synchronising_set(h: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Selected positions, ascending.  h[i] hashes the t words from i; periodic says which are highly periodic."""
    phi = np.where(periodic, _EXCLUDED, h >> np.uint64(1))
    least, width = phi, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:-1], least[1:])  # over t + 1 windows
    at = (phi[: len(least)] == least) | (phi[t : t + len(least)] == least)
    return np.flatnonzero(at & (least != _EXCLUDED))


def _scale(w: np.ndarray, h: np.ndarray, context: np.ndarray, t: int, found: list) -> Iterator[tuple[int, int, int]]:
    """Runs with periods in [t, 2t).  h and context hash t and 2t words; found has the runs of smaller periods."""
    step = np.zeros(len(h) + 1, np.int32)
    for a, b, q in found:
        if 4 * q <= t <= b - a and a < len(h):
            step[a] += 1
            step[min(b - t + 1, len(h))] -= 1
    chosen = synchronising_set(h, t, np.cumsum(step[:-1]) > 0)
    chosen = chosen[chosen < len(context)]
    key = context[chosen]
    order = np.argsort(key, kind="stable")  # positions stay ascending within a context
    here, key = chosen[order], key[order]
    d = here[1:] - here[:-1]
    i = here[:-1]
    # The first selected position of a run has t words 2d on, too, that are equal to those d on.
    ok = (key[1:] == key[:-1]) & (d >= t) & (d < 2 * t) & (i + 2 * d < len(h))
    i, d = i[ok], d[ok]
    ok = h[i + d] == h[i + 2 * d]
    i, d = i[ok], d[ok]
    order = np.lexsort((i, d))
    last_d = covered = -1
    for i, d in zip(i[order].tolist(), d[order].tolist()):
        if d == last_d and i < covered:
            continue
        if not np.array_equal(w[i : i + 2 * t], w[i + d : i + d + 2 * t]):
            continue  # hashes that are equal by accident
        a, b = _extended(w, i, 2 * t, d)
        last_d, covered = d, b - d
        if b - a >= REPEATS * d and not _divided(w, a, d):
            yield a, b, d


def _divided(w: np.ndarray, a: int, d: int) -> bool:
    """Does the d words' block at a consist of copies of a shorter one?"""
    return any(d % r == 0 and np.array_equal(w[a : a + d - d // r], w[a + d // r : a + d]) for r in range(2, d + 1))


def find_runs(w: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, end, period)`` of all runs of the texts in ``w``.

    w has the word numbers of all texts, longest text first, each followed by a number that occurs once;
    lengths are the texts' numbers of words, descending.
    """
    found = list(_small_periods(w))
    ends = np.cumsum(lengths + 1)
    t, h = 1, _mixed(w.astype(np.uint64) + np.uint64(1))
    longest = int(lengths[0]) if len(lengths) else 0
    while REPEATS * t <= longest:
        if t >= FIRST:
            texts = int(np.searchsorted(-lengths, -REPEATS * t, "right"))
            size = int(ends[texts - 1])
            w, h = w[:size], h[: max(size - t + 1, 0)]
        context = _mixed(h[:-t] * np.uint64(0xD6E8FEB86659FD93) + h[t:])
        if t >= FIRST:
            found += list(_scale(w, h, context, t, found))
        t, h = 2 * t, context
    return [r for r in found if r[1] - r[0] >= MIN_WORDS]


def runs_of_texts(texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray], list[bytes]]:
    """``(words, runs, collapsed)`` of every text.

    runs has a row ``start, length, period`` for each, by start and then period; collapsed is the text's
    words, joined by single spaces, without those that a run has after its first period.
    """
    data, ends, counts = split_words(texts)
    words = len(ends)
    offsets = np.concatenate([[0], ends])
    array = pa.LargeBinaryArray.from_buffers(pa.large_binary(), words, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)])
    number = array.dictionary_encode().indices.to_numpy().astype(np.int64) if words else np.zeros(0, np.int64)
    first = np.cumsum(counts) - counts
    order = np.argsort(-counts, kind="stable")
    lengths = counts[order]
    begins = np.cumsum(lengths + 1) - (lengths + 1)
    w = np.empty(words + len(texts), np.int64)
    slot = ragged_index(begins, lengths)
    w[slot] = number[ragged_index(first[order], lengths)]
    w[begins + lengths] = words + np.arange(len(texts))
    found = np.array(find_runs(w, lengths), np.int64).reshape(-1, 3)
    rank = np.searchsorted(begins, found[:, 0], "right") - 1
    text = order[rank]
    start = found[:, 0] - begins[rank]
    sort = np.lexsort((found[:, 2], start, text))
    text, rows = text[sort], np.stack([start, found[:, 1] - found[:, 0], found[:, 2]], axis=1)[sort]
    gone = np.zeros(words + 1, np.int64)
    np.add.at(gone, first[text] + rows[:, 0] + rows[:, 2], 1)
    np.add.at(gone, first[text] + rows[:, 0] + rows[:, 1], -1)
    stays = np.cumsum(gone[:-1]) == 0
    sizes = np.diff(offsets)
    data = data[np.repeat(stays, sizes)]
    of_text = np.repeat(np.arange(len(texts)), counts)
    size = np.bincount(of_text, np.where(stays, sizes, 0), minlength=len(texts)).astype(np.int64)
    cuts = np.concatenate([[0], np.cumsum(size)])
    collapsed = [data[a : max(a, b - 1)].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    limits = np.searchsorted(text, np.arange(len(texts) + 1))
    return counts, [rows[a:b] for a, b in zip(limits[:-1], limits[1:])], collapsed


RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.BinaryType())])


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """``struct carry``, ``n_words``, ``runs`` (start, length, period; by start, then period) and ``collapsed``.

    Words are what white space (space, tab to carriage return) divides, numbered from 0.  Null counts as
    empty; empty texts have no words, no runs and an empty collapsed text.  Repeated rows stay repeated, rows
    of one id are not put together, and an empty table gives an empty one.  Extra columns travel inside
    carry.  A very long text is worked on alone, in some 100 bytes of memory a word.  Runs that start at the
    same word (ties) are all listed.
    """

    def make():
        def group(raws):
            counts, runs, collapsed = runs_of_texts([x or b"" for x in raws])
            rows = np.concatenate(runs) if runs else np.zeros((0, 3), np.int64)
            offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
            fields = [pa.field(c, pa.int64()) for c in ("start", "length", "period")]
            items = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)], fields=fields)
            return [pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(offsets), items), pa.array(collapsed, pa.binary())]

        return group

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return map_text_groups(docs, text, OUT, make, carry, GROUP_BYTES).withColumn("collapsed", F.col("collapsed").cast("string"))


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Number of runs, the longest one (ties: the first, then the smallest period) and digests of both results."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("minus"), r["start"].alias("start"), r["period"].alias("period"))))
    return scanned.select(
        F.col(f"carry.`{id_col}`").alias("doc_id"),
        F.size("runs").cast("bigint").alias("n_runs"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        best.alias("best"),
    ).select(
        "doc_id",
        "n_runs",
        F.col("best.start").alias("start"),
        (-F.col("best.minus")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-1000 * best.minus) div best.period").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )
