"""Quality classifier by co-training of a text view and a page-metadata view.

Two logistic regressions see different sides of a document: the text's content (hashed words and word pairs,
and a few figures), and its metadata.  In every round each labels the unlabelled documents it is confident
about, and the other learns from these beside the true labels.  At the end each view is calibrated on
labelled documents that neither has learnt from, and the calibrated views are combined by adding their
log-odds over the prior.  Every document takes part: all labels, all unlabelled documents as candidates for
pseudo-labels, and all are scored.

A document's words are kept as bucket numbers with the logarithm of their counts, three bytes a bucket; the
regressions are fitted by L-BFGS, one pass over these a step, whose gradients are added up in Spark.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import written
from .textmap import map_text

ROUNDS, CONFIDENCE, PSEUDO_WEIGHT = 2, 0.95, 0.3
#: One labelled document in so many is held out for calibration.
HELD_OUT_IN = 5
#: Words and word pairs share the first; sources and languages have their own in the metadata view.
WORD_BUCKETS, SOURCE_BUCKETS, LANG_BUCKETS = 1 << 16, 1 << 12, 1 << 8
#: Steps of a fit at most; it ends before once a step improves the loss by less than this share.
ITERATIONS, TOLERANCE, REGULARISATION = 25, 1e-4, 1e-3
#: Earlier steps that L-BFGS looks back on, and weights in a row of partial gradients.
MEMORY, CHUNK = 6, 4096
#: Rows that are unpacked at a time, and those that a task adds up at least before its partial gradient is shuffled.
UNPACKED_ROWS, SUMMED_ROWS = 1024, 1 << 14
#: Up to so many labels are broadcast (some 20 MB); more are joined by a shuffle.
SMALL_LABELS = 1_000_000
THRESHOLD = 0.5
_SYMBOLS, _UPPER, _DIGITS, _SHOUTS = (bytes(x, "ascii") for x in ("#*$%&|<>=~^", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "!?"))
#: Steps to a doubling in which logarithms of counts are kept; a byte reaches two million.
_LOG_STEPS = 12

VIEWS = ("text", "meta")
BUCKETS = {"text": WORD_BUCKETS, "meta": SOURCE_BUCKETS + LANG_BUCKETS}
FIGURES = {"text": 11, "meta": 2}
#: The columns of a view: bucket numbers (two bytes each), their values' logarithmic bytes, figures.
_COLUMNS = {"text": ["at", "by", "figures"], "meta": ["source_at", "lang_at", "length"]}


def text_features(raw: bytes | None) -> tuple[bytes, bytes, list[float]]:
    """Buckets of a whole text's words and word pairs, their counts' logarithms, and content figures (null: as empty)."""
    raw = raw or b""
    words = raw.split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    pairs = Counter(zip(words, words[1:]))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    gone = lambda chars: size - len(raw.translate(None, chars)) if raw else 0
    figures = [
        math.log1p(len(words)),
        len(raw) / n / 10,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        len(pairs) / n,
        gone(_SYMBOLS) / n,
        gone(_UPPER) / size,
        gone(_DIGITS) / size,
        gone(_SHOUTS) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        math.log1p(len(lines)),
    ]
    lower = {w: w.lower() for w in counts}
    hashed = {w: zlib.crc32(x + b" ") for w, x in lower.items()}
    found = [hashed[w] for w in counts] + [zlib.crc32(lower[b], hashed[a]) for a, b in pairs]
    at, back = np.unique(np.array(found, np.uint32) % WORD_BUCKETS, return_inverse=True)
    sums = np.bincount(back, [*counts.values(), *pairs.values()], len(at))
    by = np.minimum(np.round(_LOG_STEPS * np.log2(1 + sums)), 255)
    return at.astype("<u2").tobytes(), by.astype(np.uint8).tobytes(), [float(x) for x in figures]


def metadata_features() -> list[Column]:
    """Hash buckets of source and language (null: bucket of its own hash), and the length's logarithm and its square (null: zero)."""
    bucket = lambda c, n: F.pmod(F.xxhash64(F.col(c).cast("string")), F.lit(n)).cast("int")
    length = F.log1p(F.greatest(F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0)), F.lit(0.0)))
    return [bucket("source", SOURCE_BUCKETS).alias("source_at"), bucket("lang", LANG_BUCKETS).alias("lang_at"), F.array(length, length * length).alias("length")]


def _features(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``id``, both views' columns, ``label`` (null: unlabelled) and ``held``; a document with contradicting labels takes the larger."""
    out = T.StructType.fromDDL("at binary, by binary, figures array<double>")

    def make():
        return text_features

    seen = map_text(docs, "text", out, make, ["doc_id", "source", "lang", "n_chars"])
    flat = seen.select("carry.*", *out.fieldNames())
    valid = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
    known = valid.groupBy("doc_id").agg(F.max("quality").cast("double").alias("label"))
    small = valid.count() <= SMALL_LABELS
    joined = flat.join(F.broadcast(known) if small else known.hint("shuffle_merge"), "doc_id", "left")
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT_IN)) == 0
    return joined.select(F.col("doc_id").alias("id"), *out.fieldNames(), *metadata_features(), "label", (F.col("label").isNotNull() & held).alias("held"))


class Model:
    """A view's weights (buckets, then figures, then the intercept), and how its figures are brought to one scale."""

    def __init__(self, view: str, centre: np.ndarray, spread: np.ndarray):
        self.view, self.centre, self.spread = view, centre, spread
        self.weights = np.zeros(BUCKETS[view] + FIGURES[view] + 1)

    def rows(self, batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(row, bucket, value, figures)``: the batch's bucket entries, each row's values of length one; its figures and a one."""
        a, b, c = (batch.column(batch.schema.get_field_index(x)) for x in _COLUMNS[self.view])
        n = len(batch)
        if self.view == "text":
            bucket = np.frombuffer(b"".join(a.to_pylist()), "<u2").astype(np.int64)
            value = np.frombuffer(b"".join(b.to_pylist()), np.uint8) / _LOG_STEPS
            row = np.repeat(np.arange(n), pc.binary_length(b).to_numpy())
        else:
            bucket = np.column_stack([a.to_numpy(), b.to_numpy() + SOURCE_BUCKETS]).ravel().astype(np.int64)
            value, row = np.ones(2 * n), np.repeat(np.arange(n), 2)
        norm = np.sqrt(np.bincount(row, value * value, n))
        figures = (c.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) - self.centre) / self.spread
        return row, bucket, value / norm[row], np.column_stack([figures, np.ones(n)])

    def odds(self, batch: pa.RecordBatch) -> np.ndarray:
        """Log-odds of every row."""
        row, bucket, value, figures = self.rows(batch)
        return self._odds(row, bucket, value, figures)

    def _odds(self, row, bucket, value, figures):
        cut = BUCKETS[self.view]
        return np.bincount(row, value * self.weights[bucket], len(figures)) + figures @ self.weights[cut:]

    def loss(self, batch: pa.RecordBatch, y: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
        """Weighted logistic loss of the rows and its gradient, both summed."""
        row, bucket, value, figures = self.rows(batch)
        odds = self._odds(row, bucket, value, figures)
        off = weight * (1 / (1 + np.exp(-np.clip(odds, -500, 500))) - y)
        gradient = np.concatenate([np.bincount(bucket, value * off[row], BUCKETS[self.view]), off @ figures])
        return float(weight @ (np.logaddexp(0, odds) - y * odds)), gradient


def _unpackable(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of few rows, since a row's entries take many times its packed size."""
    for batch in batches:
        for i in range(0, len(batch), UNPACKED_ROWS):
            yield batch.slice(i, UNPACKED_ROWS)


def _lesson(batch: pa.RecordBatch, teacher: Model | None, confidence: float) -> tuple[pa.RecordBatch, np.ndarray, np.ndarray]:
    """The rows to learn from, their labels and weights: labelled rows, and those of which the teacher is sure."""
    y = batch.column(batch.schema.get_field_index("label")).to_numpy(zero_copy_only=False).astype(float)
    weight = np.where(np.isnan(y), 0.0, 1.0)
    if teacher is not None and len(y):
        odds, limit = teacher.odds(batch), math.log(confidence / (1 - confidence))
        sure = np.isnan(y) & (np.abs(odds) >= limit)
        y, weight = np.where(sure, odds > 0, y), np.where(sure, PSEUDO_WEIGHT, weight)
    kept = weight > 0
    return batch.filter(pa.array(kept)), y[kept], weight[kept]


def _summed(data: DataFrame, student: Model, teacher: Model | None, confidence: float) -> tuple[float, float, np.ndarray]:
    """Weight, loss and gradient over all rows of ``data``: partial sums of each task, added by Spark in chunks of weights."""
    size = len(student.weights)
    chunks = -(-size // CHUNK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        loss, total, gradient = 0.0, 0.0, np.zeros(chunks * CHUNK)
        for batch in _unpackable(batches):
            rows, y, weight = _lesson(batch, teacher, confidence)
            if len(y):
                more, slope = student.loss(rows, y, weight)
                loss, total = loss + more, total + float(weight.sum())
                gradient[:size] += slope
        if total:
            parts = [[total, loss], *gradient.reshape(chunks, CHUNK)]
            yield pa.RecordBatch.from_arrays([pa.array(range(-1, chunks), pa.int32()), pa.array(parts, pa.list_(pa.float64()))], names=["chunk", "part"])

    views = {student.view} | ({teacher.view} if teacher else set())
    needed = data if teacher else data.where("label IS NOT NULL")
    parts = needed.select(*[c for v in sorted(views) for c in _COLUMNS[v]], "label").mapInArrow(run, "chunk int, part array<double>")
    sums = {r.chunk: r.part.toArray() for r in parts.groupBy("chunk").agg(Summarizer.sum(array_to_vector("part")).alias("part")).collect()}
    (total, loss), gradient = sums[-1], np.concatenate([sums[i] for i in range(chunks)])[:size]
    return float(total), float(loss), gradient


def minimise(objective: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray, iterations: int, tolerance: float) -> np.ndarray:
    """L-BFGS: where the convex ``objective(weights) -> (value, gradient)`` is least, from ``start``."""
    at, (value, slope) = start, objective(start)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(iterations):
        way, alphas = slope.copy(), []
        for s, d in reversed(steps):
            alphas.append((s @ way) / (s @ d))
            way -= alphas[-1] * d
        if steps:
            s, d = steps[-1]
            way *= (s @ d) / (d @ d)
        for (s, d), alpha in zip(steps, reversed(alphas)):
            way += (alpha - (d @ way) / (s @ d)) * s
        length, descent = 1.0, slope @ way
        new = at - way
        new_value, new_slope = objective(new)
        while new_value > value - 1e-4 * length * descent and length > 1e-4:
            length /= 2
            new = at - length * way
            new_value, new_slope = objective(new)
        if new_value >= value:
            return at
        if (new - at) @ (new_slope - slope) > 0:
            steps = [*steps[-MEMORY + 1 :], (new - at, new_slope - slope)]
        gain = value - new_value
        at, value, slope = new, new_value, new_slope
        if gain <= tolerance * abs(value):
            break
    return at


def _taught(data: DataFrame, student: Model, teacher: Model | None, confidence: float, iterations: int, tolerance: float) -> Model:
    """The student fitted anew, from where it stands, to the labels and the teacher's sure labels."""
    fitted = Model(student.view, student.centre, student.spread)

    def objective(weights: np.ndarray) -> tuple[float, np.ndarray]:
        fitted.weights = weights
        total, loss, gradient = _summed(data, fitted, teacher, confidence)
        held_small = np.append(weights[:-1], 0.0)
        return loss / total + REGULARISATION / 2 * float(held_small @ held_small), gradient / total + REGULARISATION * held_small

    fitted.weights = minimise(objective, student.weights, iterations, tolerance)
    return fitted


def _untaught(data: DataFrame) -> dict[str, Model]:
    """Models without knowledge, with centre and spread of each figure over all rows."""
    found = {}
    for v in VIEWS:
        column = F.col(_COLUMNS[v][2])
        figures = [f(column[i]) for i in range(FIGURES[v]) for f in (F.avg, F.stddev_pop)]
        seen = np.array(data.agg(*figures).first(), float).reshape(-1, 2)
        found[v] = Model(v, seen[:, 0], np.where(seen[:, 1] > 1e-9, seen[:, 1], 1.0))
    return found


def _scored(data: DataFrame, models: dict[str, Model]) -> DataFrame:
    """``id, label, held`` and each view's log-odds."""
    src = data.select("id", "label", "held", *[c for v in VIEWS for c in _COLUMNS[v]])
    schema = T.StructType([src.schema["id"], src.schema["label"], src.schema["held"], *(T.StructField(v, T.DoubleType()) for v in VIEWS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unpackable(batches):
            odds = [pa.array(models[v].odds(batch)) for v in VIEWS]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *odds], names=["id", "label", "held", *VIEWS])

    return src.mapInArrow(run, schema)


def _calibrated(held: DataFrame, view: str, iterations: int, tolerance: float) -> Column:
    """The view's log-odds, stretched and shifted to fit the held-out labels; few labels leave them nearly as they are."""
    x, y = F.col(view), F.col("label")

    def objective(at: np.ndarray) -> tuple[float, np.ndarray]:
        z = F.lit(float(at[0])) + F.lit(float(at[1])) * x
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - y * z
        sums = np.array(held.agg(F.count(y), F.sum(loss), F.sum(_p(z) - y), F.sum((_p(z) - y) * x)).first(), float)
        off = at - (0.0, 1.0)
        return (sums[1] + off @ off / 2) / sums[0], (sums[2:] + off) / sums[0]

    shift, slope = minimise(objective, np.array([0.0, 1.0]), iterations, tolerance)
    return F.lit(float(shift)) + F.lit(float(slope)) * x


def _p(odds: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))


def score(
    docs: DataFrame,
    labels: DataFrame,
    rounds: int = ROUNDS,
    confidence: float = CONFIDENCE,
    iterations: int = ITERATIONS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``id, text_score, metadata_score, quality_score`` of every row of ``docs``.

    docs has doc_id, text, source, lang and n_chars; labels has doc_id and quality (0 or 1; others, and
    rows without an id, are ignored; repeated labels count once, of contradicting ones the larger).  Nulls
    and empty texts are scored like any other row, texts of any length count whole (a row's words take
    196,608 bytes at most), repeated rows stay repeated, equal rows get equal scores, other columns are
    ignored, and an empty table gives an empty one.  Unless both classes are among the labels, in the
    learning and in the held-out part, there is nothing to learn and every score is the labels' smoothed
    mean (0.5 without labels).
    """
    data = written(_features(docs, labels), "views")
    seen = {(r["held"], r["label"]): r["n"] for r in data.where("label IS NOT NULL").groupBy("held", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = (sum(n for (_, label), n in seen.items() if label == c) for c in (1.0, 0.0))
    prior = (good + 1) / (good + bad + 2)
    if len(seen) < 4:
        flat = F.lit(prior)
        return data.select("id", flat.alias("text_score"), flat.alias("metadata_score"), flat.alias("quality_score"))
    learn = data.coalesce(-(-data.count() // SUMMED_ROWS)).where("NOT held")
    untaught = _untaught(data)
    models = {v: _taught(learn, untaught[v], None, confidence, iterations, tolerance) for v in VIEWS}
    for _ in range(rounds):
        models = {v: _taught(learn, models[v], models[teacher], confidence, iterations, tolerance) for v, teacher in zip(VIEWS, reversed(VIEWS))}
    odds = written(_scored(data, models), "odds")
    calibrated = {v: _calibrated(odds.where("held"), v, iterations, tolerance) for v in VIEWS}
    both = F.col("text") + F.col("meta") - F.lit(math.log(prior / (1 - prior)))
    scaled = odds.select("id", *[calibrated[v].alias(v) for v in VIEWS])
    return scaled.select("id", _p(F.col("text")).alias("text_score"), _p(F.col("meta")).alias("metadata_score"), _p(both).alias("quality_score"))
