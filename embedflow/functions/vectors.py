"""Vector math as Column expressions (JVM-side higher-order functions).

These are the *definition* of every score the library computes.  They
run inside Spark's expression engine, so they work in any projection,
filter or join condition.  Hot paths that score many vectors against
many probes use the Arrow block form in ``operators.knn`` and are tested
to agree with these.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The epsilon in every cosine / normalisation denominator.
EPS = 1e-9
# Metric aliases (case-insensitive); unknown names map to themselves.
METRIC_ALIASES = {
    "cosine": "cosine",
    "cos": "cosine",
    "dot": "dot",
    "dot_product": "dot",
    "ip": "dot",
    "l2": "l2",
    "euclidean": "l2",
    "euclid": "l2",
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(v) -> Column:
    return _c(v).cast("array<double>")


def dot(a, b) -> Column:
    """Inner product in double precision."""
    prods = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(dot(v, v))


def cosine(a, b) -> Column:
    """dot / (|a| |b| + eps): epsilon inside the denominator."""
    return dot(a, b) / (norm(a) * norm(b) + F.lit(EPS))


def l2_distance(a, b) -> Column:
    diffs = F.zip_with(as_double(a), as_double(b), lambda x, y: x - y)
    return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x * x))


def scale(v, c) -> Column:
    """v * c for a per-row scalar c.

    The scalar is spread with array_repeat and zipped in, so it is
    evaluated once per row: a lambda that captured ``c`` directly would
    re-evaluate it for every element (O(dim²) for a norm).
    """
    arr = as_double(v)
    return F.zip_with(arr, F.array_repeat(c, F.size(arr)), lambda x, k: x * k)


def axpy(a, x, y) -> Column:
    """a * x + y for a per-row scalar a (same evaluation rule as ``scale``)."""
    return F.zip_with(scale(x, a), as_double(y), lambda p, q: p + q)


def l2_normalise(v, eps: float = EPS) -> Column:
    """v / (|v| + eps), kept as float32 like the stored vectors."""
    return scale(v, F.lit(1.0) / (norm(v) + F.lit(eps))).cast("array<float>")


def score(metric: str, q, v) -> Column:
    """Similarity where larger is nearer, for each supported metric."""
    m = normalise_metric_name(metric)
    if m == "cosine":
        return cosine(q, v)
    if m == "dot":
        return dot(q, v)
    if m == "l2":
        return -l2_distance(q, v)
    raise ValueError(f"unsupported metric {metric!r}")


def normalise_metric_name(name: str) -> str:
    low = name.lower()
    return METRIC_ALIASES.get(low, low)


def metric_normalise_col(col) -> Column:
    """Column form of the alias map: coalesce(map[lower(m)], lower(m))."""
    pairs = []
    for k, v in METRIC_ALIASES.items():
        pairs += [F.lit(k), F.lit(v)]
    low = F.lower(_c(col))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), low), low)


# Fixed-point codes for values that have no BIGINT form (NaN, ±inf, |x·scale| ≥ 9e18).
FP_NAN = -(2**63)
FP_POS = 2**63 - 1
FP_NEG = -(2**63) + 1
FP_LIMIT = 9e18


def fixed_point(v, scale: float = 1e6) -> Column:
    """Each element as round(x * scale) BIGINT: an engine-independent text form.

    Non-finite or out-of-range values get the FP_* codes instead of failing.
    """

    def code(x):
        y = x * F.lit(scale)
        return (
            F.when(F.isnan(y), F.lit(FP_NAN))
            .when(y >= F.lit(FP_LIMIT), F.lit(FP_POS))
            .when(y <= F.lit(-FP_LIMIT), F.lit(FP_NEG))
            .otherwise(F.round(y).cast("bigint"))
        )

    return F.transform(as_double(v), code)


def fixed_point_np(v, scale: float = 1e6):
    """:func:`fixed_point` in numpy: round half away from zero on the exact double value."""
    import numpy as np

    with np.errstate(over="ignore", invalid="ignore"):
        y = np.asarray(v, dtype=np.float64) * scale
        ok = np.isfinite(y) & (np.abs(y) < FP_LIMIT)
        a = np.abs(np.where(ok, y, 0.0))
        whole = np.floor(a)
        out = (np.sign(np.where(ok, y, 0.0)) * (whole + (a - whole >= 0.5))).astype(np.int64)
    out[np.isnan(y)] = FP_NAN
    out[~np.isnan(y) & (y >= FP_LIMIT)] = FP_POS
    out[~np.isnan(y) & (y <= -FP_LIMIT)] = FP_NEG
    return out


def fingerprint(v) -> Column:
    """md5 of the comma-joined fixed-point elements: compare vectors as one string."""
    return F.md5(F.array_join(F.transform(fixed_point(v), lambda x: x.cast("string")), ","))


def dim(v) -> Column:
    return F.size(_c(v))
