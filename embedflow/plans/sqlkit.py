"""SQL text helpers for the DuckDB oracles (same definitions as functions/)."""

from __future__ import annotations

from ..functions.hashing import PROBE_SEED

# Canonical records of the ``embeddings`` table, as in sources.canonical.from_embeddings.
SRC = (
    "src AS (SELECT CAST(vec_id AS VARCHAR) AS id, embedding AS vector, label, "
    "CAST(label AS VARCHAR) AS meta_label, 'ns' || CAST(label AS VARCHAR) AS namespace FROM embeddings)"
)
# The lossy copy used as a migration target: every element rounded to 2 decimals.
TGT_ROUNDED = (
    "tgt AS (SELECT id, list_transform(vector, lambda x: CAST(round(CAST(x AS DOUBLE), 2) AS FLOAT)) AS vector, "
    "label, meta_label, namespace FROM src)"
)
DIMS = "dims AS (SELECT len(vector) AS dim FROM src WHERE len(vector) > 0 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def dbl(v: str) -> str:
    return f"CAST({v} AS DOUBLE[])"


def dot(a: str, b: str) -> str:
    return f"list_dot_product({dbl(a)}, {dbl(b)})"


def norm(v: str) -> str:
    return f"sqrt({dot(v, v)})"


def cos(a: str, b: str) -> str:
    return f"({dot(a, b)} / ({norm(a)} * {norm(b)} + 1e-9))"


def l2(a: str, b: str) -> str:
    return f"list_distance({dbl(a)}, {dbl(b)})"


def score(metric: str, q: str, v: str) -> str:
    return {"cosine": cos(q, v), "dot": dot(q, v), "l2": f"(-{l2(q, v)})"}[metric]


def fp(v: str) -> str:
    """Vector fingerprint: md5 of comma-joined round(x * 1e6) BIGINTs."""
    return (
        f"md5(array_to_string(list_transform({v}, lambda x: CAST(round(CAST(x AS DOUBLE) * 1e6) AS BIGINT)), ','))"
    )


def hash_unit_probes(n: int, seed: str = PROBE_SEED, name: str = "probes") -> str:
    """CTE ``name(probe_id, q)``: the seeded unit probes of operators.knn.make_probes (needs ``dims``)."""
    return (
        f"{name}_u AS (SELECT p.range AS probe_id, j, "
        f"CAST(('0x' || substr(sha256('{seed}:' || p.range || ':' || (j // 8)), (j % 8) * 8 + 1, 8))::BIGINT AS DOUBLE)"
        f" / 4294967296.0 - 0.5 AS u FROM range({n}) p CROSS JOIN (SELECT unnest(range(0, (SELECT dim FROM dims))) AS j) js), "
        f"{name}_l AS (SELECT probe_id, list(u ORDER BY j) AS u FROM {name}_u GROUP BY probe_id), "
        f"{name} AS (SELECT probe_id, list_transform(u, lambda x: x / (sqrt(list_dot_product(u, u)) + 1e-9)) AS q "
        f"FROM {name}_l)"
    )


def topk(name: str, table: str, k: int, metric: str = "cosine", probes: str = "probes") -> str:
    """CTE ``name(probe_id, id, vector, score, rank)``: exact top-k of ``table`` per probe."""
    return (
        f"{name}_s AS (SELECT p.probe_id, d.id, d.vector, {score(metric, 'p.q', 'd.vector')} AS score "
        f"FROM {probes} p, {table} d WHERE len(d.vector) = (SELECT dim FROM dims)), "
        f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY probe_id "
        f"ORDER BY round(score, 9) DESC, id) AS rank FROM {name}_s) WHERE rank <= {k})"
    )


# ── digests, marks, rotation (functions.digest / hashing / operators.rotate) ──

IPAD_WORD = 0x36363636
OPAD_WORD = 0x5C5C5C5C


def xor_pad(key_hex: str, word: int) -> str:
    return (
        f"array_to_string(list_transform(range(16), lambda i: lpad(lower(hex(xor(('0x' || "
        f"substr(rpad(lower({key_hex}), 128, '0'), i * 8 + 1, 8))::BIGINT, {word}))), 8, '0')), '')"
    )


def hmac_hex(key_hex: str, msg: str) -> str:
    inner = f"sha256(unhex({xor_pad(key_hex, IPAD_WORD)}) || encode({msg}))"
    return f"sha256(unhex({xor_pad(key_hex, OPAD_WORD)}) || unhex({inner}))"


# Canonical metadata JSON of the ``embeddings`` records.
META_JSON = "('{\"label\":\"' || meta_label || '\"}')"


def float_bits_hex(x: str) -> str:
    """IEEE-754 bits of a finite float32 as 8 hex digits, in exact double arithmetic."""
    a = f"abs(CAST({x} AS DOUBLE))"
    g = f"floor(log2(CASE WHEN {a} > 0 THEN {a} ELSE 1.0 END))"
    e = f"({g} + CASE WHEN pow(2.0, {g} + 1) <= {a} THEN 1 WHEN pow(2.0, {g}) > {a} AND {a} > 0 THEN -1 ELSE 0 END)"
    size = f"CASE WHEN {a} < pow(2.0, -126) THEN {a} * pow(2.0, 149) ELSE ({e} + 127) * 8388608.0 + ({a} / pow(2.0, {e}) - 1) * 8388608.0 END"
    sign = f"CASE WHEN {x} < 0 OR ({x} = 0 AND CAST({x} AS VARCHAR) LIKE '-%') THEN 2147483648.0 ELSE 0.0 END"
    return f"lpad(hex(CAST({size} + {sign} AS BIGINT)), 8, '0')"


def row_digest(id_: str = "id", v: str = "vector", meta: str = META_JSON, namespace: str = "namespace") -> str:
    field = lambda c: f"coalesce(strlen({c}) || ':' || {c}, '-:')"
    hexes = f"array_to_string(list_transform({v}, lambda x: {float_bits_hex('x')}), '')"
    return f"sha256(encode({field(id_)} || {field(meta)} || {field(namespace)}) || unhex({hexes}))"


def batch_digest_ctes(batched: str = "batched", seed: str = "embedflow") -> str:
    """CTEs rd, bd, dg(batch_id, cnt, dim, digest) over ``batched(batch_id, id, vector)``."""
    return (
        f"rd AS (SELECT batch_id, id, len(vector) AS d, {row_digest()} AS rdg FROM {batched}), "
        "bd AS (SELECT batch_id, count(*) AS cnt, max(d) AS dim, string_agg(rdg, ',' ORDER BY rdg) AS digests FROM rd GROUP BY batch_id), "
        f"dg AS (SELECT batch_id, cnt, dim, {hmac_hex(f'sha256({chr(39)}{seed}:{chr(39)} || batch_id)', "batch_id || '|' || cnt || '|' || dim || '|' || digests")} AS digest FROM bd)"
    )


def byte_mark(seq: str, dim: str, seed: str = "3735928559") -> str:
    raw = (
        f"list_transform(range({dim}), lambda j: CAST(('0x' || substr(sha256('{seed}:' || {seq}), (j % 32) * 2 + 1, 2))::BIGINT AS DOUBLE)"
        " / 255.0 - 0.5)"
    )
    return f"list_transform({raw}, lambda x: x / (sqrt(list_dot_product({raw}, {raw})) + 1e-9))"


def hash_uniform(seed: str, key: str, dim: str) -> str:
    return (
        f"list_transform(range({dim}), lambda j: CAST(('0x' || substr(sha256('{seed}:{key}:' || (j // 8)), (j % 8) * 8 + 1, 8))::BIGINT AS DOUBLE)"
        " / 4294967296.0 - 0.5)"
    )


def reflect(v: str, u: str) -> str:
    return f"list_transform(list_zip({v}, {u}), lambda p: p[1] - 2.0 * list_dot_product({v}, {u}) / list_dot_product({u}, {u}) * p[2])"
