"""Hash-derived values that both Spark and a plain SQL engine can compute.

* ``hash_unit_vector`` – a deterministic pseudo-random unit vector from a
  text seed (probes, marks, rotation keys).  Pure SQL: sha2 → hex digits
  → integers → doubles, so any engine with SHA-256 reproduces it bit for
  bit.
* ``hmac_sha256_hex`` – RFC 2104 HMAC-SHA256 written with sha2/unhex and
  32-bit XORs, equal to Python's ``hmac`` module.
* ``stable_point_id`` – a deterministic BIGINT id for string ids.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vectors import EPS

# HMAC inner/outer pad bytes 0x36 / 0x5c, repeated over 32-bit words.
IPAD_WORD = 0x36363636
OPAD_WORD = 0x5C5C5C5C
SHA256_BLOCK_HEX = 128  # 64-byte block as hex digits

# Default probe seed (0xC4050AB1) and mark seed (0xDEADBEEF), as decimals.
PROBE_SEED = "3288664753"
MARK_SEED = "3735928559"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_uniform_vector(seed: Column, key: Column, dim) -> Column:
    """Component j = word (j mod 8) of sha256(seed ':' key ':' (j div 8)) / 2^32 - 0.5.

    One sha256 per 8 components: the chunk digests are built once, the
    words are read with a nested transform (which only captures its own
    lambda variable), then sliced to ``dim``.
    """
    d = F.lit(dim) if isinstance(dim, int) else dim
    n_chunks = F.floor((d + 7) / 8).cast("int")
    chunks = F.transform(
        F.sequence(F.lit(0), n_chunks - 1),
        lambda c: F.sha2(F.concat_ws(":", seed, key.cast("string"), c.cast("string")), 256),
    )
    words = F.flatten(
        F.transform(
            chunks,
            lambda h: F.transform(
                F.sequence(F.lit(0), F.lit(7)),
                lambda w: F.conv(F.substring(h, w * 8 + 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) - F.lit(0.5),
            ),
        )
    )
    return F.slice(words, 1, d)


def unit(v: Column, eps: float = EPS) -> Column:
    """v / (|v| + eps) in double precision (norm evaluated once per row)."""
    n = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.zip_with(v, F.array_repeat(F.lit(1.0) / (n + F.lit(eps)), F.size(v)), lambda x, k: x * k)


def hash_unit_vector(seed, key, dim) -> Column:
    seed_c = F.lit(seed) if isinstance(seed, str) else seed
    return unit(hash_uniform_vector(seed_c, _c(key), dim))


def byte_mark_vector(seed, seq, dim) -> Column:
    """Per-batch mark: bytes of sha256('seed:seq')/255 - 0.5, tiled to dim, unit length.

    The digest is computed once per row (as an argument, never inside a
    per-element lambda), its 32 bytes decoded once, then tiled by
    flatten(array_repeat) and sliced.
    """
    seed_c = F.lit(seed) if isinstance(seed, str) else seed
    d = F.lit(dim) if isinstance(dim, int) else dim
    h = F.sha2(F.concat_ws(":", seed_c, _c(seq).cast("string")), 256)
    bytes32 = F.transform(
        F.array_repeat(h, 32),
        lambda hh, i: F.conv(F.substring(hh, i * 2 + 1, 2), 16, 10).cast("double") / F.lit(255.0) - F.lit(0.5),
    )
    tiled = F.slice(F.flatten(F.array_repeat(bytes32, F.floor((d + 31) / 32).cast("int"))), 1, d)
    return unit(tiled)


def _xor_pad(key_hex: Column, word: int) -> Column:
    """(key zero-padded to one SHA-256 block) XOR pad, as hex."""
    padded = F.rpad(F.lower(key_hex), SHA256_BLOCK_HEX, "0")
    words = F.transform(
        F.array_repeat(padded, SHA256_BLOCK_HEX // 8),  # the key is evaluated once, not once per word
        lambda p, i: F.lpad(
            F.lower(F.hex(F.conv(F.substring(p, i * 8 + 1, 8), 16, 10).cast("bigint").bitwiseXOR(F.lit(word)))),
            8,
            "0",
        ),
    )
    return F.array_join(words, "")


def hmac_sha256_hex(key_hex: Column, message: Column) -> Column:
    """HMAC-SHA256(key, message) for a key of at most 64 bytes given as hex."""
    msg = F.encode(message, "UTF-8")
    inner = F.sha2(F.concat(F.unhex(_xor_pad(key_hex, IPAD_WORD)), msg), 256)
    return F.sha2(F.concat(F.unhex(_xor_pad(key_hex, OPAD_WORD)), F.unhex(inner)), 256)


def batch_key_hex(seed, batch_id) -> Column:
    """Per-batch key: sha256('seed:batch_id')."""
    seed_c = F.lit(seed) if isinstance(seed, str) else seed
    return F.sha2(F.concat_ws(":", seed_c, _c(batch_id).cast("string")), 256)


def stable_point_id(id_col) -> Column:
    """Digits-only ids (1-18 digits) keep their value; others hash to md5's first 60 bits."""
    i = _c(id_col)
    return (
        F.when(i.rlike("^[0-9]{1,18}$"), i.cast("bigint"))
        .otherwise(F.conv(F.substring(F.md5(i), 1, 15), 16, 10).cast("bigint"))
    )
