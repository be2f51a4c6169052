"""Byte-level BPE with a two-tier lookup, over Arrow batches.

Tier one is a minimal perfect hash over the vocabulary: it resolves any byte string that is a token with
one probe and one comparison.  A pre-token it doesn't know goes to tier two, where a heap of candidate
merges over a linked list of byte spans applies the lowest rank first (the leftmost of equal ranks).
"""

from __future__ import annotations

import base64
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import islice

import regex
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_text

#: Pre-tokens in a generation of those whose ids a worker remembers; it holds the last two.
MEMO = 1 << 17
#: Pre-tokens of one text handled at a time.
CHUNK = 1 << 16
#: Characters beyond which a text is split piecemeal.
LONG = 1 << 22
#: Letters, digits and white space below U+0250, as in the Unicode tables.
_LATIN_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_LATIN_DIGITS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_LATIN_SPACES = "\\t-\\r \u0085\u00a0"
_LATIN = re.compile("[\u0000-\u024f]*")
_MASK = (1 << 64) - 1
#: Letters and digits that this module's Unicode tables have and the tokenizer library's older
#: tables don't; to that library they are neither.
NEW_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F),
    (0x209D, 0x209F), (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2),
    (0xA7F1, 0xA7F1), (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7),
    (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A), (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1),
    (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686), (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3),
    (0x16FF2, 0x16FF3), (0x16FF4, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168),
    (0x1D6A6, 0x1D6A6), (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF),
    (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2), (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4),
    (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E), (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479),
    (0x3D000, 0x3FC3F),
]
_NEW = regex.compile("[" + "".join(f"{chr(a)}-{chr(b)}" for a, b in NEW_LETTERS) + "]")


def _slot(h: int, d: int, n: int) -> int:
    x = (h ^ (d * 0x9E3779B97F4A7C15)) & _MASK
    x = ((x ^ (x >> 31)) * 0xBF58476D1CE4E5B9) & _MASK
    return (x ^ (x >> 29)) % n


class PerfectHash:
    """Minimal perfect hash of byte strings to their ranks, built by hash and displace.

    Keys fall into buckets; each bucket, largest first, takes the first displacement that sends its keys
    to free slots, and a bucket of one key names its slot outright.  There are as many slots as keys.
    """

    def __init__(self, ranks: dict[bytes, int]):
        n = self.n = len(ranks)
        self.buckets = max(1, n * 2 // 5)
        self.displace = [0] * self.buckets
        self.keys: list[bytes | None] = [None] * n
        self.ranks = [0] * n
        fallen: dict[int, list[tuple[int, bytes]]] = {}
        for key in ranks:
            h = xxhash.xxh64_intdigest(key)
            fallen.setdefault(h % self.buckets, []).append((h, key))
        for bucket, members in sorted(fallen.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                break
            d = 0
            while True:
                slots = [_slot(h, d, n) for h, _ in members]
                if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                    break
                d += 1
                if d > 1 << 24:
                    raise ValueError("two keys have the same hash")
            self.displace[bucket] = d
            for s, (_, key) in zip(slots, members):
                self.keys[s], self.ranks[s] = key, ranks[key]
        free = (i for i, k in enumerate(self.keys) if k is None)
        for bucket, members in fallen.items():
            if len(members) == 1:
                s, key = next(free), members[0][1]
                self.displace[bucket] = -1 - s
                self.keys[s], self.ranks[s] = key, ranks[key]

    def get(self, key: bytes) -> int | None:
        if not self.n:
            return None
        h = xxhash.xxh64_intdigest(key)
        d = self.displace[h % self.buckets]
        s = _slot(h, d, self.n) if d >= 0 else -1 - d
        return self.ranks[s] if self.keys[s] == key else None


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file (a base64 token and its rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Ranks behind a perfect hash, the tokens' bytes by id, and the pre-token pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.hash, self.ranks, self.pattern = PerfectHash(ranks), ranks, pattern
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tokens: dict[int, bytes] = {i: t for t, i in ranks.items()}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: one probe if it is a token, else merges by rank."""
        whole = self.hash.get(piece)
        if whole is not None:
            return [whole]
        n, rank = len(piece), self.ranks.get
        end = list(range(1, n + 1))  # end[i]: where the span that starts at i ends; 0 once it is merged away
        before = list(range(-1, n - 1))  # start of the span to the left
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, left, stop = heapq.heappop(heap)
            mid = end[left]
            # stale: the left span is gone or has grown, or the right one has
            if not mid or mid >= n or end[mid] != stop:
                continue
            end[left], end[mid] = stop, 0
            if stop < n:
                before[stop] = left
                if (r := rank(piece[left : end[stop]])) is not None:
                    heapq.heappush(heap, (r, left, end[stop]))
            prev = before[left]
            if prev >= 0 and (r := rank(piece[prev:stop])) is not None:
                heapq.heappush(heap, (r, prev, stop))
        ids, at = [], 0
        while at < n:
            one = rank(piece[at : end[at]])
            if one is None:
                raise ValueError(f"the vocabulary has no token for byte {piece[at]}")
            ids.append(one)
            at = end[at]
        return ids

    def packed(self, piece: str) -> bytes:
        """:meth:`merge`, packed, and remembered if the piece is short.

        A full generation becomes the older one, so pieces that come again and again are never forgotten.
        """
        out = self.older.get(piece)
        if out is None:
            ids = self.merge(piece.encode("utf-8", "replace"))
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(piece) <= 64:
            if len(self.memo) >= MEMO:
                self.older = self.memo.copy()
                self.memo.clear()
            self.memo[piece] = out
        return out


class Splitter:
    """The matches of a pre-token pattern, a bounded number at a time.

    The pattern's own classes decide everywhere.  For texts in Latin script alone they are spelt out as
    character ranges, which the standard library's engine matches several times faster.
    """

    def __init__(self, pattern: str):
        self.full = regex.compile(pattern)
        classes = {r"\p{L}": _LATIN_LETTERS, r"\p{N}": _LATIN_DIGITS, r"\s": _LATIN_SPACES}
        latin = pattern.replace(r"\S", "[^" + _LATIN_SPACES + "]").replace(r"[^\s\p{L}\p{N}]", "[^" + "".join(classes.values()) + "]")
        for name, ranges in classes.items():
            latin = latin.replace(name, "[" + ranges + "]")
        self.latin = None if "\\p" in latin else re.compile(latin)

    def __call__(self, text: str) -> Iterator[list[str]]:
        if self.latin and _LATIN.fullmatch(text):
            pattern, shown = self.latin, text
        else:
            pattern, shown = self.full, _NEW.sub("\ufffd", text)
        if len(text) <= LONG and shown == text:
            yield pattern.findall(text)
            return
        found = (text[m.start() : m.end()] for m in pattern.finditer(shown))
        while part := list(islice(found, CHUNK)):
            yield part


def shared_vocabulary(spark: SparkSession, path: str, pattern: str):
    """A broadcast :class:`Vocabulary`; a rank file is a fixed model of a few MB, whatever the corpus."""
    return spark.sparkContext.broadcast(Vocabulary(read_ranks(path), pattern))


def encode(docs: DataFrame, vocabulary, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns, ``ids`` (binary: little-endian unsigned 32-bit token ids), ``n_tokens`` and ``ids_sha256``.

    Every match of the pattern is encoded by itself and no special tokens are recognised.  ``vocabulary``
    is what :func:`shared_vocabulary` returns.  Null text counts as empty: no ids.  Repeated rows stay
    repeated; carried columns may have any names but those three, which win.
    """

    def make():
        vocab, split = vocabulary.value, Splitter(vocabulary.value.pattern)
        get, packed = vocab.memo.get, vocab.packed

        def one(raw: bytes | None) -> tuple:
            out = []
            for part in split(raw.decode("utf-8", "replace") if raw else ""):
                out.append(b"".join([get(p) or packed(p) for p in part]))
            return (b"".join(out),)

        return one

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    df = map_text(docs, text, T.StructType([T.StructField("ids", T.BinaryType())]), make, carry)
    own = {"ids": F.col("ids"), "n_tokens": F.expr("CAST(octet_length(ids) / 4 AS BIGINT)"), "ids_sha256": F.sha2("ids", 256)}
    return df.select(*[F.col(f"carry.`{c}`").alias(c) for c in carry if c not in own], *[x.alias(n) for n, x in own.items()])


def decode(encoded: DataFrame, vocabulary, ids: str = "ids", carry: list[str] | None = None) -> DataFrame:
    """The carried columns and ``bytes``, the concatenated token bytes of packed ids (null: empty)."""

    def make():
        tokens = vocabulary.value.tokens

        def one(raw: bytes | None) -> tuple:
            raw = raw or b""
            parts = []
            for at in range(0, len(raw), 4 * CHUNK):
                part = raw[at : at + 4 * CHUNK]
                parts.append(b"".join(map(tokens.__getitem__, struct.unpack(f"<{len(part) // 4}I", part))))
            return (b"".join(parts),)

        return one

    carry = [c for c in encoded.columns if c != ids] if carry is None else carry
    df = map_text(encoded, ids, T.StructType([T.StructField("bytes", T.BinaryType())]), make, carry)
    return df.select(*[F.col(f"carry.`{c}`").alias(c) for c in carry if c != "bytes"], "bytes")
