"""SimHash near-duplicate groups, with candidates pruned by pigeonring chains.

A fingerprint is read as a ring of eight 8-bit segments.  If two fingerprints differ in at most t bits,
some start on the ring has every chain of l segments from there within t*l/8 bits (the strong pigeonring
form).  Short chains therefore give exact parts to join on: with t = 3 the first two segments (16 bits)
must be equal and the next three (24 bits) may differ in one bit, so one of their two halves is equal.
That makes 28-bit keys, 16 per fingerprint; what they bring together then passes the chain budgets one
after another, the last of which (l = 8) is the Hamming check itself.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .graph import connected_components
from .tables import written
from .textmap import map_text

SHINGLE, MAX_BITS, SEED = 3, 3, 42
SEGMENTS, WIDTH = 8, 8
#: Distinct fingerprints under one key beyond which the key is refined.
HOT_KEY = 1024
#: Parts that a refined key cuts its free bits into.
PARTS = 12
#: Shingles hashed at a time, which bounds a task's memory for a very long text.
CHUNK = 1 << 15


def fingerprint(raw: bytes | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of UTF-8 text: ASCII-lower-cased words, shingles with repeats, XXH64.

    Fewer words than a shingle: the whole sequence is the only shingle.  No words (or null): 0.
    """
    words = raw.lower().split() if raw else []
    if not words:
        return 0
    k = min(shingle, len(words))
    total = len(words) - k + 1
    counts = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, CHUNK):
        part = words[at : min(at + CHUNK, total) + k - 1]
        hashes = np.array([digest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(k)))], dtype="<u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", carry: list[str] | None = None, shingle: int = SHINGLE) -> DataFrame:
    """``struct carry`` and ``fp`` (the fingerprint as a signed long) of every row."""

    def make():
        def one(raw):
            f = fingerprint(raw, shingle)
            return (f - (1 << 64) if f >> 63 else f,)

        return one

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return map_text(docs, text, T.StructType([T.StructField("fp", T.LongType())]), make, carry)


def _long(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _rotated(fp: Column, bits: int) -> Column:
    bits %= 64
    return fp if not bits else F.shiftrightunsigned(fp, bits).bitwiseOR(F.shiftleft(fp, 64 - bits))


def _key_masks(max_bits: int) -> list[int]:
    """Masks, over a fingerprint rotated to its chain's start, of the bits that two linked ones share."""
    if not 1 <= max_bits < SEGMENTS:
        raise ValueError(f"max_bits must be from 1 to {SEGMENTS - 1}")
    budget = [length * max_bits // SEGMENTS for length in range(SEGMENTS + 1)]
    same = max(i for i in range(SEGMENTS + 1) if budget[i] == 0) * WIDTH
    one = max(i for i in range(SEGMENTS + 1) if budget[i] <= 1) * WIDTH
    half = (one - same) // 2
    exact = (1 << same) - 1
    return [exact | ((1 << half) - 1) << (same + half * h) for h in range(2)]


def _chain(a: Column, b: Column, max_bits: int) -> Column:
    """Budgets of the chains from the start of two rotated fingerprints; the longest is the Hamming check."""
    diff = a.bitwiseXOR(b)
    ok = F.lit(True)
    for length in range(1, SEGMENTS + 1):
        part = diff.bitwiseAND(F.lit(_long((1 << WIDTH * length) - 1))) if length < SEGMENTS else diff
        ok = ok & (F.bit_count(part) <= length * max_bits // SEGMENTS)
    return ok


def links(fps: DataFrame, max_bits: int = MAX_BITS, hot_key: int = HOT_KEY) -> DataFrame:
    """``(u, v)``, u < v, of the distinct fingerprints ``fps(fp)`` that differ in at most ``max_bits`` bits.

    The rows of a key that holds more than ``hot_key`` fingerprints aren't compared with each other: their
    free bits are cut into twelve parts, of which all but ``max_bits`` must be equal, and every choice of
    equal parts makes a longer key.  What is left free is so few bits that a refined key holds a bounded
    number of fingerprints (512 for 3 bits), however many near copies there are.
    """
    masks = _key_masks(max_bits)
    starts = [
        F.struct(
            F.lit(s * 2 + h).alias("kind"),
            _rotated(F.col("fp"), WIDTH * s).bitwiseAND(F.lit(_long(mask))).alias("part"),
            _rotated(F.col("fp"), WIDTH * s).alias("r"),
        )
        for s in range(SEGMENTS)
        for h, mask in enumerate(masks)
    ]
    keyed = fps.select(F.explode(F.array(*starts)).alias("k")).select("k.*")
    hot = keyed.groupBy("kind", "part").count().where(F.col("count") > hot_key).select("kind", "part").checkpoint()
    if not hot.isEmpty():
        combos = [(h, c, m) for h, mask in enumerate(masks) for c, m in enumerate(_refining(mask, max_bits))]
        choice = {h: F.array(*[F.struct(F.lit(c).alias("c"), F.lit(_long(m)).alias("m")) for hh, c, m in combos if hh == h]) for h in range(2)}
        fine = (
            keyed.join(hot, ["kind", "part"])
            .select("kind", "part", "r", F.explode(F.when(F.col("kind") % 2 == 0, choice[0]).otherwise(choice[1])).alias("x"))
            .select("kind", "part", "r", F.col("x.c").alias("c"), F.col("r").bitwiseAND(F.col("x.m")).alias("rest"))
        )
        keyed = keyed.join(hot, ["kind", "part"], "left_anti")
        found = _pairs(keyed, ["kind", "part"], max_bits, True).unionByName(_pairs(fine, ["kind", "part", "c", "rest"], max_bits, False))
    else:
        found = _pairs(keyed, ["kind", "part"], max_bits, True)
    return found.distinct()


def _refining(mask: int, max_bits: int) -> list[int]:
    free = [b for b in range(64) if not mask >> b & 1]
    parts = [free[len(free) * i // PARTS : len(free) * (i + 1) // PARTS] for i in range(PARTS)]
    return [sum(1 << b for p in chosen for b in p) for chosen in combinations(parts, PARTS - max_bits)]


def _pairs(keyed: DataFrame, on: list[str], max_bits: int, chained: bool) -> DataFrame:
    a, b = keyed.alias("a"), keyed.alias("b")
    same = F.lit(True)
    for c in on:
        same = same & (F.col(f"a.{c}") == F.col(f"b.{c}"))
    x, y = F.col("a.r"), F.col("b.r")
    near = _chain(x, y, max_bits) if chained else F.bit_count(x.bitwiseXOR(y)) <= max_bits
    # back from the chain's start to the fingerprint as it was
    back = [F.when(F.col("a.kind").isin(2 * s, 2 * s + 1), F.struct(*[_rotated(c, 64 - WIDTH * s).alias(n) for c, n in ((x, "p"), (y, "q"))])) for s in range(SEGMENTS)]
    pair = a.join(b, same & (x < y) & near).select(F.coalesce(*back).alias("w"))
    return pair.select(F.least("w.p", "w.q").alias("u"), F.greatest("w.p", "w.q").alias("v"))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    carry: list[str] | None = None,
    shingle: int = SHINGLE,
    max_bits: int = MAX_BITS,
    hot_key: int = HOT_KEY,
) -> DataFrame:
    """``struct carry``, ``id``, ``fp``, ``root`` (the component) and ``component_id`` of every row of ``docs``.

    component_id is the smallest id that can be reached over links of at most ``max_bits`` differing bits,
    the row's own included.  Copies share a fingerprint and are never paired: links are sought among
    distinct fingerprints, and each row then takes its fingerprint's component.  Null and empty texts have
    fingerprint zero and are linked like any other; a row whose id is null stays, and a component of such
    rows alone has a null component_id; repeated rows stay repeated; an empty table gives an empty one.
    """
    carry = [c for c in docs.columns if c != text] if carry is None else carry
    both = carry if id_col in carry else [*carry, id_col]
    marked = written(fingerprints(docs, text, both, shingle).withColumn("id", F.col(f"carry.`{id_col}`")), "simhash")
    least = marked.groupBy("fp").agg(F.min("id").alias("least")).checkpoint()
    roots = connected_components(links(least.select("fp"), max_bits, hot_key)).withColumnRenamed("node", "fp")
    rooted = least.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    component = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = rooted.select("fp", "root").join(component, "root")
    return marked.join(of_fp, "fp").select("carry", "id", "fp", "root", "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay: of each near-duplicate group the one with the smallest id.

    Null ids come after all others.  Rows that tie on the id leave the least by a hash of all columns, and
    of rows that are alike in every column one stays.  The columns, and their order, are those of ``docs``.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    tagged = docs.select(
        F.struct(*columns).alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text}`").alias("text"),
        F.xxhash64(*[F.coalesce(c.cast("string"), F.lit("\0")) for c in columns]).alias("tie"),
    )
    groups = near_duplicates(tagged, "id", "text", carry=["tie"], **settings)
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", F.col("carry.tie").alias("tie"))).alias("f"))
    chosen = first.select(F.col("f.tie").alias("tie"), _known("f.id").alias("known")).distinct()
    kept = tagged.select("row", "tie", _known("id").alias("known")).join(chosen, ["tie", "known"])
    return kept.dropDuplicates(["tie", "known"]).select("row.*")


def _known(id_col: str):
    return F.coalesce(F.col(id_col).cast("string"), F.lit("\0"))


def digest(groups: DataFrame) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of :func:`near_duplicates`."""
    return groups.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


__all__ = ["digest", "fingerprint", "fingerprints", "links", "near_duplicates", "one_of_each_group"]
