"""Secret scans: fixed patterns, and sliding-window entropy of candidate strings.

Added spans come from candidate strings (runs of characters that keys are made of).  Over each candidate a
window slides; the counts of its characters, and with them its Shannon entropy, change by one character
in and one out per step.  A window whose entropy reaches the threshold of the candidate's character class
is suspicious; suspicious windows of a candidate that overlap make one span.  A candidate is looked at as
a whole and then in pieces, cut at ever more separators: a key that something is attached to is judged by
its own characters.  What is on the allow-list, candidate or piece, adds nothing as it stands; its pieces may.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .textmap import map_text

ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE
)
#: Any of these, lower-cased, is in every text that ASSIGN can match.
ASSIGN_HINTS = ("passw", "secret", "token", "api")
# The length floors are in the patterns: a run of either alphabet either reaches its floor or fails as a whole.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE = 6
KINDS = ("assign", "access", "hex", "entropy_hex", "entropy_key", "entropy_mixed")

#: Characters of a window, and of a candidate at least.
WINDOW = 20
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Character classes in the order they are tried, with the bits a character from which a window is suspicious.
CLASSES = (
    ("entropy_hex", re.compile(r"[0-9a-f]+|[0-9A-F]+"), 3.0),
    ("entropy_key", re.compile(r"(?=.*[0-9])[A-Z0-9]+|(?=.*[0-9])[a-z0-9]+"), 3.4),
    ("entropy_mixed", re.compile(r"(?=.*[0-9])(?=.*[A-Z])(?=.*[a-z]).+"), 3.7),
    ("entropy_mixed", re.compile(r"(?=.*[0-9])(?=.*[A-Za-z]).+"), 3.7),  # one case, digits and separators
    ("entropy_mixed", re.compile(r"(?=.*[A-Z])(?=.*[a-z])[A-Za-z]+"), 4.0),
)
_UUID = re.compile(r"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
#: The pieces that candidates are cut into, coarse to fine.
SEPARATORS = (re.compile(r"[^=]+"), re.compile(r"[^=_-]+"), re.compile(r"[^=_/-]+"))
#: Candidates that are no secrets: UUIDs, ISO dates and times, one character or a short unit repeated, and the
#: alphabets that documentation uses.
ALLOWED = (
    re.compile(r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"),
    re.compile(r"\d{4}-\d\d-\d\d[T_-]?[\d_-]*"),
    re.compile(r"(.{1,8}?)\1{2,}.{0,7}"),
    re.compile(r".*(0123456789|abcdefghij|ABCDEFGHIJ|EXAMPLE|example).*"),
)
_TERM = [0.0, *(c * math.log2(c) for c in range(1, 4097))]


def entropies(s: str, window: int = WINDOW) -> Iterator[float]:
    """Shannon entropy, in bits a character, of every window of ``s`` (of all of it, if it is shorter)."""
    size = min(window, len(s))
    if not size:
        return
    counts: dict[str, int] = {}
    total = 0.0  # sum of c * log2(c)
    for i, c in enumerate(s):
        n = counts.get(c, 0)
        total += _TERM[n + 1] - _TERM[n]
        counts[c] = n + 1
        if i >= size:
            gone = s[i - size]
            n = counts[gone]
            total += _TERM[n - 1] - _TERM[n]
            counts[gone] = n - 1
        if i >= size - 1:
            yield math.log2(size) - total / size


def _suspicious(s: str, window: int, allowed, classes) -> Iterator[tuple[int, int, str]]:
    if any(a.fullmatch(s) for a in allowed):
        return
    for kind, chars, least in classes:
        if chars.fullmatch(s):
            break
    else:
        return
    begin = stop = None
    for i, h in enumerate(entropies(s, window)):
        if h >= least - 1e-9:
            if begin is not None and i > stop:
                yield begin, stop, kind
                begin = None
            begin = i if begin is None else begin
            stop = min(i + window, len(s))
    if begin is not None:
        yield begin, stop, kind


class _Cover:
    """Does some span of a set contain another one?  A bisection in the greatest ends so far, by start."""

    def __init__(self, spans):
        self.starts, self.ends = [], []
        for a, b, *_ in sorted(spans):
            self.starts.append(a)
            self.ends.append(max(b, self.ends[-1]) if self.ends else b)

    def holds(self, a: int, b: int) -> bool:
        k = bisect.bisect_right(self.starts, a)
        return k > 0 and self.ends[k - 1] >= b


def _entropy_spans(text: str, window: int, allowed, classes, separators) -> Iterator[tuple[int, int, str]]:
    for m in CANDIDATE.finditer(text):
        s = m.group()
        found = list(_suspicious(s, window, allowed, classes))
        cut = _UUID.sub(lambda u: "=" * len(u.group()), s)  # no key is made of parts of UUIDs
        seen = {(0, len(s))}
        for pieces in separators:
            before, new = _Cover(found), []  # spans of one level never contain one another
            for p in pieces.finditer(cut):
                if len(p.group()) < window or p.span() in seen:
                    continue
                seen.add(p.span())
                for a, b, kind in _suspicious(p.group(), window, allowed, classes):
                    a, b = a + p.start(), b + p.start()
                    if not before.holds(a, b):
                        new.append((a, b, kind))
            found += new
        for a, b, kind in found:
            yield m.start() + a, m.start() + b, kind


def find_spans(text: str, window: int = WINDOW, allowed=ALLOWED, classes=CLASSES, separators=()) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` in code points, end exclusive, by start and then kind as listed in ``KINDS``.

    Base kinds are leftmost and non-overlapping each by itself.  An added span that lies inside a base span
    says nothing new and is left out; base spans always stay.  Candidates are also looked at in the pieces
    that ``separators`` make of them (``scan`` and ``redacted``: ``SEPARATORS``); none: as a whole only.
    """
    spans = []
    folded = text.lower()
    if any(h in folded for h in ASSIGN_HINTS):
        spans += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        spans += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    spans += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    base = _Cover(spans)
    spans += [s for s in _entropy_spans(text, window, allowed, classes, separators) if not base.holds(s[0], s[1])]
    return sorted(spans, key=lambda x: (x[0], KINDS.index(x[2]), x[1]))


SPAN = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])


def scan(docs: DataFrame, text: str = "text", carry: list[str] | None = None, window: int = WINDOW) -> DataFrame:
    """``struct carry`` and ``spans`` (kind, start, end) of every row.

    Null counts as empty; empty texts have no spans; repeated rows stay repeated; an empty table gives an
    empty one.  Extra columns travel inside carry.  Spans that start together are in the order of their kinds,
    then ends.  A text takes time in proportion to its length, or n log n in its spans, however long it is.
    """

    def make():
        def one(raw):
            found = find_spans(raw.decode("utf-8", "replace"), window, separators=SEPARATORS) if raw else []
            return ([{"kind": k, "start": a, "end": b} for a, b, k in found],)

        return one

    carry = [c for c in docs.columns if c != text] if carry is None else carry
    return map_text(docs, text, T.StructType([T.StructField("spans", T.ArrayType(SPAN))]), make, carry)


def digest(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of the base spans, and all spans as a string."""
    base = F.filter("spans", lambda x: x["kind"].isin(*KINDS[:3]))
    said = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    number = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("bigint")
    counts = [number(k).alias(f"n_{k}") for k in KINDS[:3]]
    return scanned.select(F.col(f"carry.`{id_col}`").alias("doc_id"), *counts, F.sha2(said(base), 256).alias("base_sha256"), said("spans").alias("spans"))


def redacted(docs: DataFrame, text: str = "text", length: str | None = "n_chars", mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns with every span of their texts (overlaps merged) replaced by ``mask``.

    ``length``, if the table has that column, takes the new number of code points where a text changed.  A
    null text stays null and an empty one empty; repeated rows stay repeated and change alike; an empty table
    stays empty.  All other columns, whatever their names, come back as they were.  Texts of any length are
    masked as a whole, in time as :func:`scan` takes.
    """

    def make():
        def one(raw):
            if raw is None:
                return None, False
            s = raw.decode("utf-8", "replace")
            out, at = [], 0
            for a, b, _ in (spans := find_spans(s, separators=SEPARATORS)):
                if a >= at:
                    out += [s[at:a], mask]
                at = max(at, b)
            return "".join([*out, s[at:]]) if spans else s, bool(spans)

        return one

    out = T.StructType([T.StructField("clean", T.StringType()), T.StructField("changed", T.BooleanType())])
    others = [c for c in docs.columns if c != text]
    done = map_text(docs, text, out, make, others)

    def column(c):
        if c == text:
            return F.col("clean").alias(c)
        old = F.col(f"carry.`{c}`")
        if c == length:
            return F.when(F.col("changed"), F.char_length("clean").cast(docs.schema[c].dataType)).otherwise(old).alias(c)
        return old.alias(c)

    return done.select(*[column(c) for c in docs.columns])
