import hashlib
import random
import re
import zlib

import pytest

from embedflow.llm import periodic, queries

from .helpers import ODD_TEXTS, clashing, docs, odd


def brute_runs(words):
    """Every stretch with a period, for every period; the smallest period of each."""
    n, best = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and j > i:
                best.setdefault((i, length), q)
            i = max(j, i) + 1
    return sorted((s, ln, q) for (s, ln), q in best.items())


def brute_collapsed(words, runs):
    gone = {k for s, ln, q in runs for k in range(s + q, s + ln)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def planted(rng):
    """Words with runs of many periods, nested, adjacent and interrupted."""
    out = []
    while len(out) < rng.choice([5, 40, 300, 1500]):
        kind = rng.random()
        q = rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 15, 16, 17, 31, 33, 60, 64, 100])
        block = [rng.choice("abcde" if kind < 0.5 else "ab") for _ in range(q)]
        if kind < 0.2 and q > 4:  # a periodic block inside a longer period
            block[: q // 2] = [block[0]] * (q // 2)
        times = rng.choice([1, 2, 3, 4, 5, 9])
        stretch = block * times + block[: rng.randrange(q + 1)]
        if kind > 0.85:
            stretch[rng.randrange(len(stretch))] = "z"
        out += stretch
    return out


def test_small_cases():
    assert brute_runs("a a a a a a".split()) == [(0, 6, 1)]
    _, runs, collapsed = periodic.runs_of_texts([b"x a a a a a a y", b" \t", b"a b a b a b a b c", b"a a a a a"])
    assert [r.tolist() for r in runs] == [[[1, 6, 1]], [], [[0, 8, 2]], []]
    assert collapsed == [b"x a y", b"", b"a b c", b"a a a a a"]


@pytest.mark.parametrize("seed", range(12))
def test_runs_equal_brute_force(seed):
    rng = random.Random(seed)
    texts = [planted(rng) for _ in range(15)]
    counts, runs, collapsed = periodic.runs_of_texts([" \n".join(t).encode() for t in texts])
    for t, n, got, kept in zip(texts, counts, runs, collapsed):
        want = brute_runs(t)
        assert n == len(t)
        assert [tuple(r) for r in got.tolist()] == want
        assert kept.decode() == brute_collapsed(t, want)


def test_binary_words_of_all_small_lengths():
    rng = random.Random(5)
    texts = [[rng.choice("ab") for _ in range(n)] for n in range(0, 60) for _ in range(8)]
    _, runs, _ = periodic.runs_of_texts([" ".join(t).encode() for t in texts])
    for t, got in zip(texts, runs):
        assert [tuple(r) for r in got.tolist()] == brute_runs(t)


def test_long_periods():
    rng = random.Random(9)
    block = [str(rng.random()) for _ in range(5000)]
    text = ["start"] + block * 4 + ["end"] + ["w"] * 100_000
    _, runs, _ = periodic.runs_of_texts([" ".join(text).encode()])
    assert [tuple(r) for r in runs[0].tolist()] == [(1, 20_000, 5000), (20_002, 100_000, 1)]


def test_odd_rows(spark):
    rows = odd(spark)
    got = periodic.scan(clashing(rows)).select("carry.doc_id", "n_words", "runs", "collapsed").collect()
    assert len(got) == rows.count()
    texts = {i: (t or "") for i, t in enumerate(ODD_TEXTS)} | {None: ""}
    for r in got:
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id])
        runs = brute_runs(words) if len(words) < 1000 else [(0, len(words), 1)]
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(words), runs)
        assert r.collapsed == brute_collapsed(words, runs)
    assert periodic.scan(rows.limit(0)).count() == 0
    assert periodic.digest(periodic.scan(rows)).where("doc_id = 9").first().asDict()["exponent_milli"] == 20_000_000


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(planted(rng)) for _ in range(60)] + [None, "", "  ", "one"] * 5
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op13_periodic_runs"](spark, str(tmp_path)).collect()}
    changed = 0
    for doc_id, text in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            changed += 1
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join("%d,%d,%d\n" % x for x in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, runs).encode()).hexdigest()
    assert changed > 3
