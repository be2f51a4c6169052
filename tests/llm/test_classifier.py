import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from embedflow.llm import classifier as c
from tests.conftest import SF_SMALL
from tests.llm.helpers import clashing, docs, odd

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    d = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    rows = {r.doc_id: r.quality for r in labels.collect()}
    hidden = {i for i in rows if i % 3 == 0}
    scores = c.score(d, labels.where("doc_id % 3 <> 0")).collect()
    assert len(scores) == d.count()
    right = [(r.quality_score >= c.THRESHOLD) == (rows[r.id] == 1) for r in scores if r.id in hidden]
    assert sum(right) / len(right) > 0.95
    assert all(0 <= r.quality_score <= 1 for r in scores)


def test_a_view_teaches_the_other(spark):
    """The text view alone can't tell the classes of most labelled rows; metadata can, and teaches it the words."""
    rnd = random.Random(3)
    rows, labels = [], []
    for i in range(600):
        good = rnd.random() < 0.5
        words = ["fine"] * 6 if good else ["poor"] * 6
        noise = [rnd.choice(["aa", "bb", "cc"]) for _ in range(20)]
        rows.append((i, " ".join((words if i >= 60 else []) + noise), "en", "good" if good else "bad", 100))
        if i < 60:
            labels.append((i, int(good), 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    scores = c.score(df, spark.createDataFrame(labels, LABELS)).collect()
    truth = {r[0]: r[3] == "good" for r in rows}
    late = [(r.text_score >= 0.5) == truth[r.id] for r in scores if r.id >= 60]
    assert sum(late) / len(late) > 0.9


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (1, 1, 0)], [(0, None, None), (None, 1, 0), (1, 7, 0)]])
def test_nothing_to_learn(spark, labels):
    df = clashing(odd(spark))
    rows = c.score(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == df.count()
    good = sum(1 for x in labels if x[0] is not None and x[1] == 1)
    assert {round(r.quality_score, 9) for r in rows} == {round((good + 1) / (good + 2), 9)}


def test_odd_rows_are_scored(spark):
    from pyspark.sql import functions as F

    texts = [("good words of many kinds " * 3 + str(i)) if i % 2 else "!! ## " * 9 for i in range(80)]
    more = odd(spark).withColumns({"source": F.lit(None).cast("string"), "n_chars": F.lit(None).cast("long"), "doc_id": F.col("doc_id") + 1000})
    df = docs(spark, texts).unionByName(more)
    labels = [(i, i % 2, 0) for i in range(80)] * 2
    rows = c.score(df, spark.createDataFrame(labels, LABELS)).collect()
    assert len(rows) == df.count() and all(0 <= r.quality_score <= 1 for r in rows)
    assert c.score(docs(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


def _newton(x, y, weight, centre, strength, loose):
    """Weights where the weighted logistic loss plus ``strength / 2`` times the squares off ``centre`` is least; ``loose`` ones are free."""
    w, strength = centre.copy(), np.where(loose, 0.0, strength)
    for _ in range(60):
        p = 1 / (1 + np.exp(-(x @ w)))
        slope = x.T @ (weight * (p - y)) + strength * (w - centre)
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + np.diag(strength) + 1e-12 * np.eye(len(w)), slope)
        w = w - step / max(1.0, np.abs(step).max() / 2)
    return w


def test_against_brute_force(spark):
    """Co-training over dense matrices, each fit by Newton's method to the end, gives the same scores."""
    from pyspark.sql import functions as F

    rnd = random.Random(11)
    good_words, bad_words, plain = ["calm", "Clear", "exact"], ["spam", "CLICK", "win"], ["of", "the", "and", "to"]
    rows, truth = [], []
    for i in range(160):
        good = rnd.random() < 0.5
        own = good_words if good else bad_words
        words = [rnd.choice(own if rnd.random() < 0.3 else plain) for _ in range(rnd.randint(5, 30))]
        source = f"s{rnd.randint(0, 2) + (0 if good else 3) if rnd.random() < 0.9 else 9}"
        rows.append((i, " ".join(words), rnd.choice(["en", "fr"]), source, rnd.randint(1, 500)))
        truth.append(int(good))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").cache()
    labels = spark.createDataFrame([(i, truth[i], 0) for i in range(0, 160, 2)], LABELS)
    got = {r.id: r for r in c.score(df, labels, confidence=0.8, iterations=200, tolerance=1e-10).collect()}

    hashed = df.select(F.xxhash64("doc_id").alias("i"), F.xxhash64("source").alias("s"), F.xxhash64("lang").alias("l")).collect()
    held = np.array([h.i % c.HELD_OUT_IN == 0 and i % 2 == 0 for i, h in enumerate(hashed)])
    y = np.array([truth[i] if i % 2 == 0 else np.nan for i in range(160)])

    def view(bags, figures):
        names = sorted({k for b in bags for k in b})
        x = np.array([[b.get(k, 0.0) for k in names] for b in bags])
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        f, spread = np.array(figures), np.std(figures, axis=0)
        return np.column_stack([x, (f - f.mean(axis=0)) / np.where(spread > 1e-9, spread, 1.0), np.ones(len(x))])

    bags = []
    for _, text, *_ in rows:
        words = text.lower().split()
        cased = list(zip(text.split(), text.split()[1:]))
        found = Counter(zlib.crc32(f"{w} ".encode()) % 65536 for w in words)
        found.update(zlib.crc32(f"{a} {b}".lower().encode()) % 65536 for a, b in cased)
        bags.append({k: round(12 * math.log2(1 + n)) / 12 for k, n in found.items()})
    meta = [{("s", h.s % c.SOURCE_BUCKETS): 1.0, ("l", h.l % c.LANG_BUCKETS): 1.0} for h in hashed]
    lengths = [[math.log1p(r[4]), math.log1p(r[4]) ** 2] for r in rows]
    x = {"text": view(bags, [c.text_features(r[1].encode())[2] for r in rows]), "meta": view(meta, lengths)}

    def fit(v, labels, weight):
        used, n = weight > 0, x[v].shape[1]
        total = weight[used].sum()
        return _newton(x[v][used], labels[used], weight[used] / total, np.zeros(n), c.REGULARISATION, np.arange(n) == n - 1)

    weight = np.where(np.isnan(y) | held, 0.0, 1.0)
    models = {v: fit(v, y, weight) for v in x}
    for _ in range(c.ROUNDS):
        taught = {}
        for v, teacher in (("text", "meta"), ("meta", "text")):
            odds = x[teacher] @ models[teacher]
            sure = np.isnan(y) & (np.abs(odds) >= math.log(4))
            assert sure.any()
            taught[v] = fit(v, np.where(sure, odds > 0, y), np.where(sure, c.PSEUDO_WEIGHT, weight))
        models = taught
    final = {}
    for v in x:
        odds = np.column_stack([np.ones(160), x[v] @ models[v]])
        final[v] = odds @ _newton(odds[held], y[held], np.ones(held.sum()), np.array([0.0, 1.0]), 1.0, np.zeros(2, bool))
    prior = (np.nansum(y) + 1) / ((~np.isnan(y)).sum() + 2)
    both = final["text"] + final["meta"] - math.log(prior / (1 - prior))
    for i in range(160):
        want = [1 / (1 + math.exp(-z)) for z in (final["text"][i], final["meta"][i], both[i])]
        assert [got[i].text_score, got[i].metadata_score, got[i].quality_score] == pytest.approx(want, abs=2e-3)


@pytest.mark.parametrize("small", [0, c.SMALL_LABELS])
def test_labels_joined_either_way(spark, small, monkeypatch):
    monkeypatch.setattr(c, "SMALL_LABELS", small)
    df = docs(spark, ["one text", "", None, "one text"])
    labels = spark.createDataFrame([(0, 1, 0), (0, 0, 0), (2, 0, 0), (9, 1, 0), (None, 1, 0)], LABELS)
    found = {r.id: r.label for r in c._features(df, labels).collect()}
    assert found == {0: 1.0, 1: None, 2: 0.0, 3: None}


def test_features_of_long_and_empty_texts():
    at, by, figures = c.text_features(b"".join(b"w%d " % i for i in range(200_000)))
    assert len(at) == 2 * len(by) <= 2 * c.WORD_BUCKETS and len(figures) == c.FIGURES["text"]
    assert c.text_features(None) == c.text_features(b"") and c.text_features(b"")[:2] == (b"", b"")
