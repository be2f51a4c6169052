import math
import random
import re
from collections import Counter

from pyspark.sql import functions as F

from embedflow.llm import quality as q
from tests.conftest import SF_SMALL
from tests.llm.helpers import clashing, docs, odd


def base(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    again = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 3)}
    n = len(words)
    failed = n < 50 or 100 * len(again) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again), failed


def random_texts(n=80):
    rnd = random.Random(6)
    out = []
    for _ in range(n):
        words = ["".join(rnd.choice("abcé#") for _ in range(rnd.randint(1, 2))) for _ in range(6)]
        out.append("".join(rnd.choice(words) + rnd.choice(" \n\t\x0b  ") for _ in range(rnd.randint(0, 120))))
    return out


def test_base_counts_against_brute_force(spark):
    texts = random_texts() + [" ".join(f"w{i}" for i in range(60)), "a b c a b c", "a a a a", "x y", "a\n\na\na \n \n"]
    rows = q.described(docs(spark, texts), "text", ["doc_id"]).collect()
    assert {r.carry.doc_id: tuple(r[c] for c in q.BASE) for r in rows} == {i: base(t) for i, t in enumerate(texts)}


def em(patterns, rules):
    prior, acc, last = q.FIRST_PRIOR, [(q.FIRST_ACCURACY, q.FIRST_ACCURACY)] * rules, None
    post = {}
    for _ in range(q.STEPS + 1):
        for p in patterns:
            g, b = prior, 1 - prior
            for v, (on_good, on_bad) in zip(p, acc):
                g *= {1: on_good, -1: 1 - on_good, 0: 1}[v]
                b *= {1: 1 - on_bad, -1: on_bad, 0: 1}[v]
            post[p] = g / (g + b)
        flat = [prior, *(x for a in acc for x in a)]
        if _ == q.STEPS or last and max(abs(x - y) for x, y in zip(flat, last)) < q.TOLERANCE:
            return prior, acc, post
        last = flat
        total = sum(patterns.values())
        prior = (sum(post[p] * n for p, n in patterns.items()) + q.SMOOTHING * q.FIRST_PRIOR) / (total + q.SMOOTHING)
        fresh = []
        for i in range(rules):
            s = lambda v, good: sum((post[p] if good else 1 - post[p]) * n for p, n in patterns.items() if p[i] == v)
            share = lambda r, w: (r + q.SMOOTHING * q.FIRST_ACCURACY) / (r + w + q.SMOOTHING)
            fresh.append((share(s(1, True), s(-1, True)), share(s(-1, False), s(1, False))))
        acc = fresh


def test_posterior_against_brute_force(spark):
    rows = q.judged(spark.read.parquet(f"{SF_SMALL}/documents.parquet")).collect()
    patterns = Counter(tuple(r.votes) for r in rows)
    prior, acc, post = em(patterns, len(q.RULES))
    for r in rows:
        assert abs(r.posterior - post[tuple(r.votes)]) < 1e-6
        assert r.kept == (not r.base_failed and r.posterior >= q.THRESHOLD)


def test_accuracies_are_recovered(spark):
    rnd = random.Random(2)
    truth = [(0.95, 0.9), (0.9, 0.8), (0.85, 0.95), (0.97, 0.7), (0.6, 0.6)]
    patterns = Counter()
    for _ in range(20_000):
        good = rnd.random() < 0.85
        patterns[tuple(0 if rnd.random() < 0.1 else (1 if good else -1) * (1 if rnd.random() < a[not good] else -1) for a in truth)] += 1
    df = spark.createDataFrame([(list(p), float(n)) for p, n in patterns.items()], "votes array<int>, n double")
    model = q.estimate(df, len(truth), steps=60)
    assert abs(model["prior"] - 0.85) < 0.03
    assert all(abs(a - b) < 0.06 for x, y in zip(model["accuracy"], truth) for a, b in zip(x, y))


def test_good_documents_stay_and_junk_goes(spark):
    d = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL.replace('0.001', '0.01')}/labels.parquet")
    rows = q.judged(d).select("carry.doc_id", "n_words", "base_failed", "kept").join(labels, "doc_id").collect()
    long = [r for r in rows if not r.base_failed]
    good = [r.kept for r in long if r.quality == 1]
    assert sum(good) / len(good) > 0.98
    assert all(not r.kept for r in rows if r.base_failed)


def test_odd_rows(spark):
    df = clashing(odd(spark))
    rows = q.judged(df).collect()
    assert len(rows) == df.count() and not any(r.kept for r in rows)
    assert [r.posterior is not None and not math.isnan(r.posterior) for r in rows] == [True] * len(rows)
    assert q.good_documents(df).columns == df.columns
    assert q.judged(docs(spark, [])).count() == 0
    text = " ".join(f"word{i}" for i in range(200))
    twice = docs(spark, [text, text], [1, 1])
    assert q.good_documents(twice).count() == 2


def test_only_sql_functions(spark):
    plan = q.described(docs(spark, ["a"]).withColumn("text", F.col("text")), "text", ["doc_id"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
