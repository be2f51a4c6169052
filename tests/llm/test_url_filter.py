import re
from collections import defaultdict

import pytest

from embedflow.llm import url_filter as u
from tests.conftest import SF_SMALL
from tests.llm.helpers import clashing

PAGES = "page_id long, url string, html string"


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = [(len(h + p), h + p, k) for k, h, p in u.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits, default=(0, None, None))[1:]


def brute(pages):
    """Rule, verdict and distrust share by page, with dictionaries."""
    parsed = [parse(url) for _, url, _ in pages]
    ruled = [rule(*x) for x in parsed]
    w = defaultdict(float)
    nodes = {h for h, _ in parsed if h}
    for (_, _, html), (host, _) in zip(pages, parsed):
        if host:
            for dst in {x for x in re.findall(u.LINK, (html or "").lower())}:
                dst = dst.lower()
                if dst != host:
                    w[host, dst] += 1
                    nodes.add(dst)
    up = set()
    for n in nodes:
        labels = n.split(".")
        for i in range(len(labels) - 2):
            up.add((".".join(labels[i:]), ".".join(labels[i + 1 :])))
    for a, b in up:
        w[a, b] += 1
        w[b, a] += 1
    scores = {}
    for kind, verdict, edges in (("trust", "allow", dict(w)), ("distrust", "block", {(b, a): x for (a, b), x in w.items()})):
        seed = defaultdict(float)
        total = sum(r[1] == verdict for r in ruled)
        for (h, _), r in zip(parsed, ruled):
            if r[1] == verdict:
                seed[h] += 1 / total
        out = defaultdict(float)
        for (a, _), x in edges.items():
            out[a] += x
        score = dict(seed)
        for _ in range(u.STEPS):
            new = defaultdict(float, {h: (1 - u.DAMPING) * m for h, m in seed.items()})
            for (a, b), x in edges.items():
                if a in score:
                    new[b] += u.DAMPING * x / out[a] * score[a]
            score = new
        scores[kind] = score
    rows = []
    for (page_id, _, _), (h, p), (name, verdict) in zip(pages, parsed, ruled):
        t, d = scores["trust"].get(h), scores["distrust"].get(h)
        share = None if t is None and d is None else (d or 0) / ((t or 0) + (d or 0))
        rows.append((page_id, h, p, name, verdict or ("block" if share is not None and share >= u.THRESHOLD else "allow"), share))
    return rows


def same(got, want):
    key = lambda r: tuple(str(x) for x in r[:5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for a, b in zip(got, want):
        assert (a[5] is None) == (b[5] is None) and (a[5] is None or abs(a[5] - b[5]) < 1e-9)


ODD = [
    (1, None, None),
    (2, "", "<a href='http://a.net/'>"),
    (3, "no scheme/en/", "x"),
    (4, "http://", None),
    (5, "HTTP://WWW.Example.NET/en/1?x=http://b.org/fr/", '<a href="https://b.org/fr/x">b</a><a href=//spam.com/>'),
    (5, "HTTP://WWW.Example.NET/en/1?x=http://b.org/fr/", '<a href="https://b.org/fr/x">b</a><a href=//spam.com/>'),
    (6, "http://spam.com?q", '<a href="http://evil.net/">'),
    (7, "http://evil.net/x", ""),
    (8, "http://example.net", None),
    (9, "x://y.org/fr/://z.net/", None),
    (None, "http://lonely/", None),
    (11, "http://notexample.com/de/", None),
    (12, "http://a.example.com/de/", "<A HREF='http://SPAM.com#x'>"),
    (13, "http://linked.io/", None),
    (14, "http://net/", None),
]


def test_rules_and_scores_against_brute_force(spark):
    got = [tuple(r) for r in u.judged(clashing(spark.createDataFrame(ODD, PAGES))).collect()]
    same(got, brute(ODD))
    verdict = {r[0]: r[4] for r in got}
    assert verdict[6] == "block" and verdict[13] == "allow" and verdict[14] == "block"


def test_given_pages_against_brute_force(spark):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    want = brute([tuple(r) for r in pages.select("page_id", "url", "html").collect()])
    same([tuple(r) for r in u.judged(pages).collect()], want)
    assert {r[4] for r in want if r[3] is None} == {"allow", "block"}


def test_empty_and_unseeded(spark):
    assert u.judged(spark.createDataFrame([], PAGES)).count() == 0
    rows = u.judged(spark.createDataFrame([(1, "http://a.io/", None), (2, "http://b.a.io/", None)], PAGES)).collect()
    assert [(r.verdict, r.distrust) for r in rows] == [("allow", None)] * 2


def test_hosts_far_from_every_seed(spark, monkeypatch):
    """Distrust reaches the end of a chain, and trust at its other end only takes over where it is nearer."""
    far = [(0, "http://spam.net/", None)] + [(i, f"http://h{i}.io/", f"<a href='http://{'spam.net' if i == 1 else f'h{i - 1}.io'}/'>") for i in range(1, 41)]
    rows = {r.id: r for r in u.judged(spark.createDataFrame(far, PAGES)).collect()}
    assert [(rows[i].verdict, rows[i].distrust) for i in range(1, 41)] == [("block", 1.0)] * 40
    both = [(i, f"http://h{i}.io/", f"<a href='http://h{i - 1}.io/'><a href='http://h{i + 1}.io/'>") for i in range(1, 21)]
    both += [(0, "http://spam.net/", "<a href='http://h1.io/'>"), (21, "http://good.org/fr/", "<a href='http://h20.io/'>")]
    both += [(22, "http://h0.io/", "<a href='http://spam.net/'>"), (23, "http://h21.io/", "<a href='http://good.org/'>")]
    df = spark.createDataFrame(both, PAGES)
    same([tuple(r) for r in u.judged(df).collect()], brute(both))
    monkeypatch.setattr(u, "DAMPING", 0.3)  # fewer steps
    same([tuple(r) for r in u.judged(df, damping=0.3, small=0).collect()], brute(both))


@pytest.mark.parametrize("share", [0.05, 2.0])
def test_a_graph_dealt_by_host_gives_the_same(spark, monkeypatch, share):
    """The form for large graphs, with some hosts and with none of them a hub; a step's edges are read from their buckets as they lie."""
    plans = []
    real = u.written

    def spy(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(u, "written", spy)
    monkeypatch.setattr(u, "DAMPING", 0.3)
    monkeypatch.setattr(u, "HUB_SHARE", share)
    same([tuple(r) for r in u.judged(spark.createDataFrame(ODD, PAGES), damping=0.3, small=0).collect()], brute(ODD))
    steps = [p for name, p in plans if name == "scores" and "Bucketed: true" in p]
    assert len(steps) > 10
    for plan in steps:
        scan = plan[plan.index("SortMergeJoin") :].split("Bucketed: true")[0]
        assert scan.count("Exchange hashpartitioning") <= 1  # the scores'


def test_small_graphs_take_no_shuffle_a_step(spark, monkeypatch):
    plans = []
    real = u.written
    monkeypatch.setattr(u, "written", lambda df, name: (plans.append((name, df._jdf.queryExecution().executedPlan().toString())), real(df, name))[1])
    monkeypatch.setattr(u, "DAMPING", 0.3)
    same([tuple(r) for r in u.judged(spark.createDataFrame(ODD, PAGES), damping=0.3).collect()], brute(ODD))
    steps = [p for name, p in plans if name == "scores" and "Join" in p][1:]
    assert steps and all("Exchange" not in p for p in steps)
