import random
import re
from itertools import combinations

import pytest
import xxhash

from embedflow.llm import simhash
from embedflow.llm.graph import connected_components
from tests.llm.helpers import clashing, docs, odd

MASK = (1 << 64) - 1


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_is_the_definition():
    rnd = random.Random(3)
    for _ in range(60):
        text = "".join(rnd.choice("ab cD\n\té \x1c\x85") for _ in range(rnd.randint(0, 80)))
        assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(b" \n") == 0


def test_chunks_do_not_change_the_fingerprint(monkeypatch):
    text = " ".join(f"w{i % 97}" for i in range(1000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "CHUNK", 7)
    assert simhash.fingerprint(text) == whole


@pytest.mark.parametrize("max_bits,hot_key", [(3, 1024), (3, 2), (1, 4), (2, 1), (5, 3)])
def test_links_are_all_near_pairs(spark, max_bits, hot_key):
    rnd = random.Random(max_bits * 100 + hot_key)
    fps = {0, MASK}
    for _ in range(6):
        centre = rnd.getrandbits(64)
        few = [rnd.randrange(64) for _ in range(9)]
        for _ in range(20):
            fps.add(centre ^ sum({1 << b for b in rnd.sample(few, rnd.randint(0, 7))}))
        fps.add(centre ^ (1 << rnd.randrange(64)))
    fps |= {rnd.getrandbits(64) for _ in range(100)}
    want = {tuple(sorted((signed(a), signed(b)))) for a, b in combinations(fps, 2) if (a ^ b).bit_count() <= max_bits}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp long")
    got = [(r.u, r.v) for r in simhash.links(df, max_bits, hot_key).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_refined_keys_are_bounded():
    for mask in simhash._key_masks(3):
        free = 64 - mask.bit_count()
        assert all(free - m.bit_count() <= 9 for m in simhash._refining(mask, 3))


def test_bad_distance():
    with pytest.raises(ValueError):
        simhash._key_masks(8)


def test_components_of_paths_and_stars(spark):
    rnd = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 201)]
    rnd.shuffle(edges)
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    pairs = [e for e in edges if None not in e and e[0] != e[1]]
    assert got == components({n for e in pairs for n in e}, pairs)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def near_texts():
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 7)))
    texts = []
    for _ in range(5):
        base = [word() for _ in range(300)]
        for _ in range(8):
            copy = list(base)
            for _ in range(rnd.randint(0, 2)):
                copy[rnd.randrange(300)] = word()
            texts.append(" ".join(copy))
    return texts + [" ".join(word() for _ in range(50)) for _ in range(20)] + ["", "", "Short One", "short one"]


def test_near_duplicates_against_brute_force(spark):
    texts = near_texts()
    fps = [slow_fingerprint(t) for t in texts]
    pairs = [(i, j) for i, j in combinations(range(len(texts)), 2) if (fps[i] ^ fps[j]).bit_count() <= 3]
    want = components(range(len(texts)), pairs)
    assert len(set(want.values())) < len(texts)
    for hot_key in (1024, 2):
        rows = simhash.digest(simhash.near_duplicates(docs(spark, texts), carry=[], hot_key=hot_key)).collect()
        assert {r.doc_id: r.component_id for r in rows} == want
        assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in enumerate(fps)}


def test_one_of_each_group_stays(spark):
    texts = near_texts()
    want = sorted(set(r.component_id for r in simhash.near_duplicates(docs(spark, texts)).collect()))
    df = clashing(docs(spark, texts))
    kept = simhash.one_of_each_group(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_odd_rows(spark):
    df = odd(spark)
    rows = simhash.near_duplicates(df).collect()
    assert len(rows) == df.count()
    by_id = {r.id: r for r in rows}
    assert by_id[0].component_id == by_id[1].component_id == by_id[2].component_id == by_id[None].component_id == 0
    assert by_id[6].component_id == by_id[7].component_id == 6
    kept = simhash.one_of_each_group(df)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4, 5, 6, 8, 9]
    nameless = docs(spark, ["q w e", "q w e", "r t z u i o"], [None, None, None])
    assert [r.text for r in simhash.one_of_each_group(nameless).orderBy("text").collect()] == ["q w e", "r t z u i o"]
    twice = docs(spark, ["first text of five words", "another text altogether here"], [5, 5])
    assert simhash.one_of_each_group(twice).count() == 2
    empty = docs(spark, [])
    assert simhash.near_duplicates(empty).count() == 0 and simhash.one_of_each_group(empty).count() == 0
