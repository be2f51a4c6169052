import hashlib
import random
import re

import pytest

from embedflow.llm import decontam
from tests.llm.helpers import clashing, docs, odd

ITEMS = "item_id long, text string"


def words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, items):
    d = words(text)
    hit, names = set(), set()
    for item_id, item in items:
        w = words(item)
        wins = [w[i : i + 13] for i in range(len(w) - 12)] if len(w) >= 13 else [w] if w else []
        for win in wins:
            for k in range(len(d) - len(win) + 1):
                if d[k : k + len(win)] == win:
                    hit |= set(range(k, k + len(win)))
                    if item_id is not None:
                        names.add(str(item_id))
    return len(d), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(d)


def fixture():
    rnd = random.Random(4)
    vocab = ["alpha", "beta", "Gamma", "delta", "é", "中文", "x1", "of", "the"]
    item = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, item(n)) for i, n in enumerate([30, 13, 14, 12, 5, 4, 2, 20, 20])]
    items += [(20, items[0][1]), (21, items[7][1].upper() + "!"), (22, None), (23, "..."), (None, item(15)), (2, items[2][1])]
    texts = []
    for _ in range(60):
        parts = [item(rnd.randint(0, 25))]
        for _ in range(rnd.randint(0, 3)):
            w = words(rnd.choice(items)[1])
            a = rnd.randint(0, max(0, len(w) - 1))
            parts += [" ".join(w[a : a + rnd.randint(1, 30)]), item(rnd.randint(0, 20))]
        texts.append(rnd.choice([" ", ", ", "\n"]).join(parts))
    return items, texts + [None, "", "..", items[0][1].replace(" ", "--"), "the the of"]


@pytest.mark.parametrize("block_rows", [100_000, 9])
def test_against_brute_force(spark, block_rows):
    items, texts = fixture()
    found = decontam.judged(decontam.hit_spans(docs(spark, texts), spark.createDataFrame(items, ITEMS), carry=["doc_id"], block_rows=block_rows))
    got = {r.carry.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in found.collect()}
    assert got == {i: brute(t, items) for i, t in enumerate(texts)}
    assert any(x[1] for x in got.values())


def test_rarest_shingle_is_the_prefix(spark):
    import pyarrow as pa

    words13 = [b" ".join(f"w{i}".encode() for i in range(13))]
    block = decontam._Block(pa.table({"item": ["0"], "words": words13}), 5)
    values = decontam.hashes(block.windows[0], 5).tolist()
    count = {(5, v): 10 for v in values} | {(5, values[4]): 1}
    keys, window, offset = block.prefixes(count)[5]
    assert keys.tolist() == [values[4]] and offset.tolist() == [4]
    assert block.prefixes({k: n for k, n in count.items() if k != (5, values[0])} | {(5, values[0]): 0}) == {}


def test_many_candidates_at_one_place(monkeypatch):
    import numpy as np
    import pyarrow as pa

    wins = [b"a b c d e " + f"x{i} {' '.join(['y'] * 7)}".encode() for i in range(40)]
    block = decontam._Block(pa.table({"item": [str(i) for i in range(40)], "words": wins}), 5)
    shared = decontam.hashes(block.windows[0], 5)[0]
    prefixes = {5: (np.full(40, shared, dtype=np.uint64), np.arange(40), np.zeros(40, dtype=np.int64))}
    doc = decontam._numbers(b" . ".join(wins), block.vocab)
    found = sorted(w for _, ws in decontam._occurrences(doc, block, prefixes) for w in ws.tolist())
    assert found == list(range(40))


def test_clean_documents_stay(spark):
    items, texts = fixture()
    df = clashing(docs(spark, texts))
    kept = decontam.clean_documents(df, spark.createDataFrame(items, ITEMS))
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(texts) if not brute(t, items)[4]}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, "same words here again")], ITEMS)
    df = odd(spark)
    rows = decontam.judged(decontam.hit_spans(df, items)).collect()
    assert len(rows) == df.count() and sum(r.contaminated for r in rows) == 3
    none = spark.createDataFrame([], ITEMS)
    assert not any(r.n_hit for r in decontam.judged(decontam.hit_spans(df, none)).collect())
    assert decontam.hit_spans(docs(spark, []), items).count() == 0
    assert decontam.clean_documents(df, none).count() == df.count()
