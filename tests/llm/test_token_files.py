import heapq
import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from embedflow.llm import huffman, queries, token_files, token_ids

from .helpers import ODD_TEXTS, clashing, docs, odd

PATH = queries.word_tokenizer()


def whole(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return [t.encode(x, add_special_tokens=False).ids for x in texts]


def hostile(rng):
    alphabets = ["abcXYZ", "ab'stdm", "<|endoftext|>startof", "é É ß Ñ µ ª", "ȩ́ Å", "中文字", "0123 ½²", "!?.,;()[]{}<>@#%&*_-", " \n\t\r\x0b\x0c\x1c\x85  ", "\U0001f600‍\x00İıΣςσ"]
    out = []
    for _ in range(rng.randrange(1, 12)):
        out.append("".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(1, 9))))
    return rng.choice(["", " ", "\n"]).join(out)


def test_chunks_give_the_ids_of_the_whole_text():
    rng = random.Random(1)
    texts = [hostile(rng) for _ in range(4000)]
    texts += ["<|endoftext|>", "a<|endoftext|>b", " <|startoftext|> x", "It's I'll 'tis 'S rock'n'roll (l'été) don't.", "İstanbul STRASSE ßẞ", "w" * 500, *(x for x in ODD_TEXTS if x)]
    with open(PATH, encoding="utf-8") as f:
        encoder = token_ids.Encoder(f.read())
    assert encoder.chunks
    for group in (texts, texts[::-1], [None, "", " "], []):
        ids, counts = encoder.encode([x if x is None else x.encode() for x in group])
        cuts = np.cumsum(counts) - counts
        got = [ids[a : a + n].tolist() for a, n in zip(cuts, counts)]
        assert got == whole([x or "" for x in group])


def test_known_words_are_not_encoded_again():
    letters = "abcdefghijklmnopqrstuvwxyzéñ"
    words = ["".join(letters[i // 28**k % 28] for k in range(4)) for i in range(300_000)]
    texts = [" ".join(words[i : i + 1000]) + "\n" for i in range(0, len(words), 1000)]
    with open(PATH, encoding="utf-8") as f:
        encoder = token_ids.Encoder(f.read())
    first = encoder.encode([x.encode() for x in texts])
    new, encode = [], encoder.words.encode_batch_fast

    class Counting:
        def encode_batch_fast(self, lines, **options):
            new.extend(lines)
            return encode(lines, **options)

    encoder.words = Counting()
    again = encoder.encode([x.encode() for x in texts])
    assert not new and (first[0] == again[0]).all() and (first[1] == again[1]).all()
    cuts = np.cumsum(first[1])
    assert [first[0][b - n : b].tolist() for b, n in zip(cuts[:20], first[1])] == whole(texts[:20])


def test_words_are_forgotten_and_encoded_again(monkeypatch):
    monkeypatch.setattr(token_ids, "REMEMBERED", 50)
    rng = random.Random(5)
    with open(PATH, encoding="utf-8") as f:
        encoder = token_ids.Encoder(f.read())
    for n in (5, 20, 20, 60, 200, 3, 20):
        texts = [" ".join(rng.choice("abcdé") * rng.randrange(1, 9) + rng.choice("xyzñ") for _ in range(n)), hostile(rng)]
        ids, counts = encoder.encode([x.encode() for x in texts])
        assert [ids[: counts[0]].tolist(), ids[counts[0] :].tolist()] == whole(texts)
        assert len(encoder.known) <= 50 and len(encoder.stop) == len(encoder.known) + 1 and encoder.stop[-1] == len(encoder.ids)


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        spec = f.read()
    encoder = token_ids.Encoder(spec)
    assert not encoder.chunks
    ids, counts = encoder.encode([b"two  words", None])
    assert encoder.full.decode(ids.tolist()) == "two  words" and counts.tolist() == [len(ids), 0]


def brute_lengths(counts, limit):
    """Least total of code lengths up to a limit, by package-merge on explicit sets."""
    leaves = sorted((c, (i,)) for i, c in enumerate(counts) if c)
    row = []
    for _ in range(limit):
        pairs = [(row[k][0] + row[k + 1][0], row[k][1] + row[k + 1][1]) for k in range(0, len(row) - 1, 2)]
        row = list(heapq.merge(leaves, sorted(pairs, key=lambda x: x[0]), key=lambda x: x[0]))
    out = [0] * len(counts)
    for _, members in row[: 2 * len(leaves) - 2]:
        for i in members:
            out[i] += 1
    return out


@pytest.mark.parametrize("seed", range(8))
def test_code_lengths_are_optimal(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(2, 60))
    counts = (1.9 ** rng.integers(0, 40, n)).astype(np.int64) * (rng.random(n) < 0.8)
    counts[:2] += 1
    got = huffman.code_lengths(counts).astype(int)
    used = counts > 0
    assert (got[used] > 0).all() and not got[~used].any() and got.max() <= 12
    assert sum(2.0 ** -got[used]) <= 1
    assert (got * counts).sum() == (np.array(brute_lengths(counts.tolist(), 12)) * counts).sum()


def test_pack_and_decode():
    rng = np.random.default_rng(3)
    counts = np.array([0, 1, 255, 256, 257, 5000, 0, 3, 70_000])
    ids = (rng.zipf(1.2, int(counts.sum())) % 40_000).astype(np.uint16)
    lengths = huffman.code_lengths(np.bincount(ids))
    codes, order = huffman.canonical(lengths)
    text = [format(codes[i], f"0{lengths[i]}b") for i in order]
    assert text == sorted(text) and all(not b.startswith(a) for a, b in zip(text, text[1:]))
    data, sizes, lane_bits = huffman.pack(ids, counts, codes, lengths)
    at, k, marks = 0, 0, []
    for n, size in zip(huffman.lane_counts(counts), sizes):
        marks += (8 * at + np.cumsum(lane_bits[k : k + n].astype(int)) - lane_bits[k : k + n]).tolist()
        at, k = at + size, k + n
    table, bits = huffman.decoding_table(lengths)
    assert (huffman.decode_lanes(data, np.array(marks), huffman.lane_lengths(counts), table, bits) == ids).all()
    first = "".join(format(codes[i], f"0{lengths[i]}b") for i in ids[:1])
    assert format(data[0], "08b").startswith(first[:8])


def test_one_and_no_ids():
    assert huffman.code_lengths(np.array([0, 0, 7])).tolist() == [0, 0, 1]
    assert huffman.code_lengths(np.zeros(0, np.int64)).tolist() == []


def expected(rows):
    """(id, text) rows in order of id, nulls first, to (id, start, n, ids)."""
    out, start = [], 0
    for i, ids in rows:
        out.append((i, start, len(ids), np.array(ids, "<u4").tobytes()))
        start += len(ids)
    return out


def test_files_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 600)
    rng = random.Random(4)
    texts = [hostile(rng) * rng.choice([1, 1, 1, 40]) for _ in range(300)] + [None, ""]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    files = token_files.TokenFiles(spark, str(tmp_path / "files"))
    made = token_ids.tokenised(clashing(docs(spark, texts, ids)).repartition(5), PATH)
    files.write(made, F.col("carry.doc_id"))
    want = expected(sorted((i, [*x, 1]) for i, x in zip(ids, whole([t or "" for t in texts]))))
    got = sorted(tuple(r) for r in files.read().collect())
    assert [(a, b, c, bytes(d)) for a, b, c, d in got] == want
    assert sorted(tuple(r) for r in files.documents().collect()) == [w[:3] for w in want]
    assert files._table("blocks").count() > 10
    stream = b"".join(w[3] for w in want)
    for first, count in [(0, 5), (100, 1), (300, 2000), (len(stream) // 4 - 3, 50), (0, 10**9), (10**9, 5)]:
        pieces = sorted((r.first, bytes(r.ids)) for r in files.window(first, count).collect())
        assert b"".join(p for _, p in pieces) == stream[4 * first : 4 * (first + count)]


def test_ranges_are_found_without_python(spark, tmp_path, monkeypatch):
    plans, blocks = [], token_files._blocks

    def seen(spread, *more):
        plans.append(spread._jdf.queryExecution().executedPlan().toString())
        return blocks(spread, *more)

    monkeypatch.setattr(token_files, "_blocks", seen)
    token_files.TokenFiles(spark, str(tmp_path / "seen")).write(token_ids.tokenised(docs(spark, ["a b", "c"], [1, 0]), PATH), F.col("carry.doc_id"))
    assert len(plans) == 1 and "rangepartitioning" in plans[0] and "MapInArrow" not in plans[0]


def test_odd_rows(spark, tmp_path):
    rows = odd(spark)
    files = token_files.TokenFiles(spark, str(tmp_path / "odd"))
    files.write(token_ids.tokenised(rows, PATH), F.col("carry.doc_id"))
    got = files.read().collect()
    texts = {i: (t or "") for i, t in enumerate(ODD_TEXTS)} | {None: ""}
    assert len(got) == rows.count()
    for r in got:
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == [*whole([texts[r.id]])[0], 1]
    order = sorted(got, key=lambda r: r.start)
    assert [r.id for r in order] == [None, *sorted([*range(len(ODD_TEXTS)), 7])]
    assert [r.start for r in order] == np.cumsum([0, *(r.n_tokens for r in order)])[:-1].tolist()
    empty = token_files.TokenFiles(spark, str(tmp_path / "empty"))
    empty.write(token_ids.tokenised(rows.limit(0), PATH), F.col("carry.doc_id"))
    assert empty.read().count() == 0 and empty.documents().count() == 0 and empty.window(0, 9).count() == 0


def test_null_ids_and_four_byte_ids(spark, tmp_path):
    rows = [(3, np.array([70_000, 5, 70_000], "<u4").tobytes(), 3), (1, None, 2), (2, b"", 0), (2, b"\x01\0\0\0", None)]
    table = spark.createDataFrame([(a, b if b is None else bytearray(b), c) for a, b, c in rows], "k int, ids binary, n_tokens long")
    files = token_files.TokenFiles(spark, str(tmp_path / "wide"))
    files.write(table, "k")
    got = sorted((r.id, r.start, np.frombuffer(bytes(r.ids), "<u4").tolist()) for r in files.read().collect())
    assert got == [(1, 0, []), (2, 0, []), (2, 0, []), (3, 0, [70_000, 5, 70_000])]


def test_query_equals_library(spark):
    from tests.conftest import SF_SMALL

    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(os.path.join(SF_SMALL, "documents.parquet")).collect())
    want = [(i, a, n, zlib.crc32(b)) for i, a, n, b in expected([(i, [*x, 1]) for (i, _), x in zip(rows, whole([t or "" for _, t in rows]))])]
    assert sorted(tuple(r) for r in queries.QUERIES["op11_token_files"](spark, SF_SMALL).collect()) == want
