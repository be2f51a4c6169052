import hashlib
import random
import struct

import public_tokenizers
import pytest
import tiktoken

from embedflow.llm import bpe
from tests.llm.helpers import ODD_TEXTS, clashing, docs, odd

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return bpe.read_ranks(PATH)


@pytest.fixture(scope="module")
def vocab(ranks):
    return bpe.Vocabulary(ranks, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(vocab, text):
    split = bpe.Splitter(vocab.pattern)
    return [i for part in split(text) for p in part for i in vocab.merge(p.encode())]


def test_perfect_hash_is_minimal_and_exact(ranks, vocab):
    assert len(vocab.hash.keys) == len(ranks) and None not in vocab.hash.keys
    assert all(vocab.hash.get(k) == i for k, i in ranks.items())
    assert all(vocab.hash.get(k + b"\x00\x01\x02") is None for k in list(ranks)[:2000])
    assert bpe.PerfectHash({}).get(b"x") is None


def test_like_the_library_on_random_texts(vocab, library):
    rnd = random.Random(1)
    for alphabet in ("abcde éß\n\t 12!?.'stre", "ab1 ²½ \u0085\x1cɐ'll", "中文\U0001f600 aé 　٣"):
        for _ in range(800):
            s = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
            assert ids_of(vocab, s) == library.encode_ordinary(s)


def test_like_the_library_on_every_kind_of_character(vocab, library):
    rnd = random.Random(2)
    points = [c for a, b in bpe.NEW_LETTERS for c in (a, b)] + [rnd.randrange(0x110000) for _ in range(20_000)]
    for c in (c for c in points if not 0xD800 <= c < 0xE000):
        s = f"a{chr(c)}a 1{chr(c)}1  {chr(c)}! {chr(c)}x"
        assert ids_of(vocab, s) == library.encode_ordinary(s), hex(c)


def test_long_pre_token_and_piecewise_split(vocab, library, monkeypatch):
    long = "ab" * 3000 + "xyz" * 500
    assert ids_of(vocab, long) == library.encode_ordinary(long)
    monkeypatch.setattr(bpe, "LONG", 10)
    monkeypatch.setattr(bpe, "CHUNK", 3)
    s = "The words of  a text,\n\n split piecemeal 123 !!"
    assert ids_of(vocab, s) == library.encode_ordinary(s)


def test_encode_and_decode_tables(spark, library):
    vocab = bpe.shared_vocabulary(spark, PATH, public_tokenizers.PATTERN)
    df = clashing(odd(spark)).drop("ids", "n_tokens", "bytes")
    encoded = bpe.encode(df, vocab)
    rows = encoded.collect()
    assert len(rows) == df.count()
    for r in rows:
        if r.doc_id is not None and r.doc_id < len(ODD_TEXTS):
            want = library.encode_ordinary(ODD_TEXTS[r.doc_id] or "")
            packed = struct.pack(f"<{len(want)}I", *want)
            assert bytes(r.ids) == packed and r.n_tokens == len(want) and r.ids_sha256 == hashlib.sha256(packed).hexdigest()
    for r in bpe.decode(encoded, vocab).collect():
        if r.doc_id is not None and r.doc_id < len(ODD_TEXTS):
            assert bytes(r.bytes) == (ODD_TEXTS[r.doc_id] or "").encode()
    assert bpe.decode(bpe.encode(docs(spark, []), vocab), vocab).count() == 0


def test_clashing_output_names_win(spark):
    vocab = bpe.shared_vocabulary(spark, PATH, public_tokenizers.PATTERN)
    row = bpe.encode(clashing(docs(spark, ["a b"])), vocab).first()
    assert row.n_tokens == 2


def test_memo_limit_keeps_results(vocab, library, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 2)
    own = bpe.Vocabulary(vocab.ranks, vocab.pattern)
    for word in ["zzqx", "qqzzy", "xxzzw", "zzqx"]:
        assert list(struct.unpack(f"<{len(own.packed(word)) // 4}I", own.packed(word))) == library.encode_ordinary(word)
    assert len(own.memo) <= 2


def test_memo_keeps_what_comes_again(vocab, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO", 3)
    own = bpe.Vocabulary(vocab.ranks, vocab.pattern)
    merged = []
    monkeypatch.setattr(own, "merge", lambda piece: merged.append(piece) or vocab.merge(piece))
    for i in range(60):
        for piece in ("often", f"once{i}"):
            own.memo.get(piece) or own.packed(piece)
        assert len(own.memo) <= 3 and len(own.older) <= 3
    assert merged.count(b"often") == 1 and len(merged) == 61


def test_memo_is_bounded():
    assert 2 * bpe.MEMO <= 300_000
