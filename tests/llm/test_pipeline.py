import public_tokenizers
import tiktoken

import corpus_pipeline as p
from embedflow.llm import bpe, quality, secret_scan
from tests.conftest import SF_SMALL
from tests.llm.helpers import clashing, docs, odd
from tests.llm.test_decontam import brute as contaminated
from tests.llm.test_simhash import components, slow_fingerprint


def test_stages_against_brute_force(spark):
    table = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in table.collect()}
    kept = {r.carry.doc_id for r in quality.judged(table, carry=["doc_id"]).where("kept").collect()}
    first = p.quality_rules(spark, table, SF_SMALL)
    assert first.columns == table.columns and {r.doc_id for r in first.collect()} == kept
    fps = {i: slow_fingerprint(rows[i].text) for i in kept}
    ids = sorted(kept)
    pairs = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1 :] if (fps[a] ^ fps[b]).bit_count() <= 3]
    want = set(components(ids, pairs).values())
    second = p.near_duplicates(spark, first, SF_SMALL)
    assert second.columns == table.columns and sorted(r.doc_id for r in second.collect()) == sorted(want)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    want = {i for i in want if not contaminated(rows[i].text, items)[4]}
    third = p.decontamination(spark, second, SF_SMALL)
    assert third.columns == table.columns and {r.doc_id for r in third.collect()} == want
    fourth = p.secrets(spark, third, SF_SMALL)
    texts = {r.doc_id: r.text for r in fourth.collect()}
    assert fourth.columns == table.columns and set(texts) == want
    assert not any(secret_scan.find_spans(t) for t in texts.values())
    assert all(texts[i] == rows[i].text for i in want if not secret_scan.find_spans(rows[i].text))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken")), special_tokens={})
    for r in p.run(spark, SF_SMALL).collect():
        assert r.round_trip and r.n_tokens == len(library.encode_ordinary(texts.pop(r.doc_id)))
    assert not texts


def test_odd_rows_and_extra_columns(spark):
    text = " ".join(f"word{i} of text{i * 7}" for i in range(60))
    other = " ".join(f"quite{i} another thing{i * 3}" for i in range(60))
    df = clashing(odd(spark).unionByName(docs(spark, [text, text, other, text], [100, 101, 102, 100])))
    for name, stage in p.STAGES:
        df = stage(spark, df, SF_SMALL)
        if name != "tokens":
            assert "extra fp" in [r[c] for r in df.limit(1).collect() for c in df.columns] or df.isEmpty()
    assert sorted(r.doc_id for r in df.collect()) == [100, 102]


def test_empty_table(spark):
    df = docs(spark, [])
    for _, stage in p.STAGES:
        df = stage(spark, df, SF_SMALL)
    assert df.count() == 0
