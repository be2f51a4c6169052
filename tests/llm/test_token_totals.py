from embedflow.llm import token_totals as t
from tests.llm.helpers import clashing, docs, odd

PATTERNS = {"words": t.WORDS, "long_words": t.LONG_WORDS}


def totals(store):
    return {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in store.totals().collect()}


def test_batches_add_up_and_replays_count_once(spark, tmp_path):
    store = t.TokenTotals(spark, str(tmp_path / "totals"))
    assert totals(store) == {} and store.commits().count() == 0
    counts = t.counted(docs(spark, ["a b cc", "dd ee", "dd ee"]), PATTERNS)
    assert store.commit("one", t.signed(counts, "v1", "words", 1))
    assert totals(store) == {("src0", "en", "v1"): (3, 7)}
    assert not store.commit("one", t.signed(counts, "v1", "words", 1))
    assert totals(store) == {("src0", "en", "v1"): (3, 7)}
    gone = t.copies(counts)
    assert [r.doc_id for r in gone.collect()] == [2]
    assert store.commit("two", t.signed(gone, "v1", "words", -1))
    assert store.commit("three", t.revised(counts.where("doc_id < 2"), "v1", "words", "long_words"))
    assert not store.commit("three", t.revised(counts.where("doc_id < 2"), "v1", "words", "long_words"))
    assert totals(store) == {("src0", "en", "v1"): (2, 3)}
    assert store.commit("four", t.signed(counts.where("doc_id < 2"), "v1", "long_words", -1))
    assert totals(store) == {}


def test_an_attempt_that_did_not_commit_has_no_effect(spark, tmp_path):
    store = t.TokenTotals(spark, str(tmp_path / "totals"))
    counts = t.counted(docs(spark, ["a b"]), PATTERNS)
    t.signed(counts, "v1", "words", 1).groupBy(*t.KEYS).sum().limit(0).count()
    lost = t.signed(counts, "v1", "words", 100).select(*t.KEYS, "n_docs", "n_tokens")
    lost.write.parquet(f"{store.path}/deltas/batch_id=one")
    assert totals(store) == {}
    assert store.commit("one", t.signed(counts, "v1", "words", 1))
    assert totals(store) == {("src0", "en", "v1"): (1, 2)}
    assert store.commit("nothing", t.signed(counts.limit(0), "v1", "words", 1))
    assert not store.commit("nothing", t.signed(counts, "v1", "words", 1))


def test_odd_rows(spark, tmp_path):
    store = t.TokenTotals(spark, str(tmp_path / "totals"))
    df = clashing(odd(spark)).withColumns({"source": t.F.lit(None).cast("string")})
    counts = t.counted(df, PATTERNS)
    store.commit("b", t.signed(counts, "v", "words", 1))
    assert totals(store) == {(None, "en", "v"): (12, 0 + 1 + 2 + 1 + 4 * 3 + 3 + 20_000)}
    assert t.copies(t.counted(docs(spark, []), PATTERNS)).count() == 0


def test_repeated_rows_and_ids(spark):
    """Rows that repeat an id, with its text or with another, are told apart by their texts alone."""
    rows = docs(spark, ["x", "x", "x", "y z", "x", "y z"], [1, 1, 2, 2, None, 1])
    counts = t.counted(rows, PATTERNS)
    assert sorted((r.doc_id, r.words) for r in t.firsts(counts).collect()) == [(1, 1), (1, 2)]
    assert sorted((str(r.doc_id), r.words) for r in t.copies(counts).collect()) == [("1", 1), ("2", 1), ("2", 2), ("None", 1)]
    removed = t.copies_removed(counts, "v", "words").groupBy().sum("n_docs", "n_tokens").first()
    assert tuple(removed) == (-4, -5)


def test_query_with_repeated_rows_equals_its_sql(spark, tmp_path):
    import duckdb

    from embedflow.llm import queries, sql

    texts = ["a bb", "a bb", "a bb", "ccc", "", None, "ccc", "dd ee"]
    docs(spark, texts, [1, 1, 2, 2, 5, 6, 7, 8]).coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in queries.QUERIES["op4_token_counts"](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert got == set(con.sql(sql.OP4).fetchall())


def test_any_batch_id(spark, tmp_path):
    store = t.TokenTotals(spark, str(tmp_path / "totals"))
    counts = t.counted(docs(spark, ["a b"]), PATTERNS)
    ids = ["2024/01", "2024", "a=b", "100%", "%2F", " ", "..", "é", "__HIVE_DEFAULT_PARTITION__x"]
    for i in ids:
        assert store.commit(i, t.signed(counts, "v1", "words", 1))
        assert not store.commit(i, t.signed(counts, "v1", "words", 1))
    assert totals(store) == {("src0", "en", "v1"): (len(ids), 2 * len(ids))}
    assert {r.batch_id for r in store.commits().collect()} == set(ids)
