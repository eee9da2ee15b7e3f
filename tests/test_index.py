"""Index blocks, exact gaps across blocks, decode(encode) = identity, Boolean retrieval."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import index as I
from tessera.operators import words as W
from tessera.sources.sinks import write_index, write_term_sorted
from tessera.sources.tables import read_table

from table_paths import SF001


def _tf(spark, rows):
    return spark.createDataFrame(rows, "term string, doc_id long, tf long")


ROWS = [("a", d, 1 + d % 3) for d in (0, 3, 4, 9, 17, 18, 40, 41, 100)] + \
       [("b", d, 2) for d in (5, 6, 70)] + [("c", 64, 1)]


def _coded(tf, block_docs, super_blocks=I.SUPER_BLOCKS):
    return I.encode_postings(I.posting_blocks(tf, block_docs), super_blocks)


def test_gaps_exact_across_blocks(spark):
    tf = _tf(spark, ROWS)
    got = {(r.term, r.doc_id): r.gap for r in I.gap_rows(_coded(tf, 8)).collect()}
    want = {}
    for term in "abc":
        prev = 0
        for d in sorted(d for t, d, _ in ROWS if t == term):
            want[(term, d)] = d - prev
            prev = d
    assert got == want


def test_decode_of_encode_is_identity(spark):
    tf = _tf(spark, ROWS)
    for block, upper in ((4, 2), (8, 1), (8, 1024), (1024, 1024)):
        assert sorted(tuple(r) for r in I.decode_postings(_coded(tf, block, upper)).collect()) == sorted(ROWS)


def test_sparse_ids_and_full_blocks(spark):
    rows = [("far", d, 1) for d in (0, 7, 5_000_000_123, 5_000_000_124, 2**60)] + [("dense", d, 1 + d % 2) for d in range(100, 2300)]
    coded = _coded(_tf(spark, rows), 1024, 4)
    assert sorted(tuple(r) for r in I.decode_postings(coded).collect()) == sorted(rows)
    got = {}
    for r in I.gap_rows(coded).collect():
        got.setdefault(r.term, []).append((r.doc_id, r.gap, r.seq))
    far = sorted(got["far"])
    assert [g for _, g, _ in far] == [0, 7, 5_000_000_116, 1, 2**60 - 5_000_000_124]
    assert [q for _, _, q in far] == [1, 2, 1, 2, 1]
    assert all(g == (100 if d == 100 else 1) for d, g, _ in got["dense"])
    assert {(r.term, r.df) for r in coded.collect()} == {("far", 5), ("dense", 2200)}
    skips = {r.block: r.skips for r in coded.where("term = 'dense'").collect()}
    assert skips[1][:2] == [1024 + 31, 1024 + 63] and len(skips[1]) == 32


def test_coding_has_no_window(spark):
    coded = _coded(_tf(spark, ROWS), 8)
    for df in (coded, I.gap_rows(coded), I.decode_postings(coded)):
        assert "Window" not in df._jdf.queryExecution().toString()


def test_stored_index_opens_only_the_files_of_its_terms(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"w{chr(97 + i % 26)} common z{chr(97 + i % 5)}") for i in range(200)], "doc_id long, text string")
    tf = I.term_frequency(W.doc_tokens(docs))
    write_index(_coded(tf, 16), tmp_dir + "/ix", 8)
    every = spark.read.parquet(tmp_dir + "/ix/data").inputFiles()
    assert len(every) == 8
    for terms in (["wa"], ["Common"], ["wa", "zb"], ["nosuchterm"], []):
        got = I.open_terms(spark, tmp_dir + "/ix", terms)
        want = sorted(tuple(r) for r in tf.where(F.col("term").isin([t.lower() for t in terms])).collect())
        assert sorted(tuple(r) for r in I.decode_postings(got).collect()) == want
        if want and terms != ["Common"]:
            assert 0 < len(got.inputFiles()) <= 2 * len(terms) < len(every)
    queries = ["wa common AND", "wb nosuchterm OR"]
    stored = I.decode_postings(I.open_terms(spark, tmp_dir + "/ix", I.query_terms(queries)))
    assert sorted(map(tuple, I.boolean_queries(stored, queries).collect())) == sorted(map(tuple, I.boolean_queries(tf, queries).collect()))


def test_term_sets_read_the_corpus_once(spark):
    docs = read_table(spark, SF001, "documents")
    tf = I.term_frequency(W.doc_tokens(docs))
    both, any_ = I.docs_with_all(tf, ["the", "of"]), I.docs_with_any(tf, ["de", "the"])
    for df in (both, any_):
        assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    sets = {t: {r.doc_id for r in I.doc_set(tf, t).collect()} for t in ("the", "of", "de")}
    assert {r.doc_id for r in both.collect()} == sets["the"] & sets["of"]
    assert sorted(r.doc_id for r in any_.collect()) == sorted(sets["de"] | sets["the"])


def test_hits_become_a_bloom_filter_on_the_document_scan(spark):
    docs = read_table(spark, SF001, "documents")
    hits = spark.createDataFrame([(0, 3), (1, 3), (0, 150), (2, 9999)], "query_id int, doc_id long")
    want = sorted((r.query_id, r.doc_id, r.snippet) for r in I.retrieve_snippets(hits, docs).collect())
    assert [w[:2] for w in want] == [(0, 3), (0, 150), (1, 3)]
    old = {}
    for k, v in {"spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}.items():
        old[k] = spark.conf.get(k)
        spark.conf.set(k, v)
    try:
        got = I.retrieve_snippets(hits, docs)
        assert "might_contain" in got._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r.query_id, r.doc_id, r.snippet) for r in got.collect()) == want
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_blocks_are_bounded_and_df_is_whole(spark):
    tf = _tf(spark, ROWS)
    ix = I.index_blocks(tf, block_docs=8).collect()
    for r in ix:
        assert all(p.doc_id // 8 == r.block for p in r.postings)
        assert [p.doc_id for p in r.postings] == sorted(p.doc_id for p in r.postings)
    assert {r.term: r.df for r in ix} == {"a": 9, "b": 3, "c": 1}


def test_boolean_ops_against_python_sets(spark):
    tf = _tf(spark, ROWS)
    sets = {t: {d for tt, d, _ in ROWS if tt == t} for t in "abc"}
    assert {r.doc_id for r in I.docs_and(I.doc_set(tf, "a"), I.doc_set(tf, "b")).collect()} == sets["a"] & sets["b"]
    assert {r.doc_id for r in I.docs_or(I.doc_set(tf, "A"), I.doc_set(tf, "c")).collect()} == sets["a"] | sets["c"]
    got = I.boolean_queries(tf, ["a b OR c AND", "a b AND", "zzz", "b c OR a AND"]).collect()
    by_q = {}
    for r in got:
        by_q.setdefault(r.query_id, set()).add(r.doc_id)
    assert by_q.get(0, set()) == (sets["a"] | sets["b"]) & sets["c"]
    assert by_q.get(1, set()) == sets["a"] & sets["b"]
    assert 2 not in by_q
    assert by_q.get(3, set()) == (sets["b"] | sets["c"]) & sets["a"]


@pytest.mark.parametrize("q", ["a AND", "a b", "AND", ""])
def test_malformed_postfix_raises(q):
    with pytest.raises(ValueError):
        I.parse_postfix(q)


def test_snippet_first_line_80_chars(spark):
    long = "x" * 85
    docs = spark.createDataFrame([(1, long + "\nsecond"), (2, "short\nmore")], "doc_id long, text string")
    hits = spark.createDataFrame([(0, 1), (0, 2)], "query_id int, doc_id long")
    got = {r.doc_id: r.snippet for r in I.retrieve_snippets(hits, docs).collect()}
    assert got == {1: "x" * 80 + "...", 2: "short"}


def test_term_sorted_index_lookup_prunes(spark, tmp_dir):
    docs = spark.createDataFrame([(i, f"w{i % 7} common w{i % 3}") for i in range(50)], "doc_id long, text string")
    ix = I.index_blocks(I.term_frequency(W.doc_tokens(docs)), 16)
    write_term_sorted(ix, tmp_dir, 4)
    stored = spark.read.parquet(tmp_dir)
    look = stored.where(F.col("term").isin(["common"]))
    plan = look._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(term), In(term" in plan or "EqualTo(term" in plan
    assert look.agg(F.max("df")).first()[0] == 50


@pytest.mark.parametrize("n", [3, 1500])
def test_fetch_rows_takes_any_number_of_keys(spark, n):
    table = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), F.col("id").cast("string")).alias("text"))
    keys = spark.range(n).select((F.col("id") % 1200 * 3).alias("doc_id"))
    got = sorted(tuple(r) for r in I.fetch_rows(table, keys, "doc_id").collect())
    assert got == sorted({(i % 1200 * 3, f"t{i % 1200 * 3}") for i in range(n)})
