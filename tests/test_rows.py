"""What counts, stripes and postings cost by plan: exchanges, and expensive columns evaluated once."""

from pyspark.sql import functions as F

from tessera.functions.text import bigram_structs
from tessera.operators import index as I
from tessera.operators import words as W


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_are_counted_with_one_exchange(spark):
    rows = [(1, 0, ["b", "a", "b", "b"]), (1, 1, []), (1, 2, None), (2, 0, ["a"]), (2, 1, ["c", "a", "c", None, None])]
    lines = spark.createDataFrame(rows, "doc_id long, line_no long, tokens array<string>")
    got = W.line_word_count(lines)
    assert sorted(map(tuple, got.collect())) == [("a", 3, 3), ("b", 3, 1), ("c", 2, 1)]
    assert exchanges(W.line_word_count(lines)) == 1


def test_stripes_are_evaluated_once(spark):
    """No filter on a stripe's size, which would build (or parse) the map a second time."""
    toks = spark.createDataFrame([(1, ["a", "b", "a", "b", "c"]), (2, ["a", "c"]), (3, ["z"]), (4, None)], "doc_id long, tokens array<string>")
    long = W.from_stripes(W.bigram_stripes(toks), "x", "y", ["n", "freq"])
    assert sorted(map(tuple, long.collect())) == [("a", "b", 2, 2 / 3), ("a", "c", 1, 1 / 3), ("b", "a", 1, 0.5), ("b", "c", 1, 0.5)]
    stored = spark.createDataFrame([("a", '{"b":1}'), ("c", "{}"), ("d", None)], "x string, j string")
    parsed = W.from_stripes(stored.select("x", F.from_json("j", "map<string,bigint>").alias("stripe")), "x", "y", ["n"])
    assert plan(parsed).count("from_json") == 1
    assert [tuple(r) for r in parsed.collect()] == [("a", "b", 1)]


def test_bigrams_have_no_lambda(spark):
    toks = spark.createDataFrame([(["a", "b", "c"],), (["a"],), ([],), (None,)], "tokens array<string>")
    pairs = toks.select(bigram_structs(F.col("tokens")).alias("p"))
    assert [r.p and [tuple(q) for q in r.p] for r in pairs.collect()] == [[("a", "b"), ("b", "c")], [], [], None]
    assert "lambda" not in plan(pairs)


def test_postings_move_texts_only(spark):
    """Documents are dealt by block once; counts and postings follow without an exchange, also for repeated, null and negative ids."""
    rows = [(i, f"the w{i % 7} w{i % 5} the") for i in range(-20, 60)] + [(7, "the the x"), (7, "x"), (None, "the"), (None, "y"), (61, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    dealt = I.posting_blocks(I.blocked_frequency(docs, 8))
    assert exchanges(dealt) == 1
    plain = I.posting_blocks(I.term_frequency(W.doc_tokens(docs)), 8)
    form = lambda df: sorted(((r.term, r.block, r.n, [tuple(p) for p in r.postings]) for r in df.collect()), key=str)
    assert form(dealt) == form(plain)
    df = {(r.term, r.df) for r in I.with_df(dealt).collect()}
    assert ("the", 81) in df and len(df) == len({t for t, _ in df})
