"""Tokeniser contract, counts, followers, bigrams, stripes and PMI on hand-made lines."""

import math
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.operators import cooc as C
from tessera.operators import words as W


def py_tokens(s):
    out = []
    for piece in re.split(r"[ \t\n\r\f]+", s.lower()):
        piece = re.sub(r"^[^a-z]+|[^a-z]+$", "", piece)
        if piece:
            out.append(piece)
    return out


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


ALPHABET = st.sampled_from(list("abcxyz  \t\n.,!-1é"))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=8))
def test_tokenizer_matches_contract(spark, texts):
    df = _docs(spark, texts)
    got = {r.doc_id: r.t for r in df.select("doc_id", tokenize(F.col("text")).alias("t")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == py_tokens(t)


def test_word_count_against_counter(spark):
    texts = ["The cat, the DOG.", "a a a\nthe", "", "  --  "]
    got = {r.word: r.n for r in W.word_count(W.doc_tokens(_docs(spark, texts))).collect()}
    want = Counter(w for t in texts for w in py_tokens(t))
    assert got == dict(want)


def test_followers_two_anchors_in_a_row(spark):
    # "the the x": the second "the" follows the first and starts anew.
    texts = ["the the x the the y", "the the", "x the"]
    got = {r.word: r.n for r in W.follower_count(W.line_tokens(_docs(spark, texts)), "the", 1).collect()}
    assert got == {"the": 3, "x": 1, "y": 1}
    got2 = {r.word: r.n for r in W.follower_count(W.line_tokens(_docs(spark, texts)), "the", 2).collect()}
    assert got2 == {"the": 3}


def test_bigrams_do_not_cross_lines_and_freq_sums_to_one(spark):
    texts = ["a b\nc d", "a b a c"]
    toks = W.line_tokens(_docs(spark, texts))
    counts = {(r.x, r.y): r.n for r in W.bigram_counts(toks).collect()}
    assert counts == {("a", "b"): 2, ("c", "d"): 1, ("b", "a"): 1, ("a", "c"): 1}
    freq = W.bigram_freq(toks).groupBy("x").agg(F.sum("freq").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-12 for r in freq)
    marg = {(r.x, r.y): r.n for r in W.bigram_marginals(toks).collect()}
    assert marg[("a", "*")] == 3 and marg[("c", "*")] == 1 and ("d", "*") not in marg


def test_pairs_equal_stripes(spark):
    texts = ["a b c a\nb c", "c d e", "a"]
    toks = W.line_tokens(_docs(spark, texts))
    pairs = sorted((r.x, r.y, r.n, round(r.freq, 12)) for r in W.bigram_freq(toks).collect())
    s = W.from_stripes(W.bigram_stripes(toks, pieces=3), "x", "y", ["n", "freq"])
    stripes = sorted((r.x, r.y, r.n, round(r.freq, 12)) for r in s.collect())
    assert pairs == stripes


def test_stripe_merge_equals_whole(spark):
    texts = ["a b a b", "b a c", "a b", "c c c"]
    toks = W.line_tokens(_docs(spark, texts))
    even = W.to_stripes(W.bigram_counts(toks.where("doc_id % 2 = 0")), "x", "y", ["n"], pieces=2)
    odd = W.to_stripes(W.bigram_counts(toks.where("doc_id % 2 = 1")), "x", "y", ["n"], pieces=2)
    merged = sorted(tuple(r) for r in W.from_stripes(W.merge_stripes(even, odd), "x", "y", ["n"]).collect())
    whole = sorted(tuple(r) for r in W.bigram_counts(toks).select("x", "y", "n").collect())
    assert merged == whole


def _py_pmi(lines, threshold):
    wsets = [list(dict.fromkeys(py_tokens(l)[:40])) for l in lines]
    n = len(lines)
    lf = Counter(w for ws in wsets for w in ws)
    pc = Counter((x, y) for ws in wsets for x in ws for y in ws if x != y)
    return {(x, y): (math.log10(c * n / (lf[x] * lf[y])), c) for (x, y), c in pc.items() if c >= threshold}


def test_pmi_against_python(spark):
    texts = ["a b c\na b\n\nb c d\na c", "a b d\nd d d a"]
    lines = [l for t in texts for l in t.split("\n")]
    words = C.line_words(W.line_tokens(_docs(spark, texts)))
    for threshold in (1, 2):
        got = {(r.x, r.y): (r.pmi, r.n) for r in C.pmi_pairs(words, threshold).collect()}
        want = _py_pmi(lines, threshold)
        assert set(got) == set(want)
        for k in want:
            assert abs(got[k][0] - want[k][0]) < 1e-9 and got[k][1] == want[k][1]


def test_pmi_first_40_tokens_with_duplicates(spark):
    # 45 tokens: "z" is the 41st distinct position and must not take part.
    line = " ".join(["a"] * 39 + ["b", "z", "z", "z", "z", "z"])
    words = C.line_words(W.line_tokens(_docs(spark, [line])))
    assert sorted(words.first().words) == ["a", "b"]


def test_pmi_stripes_min_partners(spark):
    texts = ["a b\na b\na c\nd e\nd e"]
    words = C.line_words(W.line_tokens(_docs(spark, texts)))
    got = C.stripes_long(C.pmi_stripes(words, 1, min_partners=2)).collect()
    assert {r.x for r in got} == {"a"}


def test_partition_sorted_is_sorted_in_each_partition(spark):
    texts = ["q w e r t y u i o p a s d f g h j k l"]
    c = W.bigram_counts(W.line_tokens(_docs(spark, texts)))
    out = W.partition_sorted(c, "x", ["y"], 4)
    rows = out.withColumn("pid", F.spark_partition_id()).collect()
    by_pid = {}
    for r in rows:
        by_pid.setdefault(r.pid, []).append(r)
    seen = {}
    for pid, rs in by_pid.items():
        keys = [(r.x, r.y) for r in rs]
        assert keys == sorted(keys)
        for r in rs:  # every key (and visible partition number) lives in one partition only
            assert seen.setdefault(r.part, pid) == pid


def test_adaptive_stripe_pieces_are_bounded(spark):
    long = spark.createDataFrame([("hot", f"p{i}", i) for i in range(50)] + [("cold", "p1", 1)],
                                 "x string, y string, n long")
    st = W.to_stripes(long, "x", "y", ["n"], max_entries=8).collect()
    hot = [r for r in st if r.x == "hot"]
    assert max(len(r.stripe) for r in st) <= 16  # hash pieces: about max_entries each
    assert sum(len(r.stripe) for r in hot) == 50 and len(hot) >= 5
    assert [len(r.stripe) for r in st if r.x == "cold"] == [1]


def test_whole_text_tokenizer_equals_per_piece_form(spark):
    from tessera.functions.text import tokenize_per_piece
    from tessera.sources.tables import read_table
    from table_paths import SF001
    docs = read_table(spark, SF001, "documents")
    assert docs.where(tokenize(F.col("text")) != tokenize_per_piece(F.col("text"))).count() == 0


def test_tokenizer_is_linear_in_a_long_run(spark):
    import time
    from pyspark.sql import functions as F
    from tessera.functions.text import tokenize
    df = spark.createDataFrame([("a" + "1" * 400_000 + "z " + "-" * 400_000 + "b",)], "t string")
    began = time.time()
    assert df.select(F.size(tokenize(F.col("t")))).first()[0] == 2
    assert time.time() - began < 20


def test_physical_partition_holds_its_part_only(spark):
    from tessera.operators import words as W
    rows = spark.range(5000).select(F.concat(F.lit("k"), (F.col("id") % 700).cast("string")).alias("x"), F.col("id").alias("n"))
    got = W.partition_sorted(rows, "x", ["n"], 13).withColumn("at", F.spark_partition_id())
    parts = got.select("part", "at").distinct().collect()
    assert all(r.part == r["at"] for r in parts) and len(parts) == 13
    for at in (0, 12):
        here = [(r.x, r.n) for r in got.where(F.col("at") == at).collect()]
        assert here == sorted(here) and here


def test_merge_of_unlike_stripes_agrees_on_pieces(spark):
    from tessera.operators import words as W
    hot = spark.range(1_000_000).select(F.lit("hot").alias("x"), F.concat(F.lit("p"), F.col("id").cast("string")).alias("y"), F.lit(1).cast("long").alias("n"))
    a = hot.unionByName(spark.createDataFrame([("cold", "u", 2), ("left", "v", 1)], "x string, y string, n long"))
    b = spark.createDataFrame([("hot", "p7", 5), ("hot", "new", 1), ("cold", "u", 3), ("right", "w", 4)], "x string, y string, n long")
    merged = W.merge_counts(a, b, max_entries=20_000)
    sizes = merged.select("x", "piece", F.size("stripe").alias("s")).collect()
    assert max(r.s for r in sizes) < 25_000  # about max_entries: pieces are cut by hash
    assert len([r for r in sizes if r.x == "hot"]) == 51 and {r.piece for r in sizes if r.x != "hot"} == {0}
    long = W.from_stripes(merged, "x", "y", ["n"])
    got = {r.x: (r.k, r.n) for r in long.groupBy("x").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).collect()}
    assert got == {"hot": (1_000_001, 1_000_006), "cold": (1, 5), "left": (1, 1), "right": (1, 4)}
    assert long.where("y = 'p7'").first().n == 6


def test_text_corpus_numbers_lines_of_split_files(spark, tmp_dir):
    import os
    from tessera.sources.tables import read_text_corpus
    os.makedirs(tmp_dir + "/c")
    files = {"a.txt": "".join(f"line {i}\n" for i in range(500)), "b.txt": "first\n\n  third\r\nlast without end",
             "c c.txt": "", "d.txt": "\n\n"}
    for name, text in files.items():
        with open(f"{tmp_dir}/c/{name}", "w", newline="") as fh:
            fh.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        corpus = read_text_corpus(spark, tmp_dir + "/c")
        rows = sorted((os.path.basename(r.doc_id), r.line_no, r.line) for r in corpus.collect())
        assert rows == sorted((os.path.basename(r.doc_id), r.line_no, r.line) for r in read_text_corpus(spark, tmp_dir + "/c").collect())
        assert spark.read.text(tmp_dir + "/c").rdd.getNumPartitions() > 5
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want = [(n, i, x) for n, t in files.items() for i, x in enumerate(t[:-1].split("\n") if t.endswith("\n") else t.split("\n")) if t]
    assert rows == sorted(want)
