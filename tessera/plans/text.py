from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import tokenize
from tessera.operators import words as W
from tessera.plans.registry import register
from tessera.plans.sqlparts import DOC_TOKENS_CTE, LINE_TOKENS_CTE
from tessera.session import scratch_path
from tessera.sources.sinks import write_tsv
from tessera.sources.tables import corpus_lines, read_table, read_text_corpus, read_tsv

ANCHOR = "the"  # stand-in anchor word

BIGRAMS_CTE = LINE_TOKENS_CTE + """,
bg AS (SELECT b.x AS x, b.y AS y FROM (SELECT unnest(list_transform(range(1, len(t)),
        lambda i: {'x': t[i], 'y': t[i + 1]})) AS b FROM line_toks)),
bc AS (SELECT x, y, count(*) AS n FROM bg GROUP BY x, y)"""


def _docs(spark, sf):
    return read_table(spark, sf, "documents")


@register("tokens", f"""
WITH {DOC_TOKENS_CTE}
SELECT doc_id, CAST(pos AS INTEGER) AS pos, token FROM occ
""")
def tokens(spark, sf):
    return W.token_rows(W.doc_tokens(_docs(spark, sf)))


@register("word_count", f"""
WITH {DOC_TOKENS_CTE}
SELECT token AS word, count(*) AS n FROM occ GROUP BY token
""")
def word_count(spark, sf):
    return W.word_count(W.doc_tokens(_docs(spark, sf)))


@register("after_anchor_count", f"""
WITH {BIGRAMS_CTE}
SELECT y AS word, count(*) AS n FROM bg WHERE x = '{ANCHOR}' GROUP BY y HAVING count(*) > 1
""")
def after_anchor_count(spark, sf):
    return W.follower_count(W.line_tokens(_docs(spark, sf)), ANCHOR, 2)


@register("bigram_freq", f"""
WITH {BIGRAMS_CTE}
SELECT x, y, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY x), 6) AS freq FROM bc
""")
def bigram_freq(spark, sf):
    return W.bigram_freq(W.line_tokens(_docs(spark, sf))).withColumn("freq", F.round("freq", 6))


@register("bigram_marginals", f"""
WITH {BIGRAMS_CTE}
SELECT x, CASE WHEN grouping(y) = 1 THEN '*' ELSE y END AS y, count(*) AS n
FROM bg GROUP BY GROUPING SETS ((x, y), (x))
""")
def bigram_marginals(spark, sf):
    return W.bigram_marginals(W.line_tokens(_docs(spark, sf)))


@register("bigram_stripes", f"""
WITH {BIGRAMS_CTE}
SELECT x, y, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY x), 6) AS freq FROM bc
""")
def bigram_stripes(spark, sf):
    s = W.bigram_stripes(W.line_tokens(_docs(spark, sf)))
    return (W.from_stripes(s, "x", "y", ["n", "freq"])
            .withColumn("freq", F.round("freq", 6)))


@register("stripes_text", f"""
WITH {BIGRAMS_CTE}
SELECT x, y, n, round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY x), 6) AS freq FROM bc
""")
def stripes_text(spark, sf):
    # Stripes as text of tuples, the map as JSON, then read back.
    stripes, path = W.bigram_stripes(W.line_tokens(_docs(spark, sf))), scratch_path(spark, "stripes-text")
    write_tsv(stripes, path)
    return (W.from_stripes(read_tsv(spark, path, stripes.schema), "x", "y", ["n", "freq"])
            .withColumn("freq", F.round("freq", 6)))


@register("stripe_merge", f"""
WITH {BIGRAMS_CTE}
SELECT x, y, n FROM bc
""")
def stripe_merge(spark, sf):
    toks = W.line_tokens(_docs(spark, sf))
    even, odd = (W.bigram_counts(toks.where(F.col("doc_id") % 2 == r)).checkpoint() for r in (0, 1))
    return W.from_stripes(W.merge_counts(even, odd), "x", "y", ["n"])


@register("partition_sorted", f"""
WITH {BIGRAMS_CTE}
SELECT CAST(CAST(('0x' || substr(md5(x), 1, 8)) AS BIGINT) % 8 AS INTEGER) AS part, x, y, n FROM bc
""")
def partition_sorted(spark, sf):
    c = W.bigram_counts(W.line_tokens(_docs(spark, sf)))
    return W.partition_sorted(c, "x", ["y"], 8)


@register("text_corpus_count", f"""
WITH {LINE_TOKENS_CTE},
occ AS (SELECT doc_id, line_no, unnest(t) AS token FROM line_toks)
SELECT token AS word, count(*) AS n, count(DISTINCT (doc_id, line_no)) AS n_lines FROM occ GROUP BY token
""")
def text_corpus_count(spark, sf):
    # The test tables have no text files: the lines of documents are written as a folder of them, then read back.
    path = scratch_path(spark, "corpus-text")
    corpus_lines(_docs(spark, sf)).select("line").write.option("lineSep", "\n").text(path)
    lines = read_text_corpus(spark, path)
    return W.line_word_count(lines.select("doc_id", "line_no", tokenize(F.col("line")).alias("tokens")))
