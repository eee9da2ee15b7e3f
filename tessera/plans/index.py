from __future__ import annotations

from tessera.operators import index as I
from tessera.operators import words as W
from tessera.plans.registry import register
from tessera.plans.sqlparts import tokens_sql
from tessera.session import scratch_path
from tessera.sources.sinks import write_index
from tessera.sources.tables import read_table

BLOCK = I.BLOCK_DOCS
QUERIES = ["the de AND of OR", "the of AND", "de nosuchterm OR", "the nosuchterm AND"]  # fixed rows

TF_CTE = f"""doc_toks AS (SELECT doc_id, {tokens_sql('text')} AS t FROM documents),
tf AS (SELECT term, doc_id, count(*) AS tf FROM (SELECT doc_id, unnest(t) AS term FROM doc_toks) GROUP BY term, doc_id)"""

GAPS_SQL = f"""WITH {TF_CTE}
SELECT term, CAST(floor(doc_id / {BLOCK}) AS BIGINT) AS block,
       CAST(row_number() OVER (PARTITION BY term, floor(doc_id / {BLOCK}) ORDER BY doc_id) AS INTEGER) AS seq,
       doc_id, tf, doc_id - coalesce(lag(doc_id) OVER (PARTITION BY term ORDER BY doc_id), 0) AS gap
FROM tf"""

PRESENCE_CTE = f"""{TF_CTE},
pres AS (SELECT doc_id, bool_or(term = 'the') AS a, bool_or(term = 'de') AS b, bool_or(term = 'of') AS c,
                bool_or(term = 'nosuchterm') AS d FROM tf GROUP BY doc_id),
hits AS (SELECT 0 AS query_id, doc_id FROM pres WHERE (a AND b) OR c
         UNION ALL SELECT 1, doc_id FROM pres WHERE a AND c
         UNION ALL SELECT 2, doc_id FROM pres WHERE b OR d
         UNION ALL SELECT 3, doc_id FROM pres WHERE a AND d)"""


def _tf(spark, sf):
    return I.term_frequency(W.doc_tokens(read_table(spark, sf, "documents")))


def _blocks(spark, sf):
    return I.posting_blocks(I.blocked_frequency(read_table(spark, sf, "documents"), BLOCK)).checkpoint()


@register("term_frequency", f"WITH {TF_CTE} SELECT term, doc_id, tf FROM tf")
def term_frequency(spark, sf):
    return _tf(spark, sf)


@register("inverted_index", f"""WITH {TF_CTE}
SELECT term, CAST(floor(doc_id / {BLOCK}) AS BIGINT) AS block,
       CAST(sum(count(*)) OVER (PARTITION BY term) AS BIGINT) AS df, count(*) AS n,
       string_agg(CAST(doc_id AS VARCHAR) || ':' || CAST(tf AS VARCHAR), ' ' ORDER BY doc_id) AS postings
FROM tf GROUP BY term, floor(doc_id / {BLOCK})""")
def inverted_index(spark, sf):
    ix = I.with_df(_blocks(spark, sf))
    return ix.select("term", "block", "df", "n", I.postings_text(ix["postings"]).alias("postings"))


def _coded(spark, sf):
    return I.encode_postings(_blocks(spark, sf))


@register("postings_gaps", GAPS_SQL)
def postings_gaps(spark, sf):
    return I.gap_rows(_coded(spark, sf))


@register("postings_decode", f"WITH {TF_CTE} SELECT term, doc_id, tf FROM tf")
def postings_decode(spark, sf):
    return I.decode_postings(_coded(spark, sf))


@register("boolean_and", f"""WITH {TF_CTE}
SELECT doc_id FROM tf WHERE term = 'the' INTERSECT SELECT doc_id FROM tf WHERE term = 'of'""")
def boolean_and(spark, sf):
    return I.docs_with_all(_tf(spark, sf), ["the", "of"])


@register("boolean_or", f"""WITH {TF_CTE}
SELECT doc_id FROM tf WHERE term = 'de' UNION SELECT doc_id FROM tf WHERE term = 'nosuchterm'""")
def boolean_or(spark, sf):
    return I.docs_with_any(_tf(spark, sf), ["de", "nosuchterm"])


@register("index_lookup", f"WITH {PRESENCE_CTE} SELECT query_id, doc_id FROM hits")
def index_lookup(spark, sf):
    # The index is written once; the queries are answered from its files alone.
    base = scratch_path(spark, "index")
    write_index(_coded(spark, sf), base, int(spark.conf.get("spark.sql.shuffle.partitions")))
    stored = I.open_terms(spark, base, I.query_terms(QUERIES))
    return I.boolean_queries(I.decode_postings(stored), QUERIES)


@register("boolean_rpn", f"WITH {PRESENCE_CTE} SELECT query_id, doc_id FROM hits")
def boolean_rpn(spark, sf):
    return I.boolean_queries(_tf(spark, sf), QUERIES)


@register("retrieve_snippets", f"""WITH {PRESENCE_CTE},
first AS (SELECT doc_id, string_split(text, chr(10))[1] AS l FROM documents)
SELECT h.query_id, h.doc_id, CASE WHEN length(f.l) > 80 THEN substr(f.l, 1, 80) || '...' ELSE f.l END AS snippet
FROM hits h JOIN first f ON f.doc_id = h.doc_id""")
def retrieve_snippets(spark, sf):
    docs = read_table(spark, sf, "documents")
    hits = I.boolean_queries(_tf(spark, sf), QUERIES)
    return I.retrieve_snippets(hits, docs)
