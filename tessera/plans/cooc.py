from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import cooc as C
from tessera.operators import words as W
from tessera.plans.registry import register
from tessera.plans.sqlparts import LINE_TOKENS_CTE
from tessera.sources.tables import read_table

THRESHOLD = 10  # pair threshold of the PMI keys

WORDS_CTE = LINE_TOKENS_CTE + """,
lw AS (SELECT list_distinct(t[1:40]) AS w FROM line_toks),
lf AS (SELECT x AS word, count(*) AS n_lines FROM (SELECT unnest(w) AS x FROM lw) GROUP BY x),
pa AS (SELECT x, unnest(list_filter(w, lambda z: z <> x)) AS y FROM (SELECT w, unnest(w) AS x FROM lw)),
pc AS (SELECT x, y, count(*) AS n FROM pa GROUP BY x, y)"""

PMI_SQL = f"""
WITH {WORDS_CTE},
pmi AS (SELECT pc.x, pc.y, round(log10(CAST(pc.n AS DOUBLE) * (SELECT count(*) FROM lines)
          / (CAST(a.n_lines AS DOUBLE) * CAST(b.n_lines AS DOUBLE))), 6) AS pmi, pc.n
        FROM pc JOIN lf a ON a.word = pc.x JOIN lf b ON b.word = pc.y WHERE pc.n >= {THRESHOLD})"""


def _words(spark, sf):
    return C.line_words(W.line_tokens(read_table(spark, sf, "documents")))


@register("line_frequency", f"WITH {WORDS_CTE} SELECT word, n_lines FROM lf")
def line_frequency(spark, sf):
    return C.line_frequency(_words(spark, sf))


@register("pair_count", f"WITH {WORDS_CTE} SELECT x, y, n FROM pc")
def pair_count(spark, sf):
    return C.pair_count(_words(spark, sf))


@register("pmi_pairs", PMI_SQL + " SELECT x, y, pmi, n FROM pmi")
def pmi_pairs(spark, sf):
    return C.pmi_pairs(_words(spark, sf), THRESHOLD).withColumn("pmi", F.round("pmi", 6))


@register("pmi_stripes", PMI_SQL + """
SELECT x, y, pmi, n FROM pmi WHERE x IN (SELECT x FROM pmi GROUP BY x HAVING count(*) >= 2)""")
def pmi_stripes(spark, sf):
    s = C.pmi_stripes(_words(spark, sf), THRESHOLD, min_partners=2)
    return C.stripes_long(s).withColumn("pmi", F.round("pmi", 6))
