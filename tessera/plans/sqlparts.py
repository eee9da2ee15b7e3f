"""DuckDB SQL fragments shared by the oracle answers (independent of the Spark code)."""

# Tokeniser contract in DuckDB: same separators and edge stripping as the Spark expression.
def tokens_sql(text: str) -> str:
    return (
        "list_filter(list_transform(regexp_split_to_array(lower(" + text + "), '[ \\t\\n\\r\\f]+'), "
        "lambda p: regexp_replace(p, '^[^a-z]+|[^a-z]+$', '', 'g')), lambda p: p <> '')"
    )


# Corpus by line: (doc_id, line_no from 0, line).
LINES_CTE = (
    "lines AS (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no, "
    "unnest(string_split(text, chr(10))) AS line FROM documents)"
)

# Tokens per line.
LINE_TOKENS_CTE = LINES_CTE + ", line_toks AS (SELECT doc_id, line_no, " + tokens_sql("line") + " AS t FROM lines)"

# Tokens per document, one row per token occurrence (pos from 0).
DOC_TOKENS_CTE = (
    "doc_toks AS (SELECT doc_id, " + tokens_sql("text") + " AS t FROM documents), "
    "occ AS (SELECT doc_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token FROM doc_toks)"
)
