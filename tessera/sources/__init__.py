from tessera.sources.tables import (  # noqa: F401
    TABLES, read_table, spread, corpus_lines, read_text_corpus, read_delimited, write_delimited,
    read_adjacency_text, read_instances_text, read_model_text, LINEITEM_SCHEMA,
)
