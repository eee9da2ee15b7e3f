from tessera.functions.text import (  # noqa: F401
    tokenize, bigram_structs, feature_id, snippet, first_distinct,
)
