from __future__ import annotations

import pytest


@pytest.fixture()
def make(spark):
    """Rows to a DataFrame; the schema is a DDL string."""
    def build(rows, schema="doc_id long, text string, lang string, source string, n_chars long"):
        return spark.createDataFrame(rows, schema)
    return build


@pytest.fixture()
def docs(make):
    """(doc_id, text, ...) rows to a table of documents."""
    def build(pairs, lang="en", source="s"):
        return make([(i, t, lang, source, None if t is None else len(t)) for i, t in pairs])
    return build
