"""Column expressions for text. All built-in, so they stay in whole-stage codegen.

Tokeniser contract (T1): lower-case; split on runs of space, tab, newline, carriage
return and form feed; strip characters outside ``a-z`` from both ends of each piece; drop
empty pieces. Inner characters stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tokeniser contract.
SEPARATORS = "[ \\t\\n\\r\\f]+"
EDGE_JUNK = "^[^a-z]+|[^a-z]+$"

# The same contract on the whole text at once: a token starts at a letter and reaches to the last
# letter before the next separator. Each character is looked at a bounded number of times, also in a
# long run without letters.
TOKEN = "[a-z](?:[^ \\t\\n\\r\\f]*[a-z])?"


def tokenize(text: Column) -> Column:
    """ARRAY<STRING> of tokens of ``text``, without lambdas, so it stays inside whole-stage
    code generation (tests compare it with a plain Python version of the contract)."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def tokenize_per_piece(text: Column) -> Column:
    """T1 spelled out piece by piece (reference form of the contract)."""
    pieces = F.split(F.lower(text), SEPARATORS)
    stripped = F.transform(pieces, lambda p: F.regexp_replace(p, EDGE_JUNK, ""))
    return F.filter(stripped, lambda p: p != "")


def bigram_structs(tokens: Column) -> Column:
    """WF2/T13: ARRAY<STRUCT<x, y>> of each token and the one after it (``sliding(2)``).

    Equal to ``lead`` over token position, computed inside the row: no shuffle.
    """
    n = F.greatest(F.size(tokens) - 1, F.lit(0))
    return F.arrays_zip(F.slice(tokens, 1, n).alias("x"), F.slice(tokens, 2, n).alias("y"))


def first_distinct(tokens: Column, limit: int = 40) -> Column:
    """Distinct words among the first ``limit`` tokens (duplicates taken first)."""
    return F.array_distinct(F.slice(tokens, 1, limit))


def feature_id(token: Column, buckets: int = 1000) -> Column:
    """Feature number of a token: first 24 bits of its MD5, modulo ``buckets``.

    MD5 (not Spark's murmur hash) so that any SQL engine computes the same number.
    """
    return F.pmod(F.conv(F.substring(F.md5(token), 1, 6), 16, 10).cast("bigint"), F.lit(buckets))


def nonempty(col_name: str) -> Column:
    """Filter that follows an outer generator (``explode_outer`` & co.).

    Outer generators are used on computed arrays on purpose: for a plain ``explode``
    Catalyst infers ``size(array) > 0`` and pushes it, with the whole array expression
    substituted, below shuffles down to the scan, evaluating e.g. the tokeniser twice
    (and, on a single-split input, the first time in one task)."""
    return F.col(col_name).isNotNull()


def snippet(text: Column, width: int = 80) -> Column:
    """First line of a text, cut to ``width`` characters with ``...`` when longer."""
    first = F.substring_index(text, "\n", 1)
    return F.when(F.length(first) > width,
                  F.concat(F.substring(first, 1, width), F.lit("..."))).otherwise(first)
