"""Registered queries of the training-data operators: ``QUERIES`` and ``ORACLE_SQL``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (langid, mixing, neardup, negatives, neighbours, packing, perplexity, quality, sharding, substrings, suffixes,
               toxicity, whitening)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), with_ids=False)


def op2_probminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.duplicate_report(_table(spark, sf_dir, "documents"))


def op3_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op4_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search_embeddings(_table(spark, sf_dir, "embeddings"))


def op5_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op6_compression_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op7_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_levenshtein_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.perplexity_report(_table(spark, sf_dir, "documents"))


def op10_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_report(_table(spark, sf_dir, "documents"), null_last=False)


def op11_zone_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(_table(spark, sf_dir, "embeddings"))


def op12_chebyshev_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, sf_dir, "embeddings"))


def op13_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_report(_table(spark, sf_dir, "documents"), null_last=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_packing, op2_probminhash, op3_entropy_balancing, op4_stable_projections, op5_rendezvous,
    op6_compression_langid, op7_ordinal_quality, op8_levenshtein_toxicity, op9_perplexity, op10_phrase_automata,
    op11_zone_negatives, op12_chebyshev_whitening, op13_suffix_sort)}

_HEX = "('0x' || substr(md5(k || ':{s}'), 1, 13))::BIGINT"
_DRAWS = ", ".join(_HEX.format(s=s) for s in range(17))

# Words covered by a window of 13 that starts in a smaller document, and bytes covered by a string of 50 that does. A place is
# covered if the last removed window that starts at or before it reaches it.
_WORD_REPEATS = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS t FROM documents),
w AS (SELECT doc_id, unnest(range(1, len(t) - 11)) AS p,
             unnest(list_transform(range(1, len(t) - 11), lambda i: md5_number(array_to_string(t[i:i + 12], ' ')))) AS s FROM d),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS low FROM w) WHERE low < doc_id),
b AS (SELECT doc_id, unnest(range(1, len(t) + 1)) AS p, unnest(t) AS c FROM d),
m AS (SELECT b.doc_id, b.p, b.c, coalesce(max(gone.p) OVER (PARTITION BY b.doc_id ORDER BY b.p) > b.p - 13, false) AS out
      FROM b LEFT JOIN gone ON gone.doc_id = b.doc_id AND gone.p = b.p),
k AS (SELECT doc_id, count(*) FILTER (WHERE out) AS n_removed, string_agg(c, ' ' ORDER BY p) FILTER (WHERE NOT out) AS kept
      FROM m GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.t) AS BIGINT) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""

_BYTE_REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
w AS (SELECT doc_id, unnest(range(0, n - 49)) AS p,
             unnest(list_transform(range(0, n - 49), lambda i: md5_number(substr(h, 2 * i + 1, 100)))) AS s FROM d),
gone AS (SELECT doc_id, p FROM (SELECT doc_id, p, min(doc_id) OVER (PARTITION BY s) AS low FROM w) WHERE low < doc_id),
b AS (SELECT doc_id, unnest(range(0, n)) AS p, unnest(regexp_extract_all(h, '..')) AS c FROM d),
m AS (SELECT b.doc_id, b.p, b.c, coalesce(max(gone.p) OVER (PARTITION BY b.doc_id ORDER BY b.p) > b.p - 50, false) AS out
      FROM b LEFT JOIN gone ON gone.doc_id = b.doc_id AND gone.p = b.p),
e AS (SELECT *, out AND NOT coalesce(lag(out) OVER (PARTITION BY doc_id ORDER BY p), false) AS opens FROM m),
k AS (SELECT doc_id, count(*) FILTER (WHERE out) AS n_removed, count(*) FILTER (WHERE opens) AS n_spans,
             string_agg(c, '' ORDER BY p) FILTER (WHERE NOT out) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, d.n AS n_bytes, coalesce(k.n_removed, 0) AS n_removed, coalesce(k.n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id"""

# Every inner product of every anchor, then the windows of scores.
_HARD_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(CAST(c AS DOUBLE)))) = 0),
s AS (SELECT a.rid, a.vec_id AS anchor_id, a.label AS own, v.rid AS other, v.vec_id, v.label,
             CAST(list_dot_product(a.x, v.x) AS BIGINT) AS score
      FROM v a JOIN v ON v.rid <> a.rid WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.rid, p.other ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.rid = p.rid AND s.label <> s.own AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score
QUALIFY rank <= 5"""

ORACLE_SQL: dict[str, str] = {
    "op10_phrase_automata": _WORD_REPEATS,
    "op11_zone_negatives": _HARD_NEGATIVES,
    "op13_suffix_sort": _BYTE_REPEATS,
    "op5_rendezvous": f"""
WITH d AS (
  SELECT doc_id, text, coalesce(strlen(text), 0) + 1 AS size,
         coalesce(doc_id::VARCHAR, chr(0) || 'null') AS k FROM documents),
s AS (
  SELECT doc_id, k, size, text, [{_DRAWS}] AS h FROM d),
-- CRC-32 byte by byte: the table of the reflected polynomial, then one step for each byte.
crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
           lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab),
t AS (
  SELECT doc_id, k, size,
         xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(
           regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda x: ('0x' || x)::BIGINT)),
           lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))) AS text_crc32,
         list_position(h[1:16], list_max(h[1:16])) - 1 AS shard,
         list_position(h, list_max(h)) - 1 AS grown_shard,
         ('0x' || substr(md5(k || ':slot'), 1, 13))::BIGINT % 1024 AS part FROM s, crc)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, grown_shard,
       row_number() OVER (PARTITION BY shard ORDER BY part, doc_id NULLS FIRST, size) - 1 AS slot
FROM t""",
}
