"""Inverted index, gap coding and Boolean retrieval.

Primary form is the row table ``(term, doc_id, tf)``. The array form is cut into blocks of document-id
ranges (``block = doc_id div block_docs``), so a posting array never holds more than ``block_docs`` entries
however common the term; ``df`` is summed over blocks.

The coded form holds the gaps between documents, exact over the whole list. A block's ``base`` is the last
document of the term before it. It comes from a directory of two levels (the blocks of a super-block, the
super-blocks of a term), both small arrays, so nothing ever orders all postings of a term; inside a block
every ``RUN`` postings have a skip entry. A block is decoded from its own row alone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import nonempty, snippet, tokenize
from tessera.session import scratch_path

BLOCK_DOCS = 1024  # document ids per posting block
SUPER_BLOCKS = 1024  # blocks under one entry of the upper directory
RUN = 32  # postings of a block between two skip entries


def term_frequency(doc_tokens: DataFrame) -> DataFrame:
    """A12/SRC2: (term, doc_id, tf) from (doc_id, tokens)."""
    return (doc_tokens.select("doc_id", F.explode_outer("tokens").alias("term")).where(nonempty("term"))
            .groupBy("term", "doc_id").agg(F.count(F.lit(1)).alias("tf")))


def blocked_frequency(documents: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """A12/SRC2: (block, term, doc_id, tf) of documents dealt by their block of ids.

    The texts of a block meet in one task, so its counts and then its postings need no further exchange: texts are
    shuffled once, in place of a row for each term of a document twice. Blocks hold ``block_docs`` ids; rows of one id (a
    null one, too) are one task's."""
    docs = with_block(documents.select("doc_id", "text"), block_docs).repartition(F.col("block"))
    return (docs.select("block", "doc_id", tokenize(F.col("text")).alias("tokens"))
            .select("block", "doc_id", F.explode_outer("tokens").alias("term")).where(nonempty("term"))
            .groupBy("block", "term", "doc_id").agg(F.count(F.lit(1)).alias("tf")))


def with_block(tf: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    # Floor of the quotient in whole numbers (a double would lose large ids).
    return tf.withColumn("block", F.expr(f"(doc_id - pmod(doc_id, {block_docs}L)) div {block_docs}L"))


def posting_blocks(tf: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, n, postings ARRAY<STRUCT<doc_id, tf>> by doc_id); ``tf`` may have its ``block``."""
    rows = tf if "block" in tf.columns else with_block(tf, block_docs)
    return (rows.groupBy("term", "block")
            .agg(F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list(F.struct("doc_id", "tf"))).alias("postings")))


def index_blocks(tf: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(term, block, df, n, postings ARRAY<STRUCT<doc_id, tf>> by doc_id)."""
    return with_df(posting_blocks(tf, block_docs))


def with_df(blocks: DataFrame) -> DataFrame:
    """Posting blocks with their term's document frequency. ``blocks`` is read twice: pass a checkpointed or stored table."""
    # df is a partial aggregation of its own, joined back: a window by term would bring all postings
    # of a common term into one task.
    df = blocks.groupBy("term").agg(F.sum("n").alias("df"))
    return blocks.join(df, "term").select("term", "block", "df", "n", "postings")


def postings_text(postings: Column) -> Column:
    """Postings array as ``doc:tf doc:tf ..`` text (for display and checks)."""
    return F.array_join(F.transform(postings, lambda p: F.concat(p["doc_id"].cast("string"), F.lit(":"),
                                                                  p["tf"].cast("string"))), " ")


def block_bases(blocks: DataFrame, super_blocks: int = SUPER_BLOCKS) -> DataFrame:
    """WF4/A13: (term, block, base, df) of every term of two blocks or more: the last document of the term before the block
    (0 before its first), and the term's document frequency. In a term of one block they are 0 and ``n``.

    Two levels of arrays: the last documents of the blocks of a super-block (``super_blocks`` at most), and those of a
    term's super-blocks. ``blocks`` needs term, block, n and postings."""
    last = blocks.select("term", "block", "n", F.element_at("postings", -1)["doc_id"].alias("last"))
    lower = (last.withColumn("upper", F.expr(f"(block - pmod(block, {super_blocks}L)) div {super_blocks}L"))
             .groupBy("term", "upper")
             .agg(F.sort_array(F.collect_list(F.struct("block", "last"))).alias("entries"), F.max("last").alias("last"),
                  F.sum("n").alias("n"), F.count(F.lit(1)).alias("held")))
    tops = (lower.groupBy("term")
            .agg(F.sort_array(F.collect_list(F.struct("upper", "last"))).alias("tops"), F.sum("n").alias("df"), F.sum("held").alias("held"))
            .where(F.col("held") > 1))
    before = tops.select("term", "df", F.inline(F.expr("transform(tops, (e, i) -> struct(e.upper, coalesce(get(tops, i - 1).last, 0L) AS before))")))
    bases = "transform(entries, (e, i) -> struct(e.block, coalesce(get(entries, i - 1).last, before) AS base))"
    return (lower.select("term", "upper", "entries").join(before, ["term", "upper"])
            .select("term", "df", F.inline(F.expr(bases))))


def encode_postings(blocks: DataFrame, super_blocks: int = SUPER_BLOCKS) -> DataFrame:
    """T17 encode: (term, block, df, n, base, skips, gaps, tfs) from ``posting_blocks``.

    ``gaps`` are distances to the term's previous document (the first one keeps its id), ``skips`` the last document of
    each full run of ``RUN`` postings, ``tfs`` the frequencies. ``blocks`` is read twice, by the directory and by the
    codes: pass a checkpointed or stored table."""
    rows = (blocks.select("term", "block", "n", "postings").join(block_bases(blocks, super_blocks), ["term", "block"], "left")
            .withColumn("ids", F.transform("postings", lambda p: p["doc_id"]))
            .withColumn("base", F.coalesce("base", F.lit(0).cast("long"))))
    return rows.select(
        "term", "block", F.coalesce("df", "n").alias("df"), "n", "base",
        F.expr(f"if(n >= {RUN}, transform(sequence({RUN}, cast(n AS int), {RUN}), k -> element_at(ids, k)), cast(array() AS array<bigint>))").alias("skips"),
        F.expr("transform(ids, (d, i) -> d - coalesce(get(ids, i - 1), base))").alias("gaps"),
        F.transform("postings", lambda p: p["tf"]).alias("tfs"))


def decoded_ids() -> Column:
    """Document ids of a coded block: the skip entry (or base) before a posting's run plus the gaps of the run up to it."""
    run = f"cast(i div {RUN} AS int)"
    return F.expr(f"transform(gaps, (g, i) -> if(i < {RUN}, base, get(skips, {run} - 1))"
                  f" + aggregate(slice(gaps, {run} * {RUN} + 1, i % {RUN} + 1), 0L, (s, x) -> s + x))")


def decode_postings(coded: DataFrame) -> DataFrame:
    """T17 decode: coded blocks -> (term, doc_id, tf); each row by itself, no shuffle."""
    return (coded.select("term", F.arrays_zip(decoded_ids().alias("doc_id"), F.col("tfs").alias("tf")).alias("p"))
            .select("term", F.inline_outer("p")).where(nonempty("doc_id")))


def gap_rows(coded: DataFrame) -> DataFrame:
    """The coded index one posting a row: (term, block, seq, doc_id, tf, gap), ``seq`` from 1 in a block."""
    zipped = F.arrays_zip(decoded_ids().alias("doc_id"), F.col("tfs").alias("tf"), F.col("gaps").alias("gap"))
    return (coded.select("term", "block", F.posexplode_outer(zipped).alias("i", "p")).where(nonempty("p"))
            .select("term", "block", (F.col("i") + 1).alias("seq"), "p.doc_id", "p.tf", "p.gap"))


# ---------------------------------------------------------------- the stored index

def open_terms(spark: SparkSession, base: str, terms: list[str]) -> DataFrame:
    """The coded blocks of ``terms`` from an index written by ``sinks.write_index``.

    The manifest tells which files hold a term range that some term falls into; only those are listed, opened and read,
    and inside them the filter skips row groups by their statistics."""
    wanted = sorted({normalize_term(t) for t in terms})
    manifest = spark.read.parquet(f"{base}/manifest")
    hit = F.exists(F.array(*[F.lit(t) for t in wanted]), lambda t: (F.col("first") <= t) & (t <= F.col("last"))) if wanted else F.lit(False)
    files = sorted(r["file"] for r in manifest.where(hit).select("file").collect())
    data = f"{base}/data"
    if not files:
        return spark.read.parquet(data).where("1 = 0")
    return spark.read.option("basePath", data).parquet(*[f"{data}/{f}" for f in files]).where(F.col("term").isin(wanted))


# ---------------------------------------------------------------- Boolean retrieval

def normalize_term(t: str) -> str:
    """A query term through the tokeniser contract (lower case, letters a-z at both ends)."""
    return re.sub(r"^[^a-z]+|[^a-z]+$", "", t.lower())


def doc_set(tf: DataFrame, term: str) -> DataFrame:
    """Documents holding ``term`` -> (doc_id); the term filter reaches a stored index's scan."""
    return tf.where(F.col("term") == normalize_term(term)).select("doc_id")


def docs_and(a: DataFrame, b: DataFrame) -> DataFrame:
    """Intersection of two document sets."""
    return a.intersect(b)


def docs_or(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union of two document sets without duplicates."""
    return a.union(b).distinct()


def _hits(tf: DataFrame, terms: list[str]) -> DataFrame:
    return tf.where(F.col("term").isin(sorted({normalize_term(t) for t in terms})))


def docs_with_all(tf: DataFrame, terms: list[str]) -> DataFrame:
    """U1 on terms: documents that hold every one, from one pass over the postings -> (doc_id)."""
    n = len({normalize_term(t) for t in terms})
    return _hits(tf, terms).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n).select("doc_id")


def docs_with_any(tf: DataFrame, terms: list[str]) -> DataFrame:
    """U2/U4 on terms: documents that hold at least one, from one pass over the postings -> (doc_id)."""
    return _hits(tf, terms).select("doc_id").distinct()


def parse_postfix(query: str):
    """Postfix ``t1 t2 AND t3 OR`` -> nested tuples ``('AND', l, r)`` / ``('T', term)``."""
    stack = []
    for tok in query.split():
        if tok in ("AND", "OR"):
            if len(stack) < 2:
                raise ValueError(f"malformed postfix query: {query!r}")
            r, l_ = stack.pop(), stack.pop()
            stack.append((tok, l_, r))
        else:
            stack.append(("T", normalize_term(tok)))
    if len(stack) != 1:
        raise ValueError(f"malformed postfix query: {query!r}")
    return stack[0]


def _terms(node) -> set[str]:
    return {node[1]} if node[0] == "T" else _terms(node[1]) | _terms(node[2])


def _expr(node, present: Column) -> Column:
    if node[0] == "T":
        return F.array_contains(present, node[1])
    l_, r = _expr(node[1], present), _expr(node[2], present)
    return (l_ & r) if node[0] == "AND" else (l_ | r)


def query_terms(queries: list[str]) -> list[str]:
    """The terms of a batch of postfix queries."""
    return sorted(set().union(*[_terms(parse_postfix(q)) for q in queries]))


def boolean_queries(tf: DataFrame, queries: list[str]) -> DataFrame:
    """A batch of postfix queries in one pass -> (query_id, doc_id).

    Only postings of query terms are read (an ``IN`` filter, pushed to a stored index's
    scan). Per document the set of present query terms is gathered (bounded by the query
    batch, not by the data) and each query is one Boolean column over it.
    """
    trees = [parse_postfix(q) for q in queries]
    hits = tf.where(F.col("term").isin(query_terms(queries)))
    present = hits.groupBy("doc_id").agg(F.collect_set("term").alias("present"))
    ids = F.array(*[F.when(_expr(t, F.col("present")), F.lit(i)) for i, t in enumerate(trees)])
    return (present.select(F.explode(F.filter(ids, lambda x: x.isNotNull())).alias("query_id"), "doc_id"))


def fetch_rows(table: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``table`` whose ``key`` is in ``keys``: a semi join.

    Where ``keys`` is a filtered scan that is small beside a large ``table``, Spark builds a Bloom filter of
    the keys at run time and applies it in the scan of ``table``, so rows that miss are not shuffled."""
    return table.join(keys.select(key).distinct(), key, "left_semi")


def retrieve_snippets(hits: DataFrame, documents: DataFrame, width: int = 80) -> DataFrame:
    """Hits with the first line of their document, cut to ``width`` characters.

    The hits go to a table in the shared folder: what found them is not run again for the join, and the scan of that
    table is the creation side from which Spark makes its run-time Bloom filter for a large ``documents``."""
    spark = hits.sparkSession
    path = scratch_path(spark, "hits")
    hits.write.parquet(path)
    found = spark.read.parquet(path).where(F.col("query_id") >= 0)
    docs = documents.select("doc_id", "text")
    return found.join(docs, "doc_id").select(*hits.columns, snippet(F.col("text"), width).alias("snippet"))
