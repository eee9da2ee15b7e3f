"""Word co-occurrence inside a line and pointwise mutual information (pairs and stripes).

A line contributes the distinct words among its first 40 tokens (at most 40*39/2 pairs a line). Pairs are
generated and counted inside tasks over runs of lines, on arrays of word codes: no self-join, and what is
shuffled are counted pairs of codes, a byte or two each, not rows of pairs. Lines of each word are counted first.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions import pairs as P
from tessera.functions.text import first_distinct, nonempty
from tessera.operators.words import from_stripes, to_stripes
from tessera.session import scratch_path

WINDOW = 40  # first tokens of a line that take part (fixed by the studied jobs)


def line_words(tokens: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, line_no, words) with distinct words of the first ``window`` tokens."""
    return tokens.select("doc_id", "line_no", first_distinct(F.col("tokens"), window).alias("words"))


def line_frequency(words: DataFrame) -> DataFrame:
    """A5: number of lines each word occurs in -> (word, n_lines)."""
    return (words.select(F.explode_outer("words").alias("word")).where(nonempty("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n_lines")))


def _stored_frequency(words: DataFrame) -> DataFrame:
    """``line_frequency``, counted once and kept below the shared folder: codes, totals and joins all read it."""
    path = scratch_path(words.sparkSession, "line-frequency")
    line_frequency(words).write.parquet(path)
    return words.sparkSession.read.parquet(path)


def _known(lf: DataFrame, least: int) -> P.Known:
    """Codes for the most frequent words, ``P.WORDS`` at most, and bits for the others in ``least`` lines or more (a pair's count
    never exceeds either word's); what the driver gets is bounded."""
    often = (lf.where(F.col("n_lines") >= least).groupBy("n_lines").agg(F.count(F.lit(1)).alias("words"))
             .orderBy(F.desc("n_lines")).limit(P.WORDS + 1).toArrow())
    upto = np.cumsum(often["words"].to_numpy())
    n_lines = often["n_lines"].to_numpy()[upto <= P.WORDS]
    from_lines = int(n_lines[-1]) if len(n_lines) else None
    top = lf.where(F.col("n_lines") >= from_lines if len(n_lines) else F.lit(False)).toArrow().sort_by([("n_lines", "descending"), ("word", "ascending")])
    slots = None
    if least > 1:
        slot = F.crc32(F.encode("word", "UTF-8")) % P.SLOTS + 1  # the bitmap functions count from 1
        rest = lf.where(F.col("n_lines") >= least)
        if len(n_lines):
            rest = rest.where(F.col("n_lines") < from_lines)
        slots = np.zeros(P.SLOTS // 8, np.uint8)
        size = 4096  # bytes that bitmap_construct_agg makes
        for r in (rest.groupBy(F.bitmap_bucket_number(slot).alias("block"))
                  .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits")).collect()):
            slots[(r.block - 1) * size:r.block * size] |= np.frombuffer(bytes(r.bits), np.uint8)
    return P.Known(top["word"].combine_chunks().cast(pa.string()), top["n_lines"].to_numpy(), slots)


def _dealt(words: DataFrame, known: P.Known) -> DataFrame:
    """Pairs of each task's lines, dealt and sorted for ``P.merge_pairs``.

    A task counts the pairs of a run of its lines and sends them in few rows (``functions.pairs``): the pairs of known words
    by tile, the others by word. The rows are dealt and sorted by word and piece, so that neighbours are summed as they stream by:
    no pair is a row of its own before it is counted, and nothing holds more than a bounded run of lines or rows."""
    def send(batches):
        return P.send_pairs(batches, known)
    sent = words.select(F.array_compact("words").alias("words")).mapInArrow(send, P.EXCHANGE)
    return sent.repartition(F.col("x"), F.col("piece")).sortWithinPartitions("x", "piece")


def _mirror(df: DataFrame) -> DataFrame:
    """Both orientations of symmetric pair rows (x < y) -> (x, y, ...) and (y, x, ...),
    generated from one pass over ``df`` (a union would read and finish it twice)."""
    rest = [F.col(c) for c in df.columns if c not in ("x", "y")]
    both = F.array(F.struct(F.col("x").alias("x"), F.col("y").alias("y"), *rest),
                   F.struct(F.col("y").alias("x"), F.col("x").alias("y"), *rest))
    return df.select(F.inline(both))


def pair_count(words: DataFrame) -> DataFrame:
    """Lines in which both words of a pair occur -> (x, y, n), both orientations.

    ``n(x, y) = n(y, x)``, so each unordered pair is counted once and mirrored after
    the aggregation: half the rows shuffled and aggregated."""
    known = _known(_stored_frequency(words), 1)
    return _dealt(words, known).mapInArrow(P.merge_pairs(1, True, known), "x string, y string, n long")


def pmi_pairs(words: DataFrame, threshold: int = 1) -> DataFrame:
    """PMI ``log10(n(x,y) * N / (n(x) * n(y)))`` of pairs seen in at least
    ``threshold`` lines; ``N`` counts every line, blank ones too -> (x, y, pmi, n).

    PMI is symmetric: it is computed once per unordered pair and mirrored. ``N`` is a
    scalar subquery, not a cross join. The most frequent words' totals come with their
    codes (a bounded number of words), so their pairs are shuffled no more; the totals
    of all other words are joined (AQE picks broadcast or shuffle from their real size:
    the vocabulary grows with the corpus, so nothing is forced). Pairs below the
    threshold end where they are summed; words below it are not paired.
    """
    n_lines = words.select(F.count(F.lit(1)).cast("double")).scalar()
    lf = _stored_frequency(words)
    known = _known(lf, threshold)
    dealt = _dealt(words, known)
    pairs = dealt.mapInArrow(P.merge_pairs(threshold, False, known, "known"), "x string, y string, n long, n_x long, n_y long")
    if known.others:
        lf = lf.where(F.col("n_lines") >= threshold)
        fx = lf.select(F.col("word").alias("x"), F.col("n_lines").alias("n_x"))
        fy = lf.select(F.col("word").alias("y"), F.col("n_lines").alias("n_y"))
        others = dealt.mapInArrow(P.merge_pairs(threshold, False, known, "others"), "x string, y string, n long")
        pairs = pairs.unionByName(others.join(fx, "x").join(fy, "y"))
    one = pairs.select("x", "y",
                       F.log10(F.col("n").cast("double") * n_lines
                               / (F.col("n_x").cast("double") * F.col("n_y").cast("double"))).alias("pmi"),
                       "n")
    return _mirror(one)


def pmi_stripes(words: DataFrame, threshold: int = 1, min_partners: int = 1,
                pieces: int | None = None) -> DataFrame:
    """F6 + A7: PMI stripes ``(x, piece, stripe MAP<y, STRUCT<pmi, n>>)``, keeping words
    with at least ``min_partners`` partners over all pieces. Pairs are dealt by ``x`` once:
    partners are counted and gathered where they lie."""
    p = pmi_pairs(words, threshold)
    deg = F.count(F.lit(1)).over(Window.partitionBy("x"))
    p = p.withColumn("_deg", deg).where(F.col("_deg") >= min_partners)
    return to_stripes(p, "x", "y", ["pmi", "n"], pieces, degree_col="_deg")


def stripes_long(stripes: DataFrame) -> DataFrame:
    """PMI stripes back to (x, y, pmi, n)."""
    return from_stripes(stripes, "x", "y", ["pmi", "n"])
