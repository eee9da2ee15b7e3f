"""Token counting, anchor followers, bigram relative frequencies and stripes (maps).

Every count is a ``groupBy`` with Spark's partial (map-side) aggregation, so a very
common word is summed inside each task before anything is shuffled. Maps (stripes) are
built only from the pre-aggregated long form, so a stripe holds distinct partners, never
raw rows, and it is further cut into pieces by a hash of the partner.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import bigram_structs, nonempty, tokenize
from tessera.sources.tables import corpus_lines, spread


def doc_tokens(documents: DataFrame) -> DataFrame:
    """T1 per document -> (doc_id, tokens ARRAY<STRING>)."""
    docs = spread(documents.select("doc_id", "text"), "doc_id")
    return docs.select("doc_id", tokenize(F.col("text")).alias("tokens"))


def line_tokens(documents: DataFrame) -> DataFrame:
    """SRC1 + T1 per line -> (doc_id, line_no, tokens)."""
    docs = spread(documents.select("doc_id", "text"), "doc_id")
    return corpus_lines(docs).select("doc_id", "line_no", tokenize(F.col("line")).alias("tokens"))


def token_rows(tokens: DataFrame) -> DataFrame:
    """One row per token occurrence -> (doc_id, pos, token), ``pos`` from 0."""
    return (tokens.select("doc_id", F.posexplode_outer("tokens").alias("pos", "token"))
            .where(nonempty("token")))


def word_count(tokens: DataFrame) -> DataFrame:
    """Occurrences of each word -> (word, n)."""
    return (tokens.select(F.explode_outer("tokens").alias("word")).where(nonempty("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def line_word_count(tokens: DataFrame) -> DataFrame:
    """A1/A2 by line: occurrences of each word and the lines that hold it, from (doc_id, line_no, tokens), one row a line
    -> (word, n, n_lines).

    A line's tokens are sorted inside its row, where a word's first place counts the line, so nothing is shuffled
    but each task's counts by word."""
    ordered = tokens.select(F.sort_array("tokens").alias("ordered"))
    marked = F.expr("transform(ordered, (w, i) -> struct(w AS word, if(w <=> get(ordered, i - 1), 0L, 1L) AS line))")
    return (ordered.select(F.inline_outer(marked)).where(nonempty("word"))
            .groupBy("word").agg(F.count(F.lit(1)).alias("n"), F.sum("line").alias("n_lines")))


def follower_count(tokens: DataFrame, anchor: str = "the", min_count: int = 2) -> DataFrame:
    """WF3/F3/T20: words right after ``anchor`` within a line, kept when seen at least
    ``min_count`` times -> (word, n). Two anchors in a row: the second is a follower."""
    pairs = F.filter(bigram_structs(F.col("tokens")), lambda p: p["x"] == anchor)
    return (tokens.select(F.explode_outer(pairs).alias("p")).where(nonempty("p"))
            .groupBy(F.col("p.y").alias("word")).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") >= min_count))


def bigram_counts(tokens: DataFrame) -> DataFrame:
    """WF2/F8: counts of adjacent token pairs within a line -> (x, y, n)."""
    return (tokens.select(F.inline_outer(bigram_structs(F.col("tokens")))).where(nonempty("x"))
            .groupBy("x", "y").agg(F.count(F.lit(1)).alias("n")))


def bigram_freq(tokens: DataFrame) -> DataFrame:
    """WF1/T4: relative frequency ``n(x, y) / n(x, *)`` -> (x, y, n, freq).

    The marginal (order inversion without a sort) is a partially aggregated
    ``groupBy(x)`` joined back on ``x``: AQE broadcasts it when the vocabulary is small
    and otherwise splits a very common ``x`` across tasks (skew join), which a window
    partition could not.
    """
    c = bigram_counts(tokens)
    return (c.join(_marginals(c), "x")
            .select("x", "y", "n", (F.col("n") / F.col("n_x")).alias("freq")))


def _marginals(counts: DataFrame) -> DataFrame:
    """(x, n_x, deg): total count and number of distinct partners of each ``x``."""
    return counts.groupBy("x").agg(F.sum("n").alias("n_x"), F.count(F.lit(1)).alias("_deg"))


def bigram_marginals(tokens: DataFrame) -> DataFrame:
    """Detail counts and the marginal ``(x, '*')`` rows in one grouping-sets pass
    -> (x, y, n), ``y = '*'`` on marginal rows."""
    pairs = tokens.select(F.inline_outer(bigram_structs(F.col("tokens")))).where(nonempty("x"))
    g = pairs.groupingSets([["x", "y"], ["x"]], "x", "y").agg(
        F.count(F.lit(1)).alias("n"), F.grouping("y").alias("_gy"))
    return g.select("x", F.when(F.col("_gy") == 1, F.lit("*")).otherwise(F.col("y")).alias("y"), "n")


MAX_STRIPE_ENTRIES = 100_000  # partners held in one stripe piece at most


def piece_counts(longs: list[DataFrame], key: str, max_entries: int = MAX_STRIPE_ENTRIES) -> DataFrame:
    """(key, _pieces): into how many pieces a key's stripes are cut so that a piece holds about ``max_entries`` partners,
    from its partners in all tables of ``longs`` together; tables cut by it match piece by piece."""
    degrees = [d.groupBy(key).agg(F.count(F.lit(1)).alias("_deg")) for d in longs]
    every = degrees[0]
    for d in degrees[1:]:
        every = every.unionByName(d)
    return every.groupBy(key).agg(F.ceil(F.sum("_deg") / F.lit(max_entries)).alias("_pieces"))


def to_stripes(long: DataFrame, key: str, partner: str, value_cols: list[str],
               pieces: int | None = None, max_entries: int = MAX_STRIPE_ENTRIES,
               degree_col: str | None = None, pieces_of: DataFrame | None = None) -> DataFrame:
    """Long rows (one per key and partner) -> stripes ``(key, piece, stripe MAP)``.

    A stripe is cut into pieces by ``pmod(xxhash64(partner), P)``. ``P`` is the fixed number ``pieces``, or the key's
    own in ``pieces_of`` (see ``piece_counts``; two tables cut alike can be merged piece by piece), or
    ``ceil(partners / max_entries)`` per key, from a partially aggregated partner count (or ``degree_col`` when the
    caller has it), so no map holds more than about ``max_entries`` entries however common the key. The
    value is the single column or a struct of several.
    """
    val = F.col(value_cols[0]) if len(value_cols) == 1 else F.struct(*[F.col(c) for c in value_cols])
    if pieces is not None:
        n_pieces = F.lit(pieces)
    elif degree_col is not None:
        n_pieces = F.ceil(F.col(degree_col) / F.lit(max_entries))
    else:
        long = long.join(pieces_of if pieces_of is not None else piece_counts([long], key, max_entries), key)
        n_pieces = F.col("_pieces")
    return (long.withColumn("piece", F.pmod(F.xxhash64(F.col(partner)), n_pieces).cast("int"))
            .groupBy(key, "piece")
            .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.col(partner), val))))
                 .alias("stripe")))


def from_stripes(stripes: DataFrame, key: str, partner: str, value_names: list[str]) -> DataFrame:
    """Explode stripes back to long rows (for output and checks)."""
    e = stripes.select(key, F.explode_outer("stripe").alias(partner, "_v")).where(nonempty(partner))
    if len(value_names) == 1:
        return e.select(key, partner, F.col("_v").alias(value_names[0]))
    return e.select(key, partner, *[F.col("_v")[v].alias(v) for v in value_names])


def bigram_stripes(tokens: DataFrame, pieces: int | None = None) -> DataFrame:
    """Stripes of bigram counts normalised to relative frequencies.

    -> (x, piece, stripe MAP<y, STRUCT<n, freq>>). The marginal is summed over all
    pieces of ``x`` before the maps are built.
    """
    counts = bigram_counts(tokens)
    c = counts.join(_marginals(counts), "x")
    stripes = to_stripes(c, "x", "y", ["n", "n_x"], pieces, degree_col="_deg")
    return stripes.select(
        "x", "piece",
        F.transform_values("stripe", lambda k, v: F.struct(v["n"].alias("n"),
                                                           (v["n"] / v["n_x"]).alias("freq")))
        .alias("stripe"))


def merge_stripes(a: DataFrame, b: DataFrame, key: str = "x") -> DataFrame:
    """Element-wise sum of two stripe tables of counts that were cut alike (``pieces`` or ``pieces_of``).

    Full outer join on ``(key, piece)`` and ``map_zip_with`` over the union of partners.
    """
    empty = F.create_map().cast("map<string,bigint>")
    j = a.alias("a").join(b.alias("b"), [key, "piece"], "full_outer")
    return j.select(
        key, "piece",
        F.map_zip_with(F.coalesce(F.col("a.stripe"), empty), F.coalesce(F.col("b.stripe"), empty),
                       lambda k, v1, v2: F.coalesce(v1, F.lit(0)) + F.coalesce(v2, F.lit(0)))
        .alias("stripe"))


def merge_counts(a: DataFrame, b: DataFrame, key: str = "x", partner: str = "y", value: str = "n",
                 max_entries: int = MAX_STRIPE_ENTRIES) -> DataFrame:
    """The stripes of two tables of counts (one row per key and partner in each), merged -> (key, piece, stripe).

    Both sides' partners of a key are counted first and agree on its number of pieces, so a merged piece holds about
    ``max_entries`` partners also where one side has few of a key and the other millions. Both tables are read twice:
    pass stored or checkpointed ones."""
    of = piece_counts([a, b], key, max_entries)
    sa, sb = (to_stripes(d, key, partner, [value], pieces_of=of) for d in (a, b))
    return merge_stripes(sa, sb, key)


def partition_number(key, n: int):
    """Visible partition number of a key, ``md5``-based so any engine agrees."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("bigint"), F.lit(n)).cast("int")


def partition_sorted(df: DataFrame, key: str, then: list[str], n: int) -> DataFrame:
    """Rows in ``n`` partitions by the visible partition number of ``key``, sorted by
    ``key, *then`` inside each -> (part, ...). Physical partition i holds the rows of part i and no others."""
    out = df.withColumn("part", partition_number(F.col(key), n))
    return (out.repartitionById(n, F.col("part")).sortWithinPartitions(key, *then)
            .select("part", *df.columns))
