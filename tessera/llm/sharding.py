"""Sharding: rendezvous hashing of stable record keys over weighted shards.

Each record scores every shard from its key alone and goes to the highest score, so one more shard
takes records only into itself, and the shards left behind by a removed one share its records. A
shard of weight ``w`` scores ``-w / ln(u)`` with ``u`` uniform in (0, 1) from an MD5 of key and
shard; with equal weights that is the order of ``u`` itself, and the logarithm is left out.

Built-in functions only. A null key is a key of its own (one fixed string).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import free_name

HEX = 13  # hex digits of the hash that become a number: 52 bits, exact in a double


def _key(key: Column) -> Column:
    return F.coalesce(key.cast("string"), F.lit("\x00null"))


def _draw(key: Column, salt: str) -> Column:
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(salt))), 1, HEX), 16, 10).cast("long")


def rendezvous(key: Column, weights: list[float]) -> Column:
    """Shard number (0-based) of a record key over shards of the given positive weights.

    Example: ``df.withColumn("shard", rendezvous(F.col("doc_id"), [1.0] * 16))``.
    """
    if not weights or min(weights) <= 0:
        raise ValueError("weights must be positive")
    text = _key(key)
    even = len(set(weights)) == 1
    scores = []
    for s, w in enumerate(weights):
        draw = _draw(text, f":{s}")
        score = draw if even else F.lit(float(w)) / -F.log((draw + F.lit(0.5)) / F.lit(2.0 ** (4 * HEX)))
        scores.append(F.struct(score.alias("u"), F.lit(-s).alias("s")))
    # Of equal scores the smaller shard wins, whatever the number of shards.
    return -F.array_max(F.array(*scores)).getField("s")


def slots(df: DataFrame, shard: str, order: list[str], chunk_key: str, chunks: int = 1024) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, as column ``slot``.

    Equal rows are first counted (partial aggregation before the shuffle), then each shard is cut
    into ``chunks`` parts by a hash of ``chunk_key``; rows are numbered inside a part, parts are
    offset by a running sum over their sizes. No task sees a whole shard. Returns one row for each
    input row, with the columns ``shard``, ``order`` and ``slot``.
    """
    keys = list(dict.fromkeys([shard, *order]))
    part, n, base, before = (free_name(df.columns, c) for c in ("_part", "_n", "_base", "_before"))
    same = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
            .withColumn(part, (_draw(_key(F.col(chunk_key)), ":slot") % chunks).cast("int")))
    sizes = same.groupBy(shard, part).agg(F.sum(n).alias(base))
    running = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(shard, part, F.coalesce(F.sum(base).over(running), F.lit(0)).alias(base))
    within = Window.partitionBy(shard, part).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    first = within.rowsBetween(Window.unboundedPreceding, -1)
    numbered = same.withColumn(before, F.coalesce(F.sum(n).over(first), F.lit(0)))
    joined = numbered.join(bases, [shard, part])
    start = F.col(base) + F.col(before)
    return joined.select(*keys, F.explode(F.sequence(start, start + F.col(n) - 1)).alias("slot"))


def shard_documents(docs: DataFrame, n_shards: int = 16) -> DataFrame:
    """Digest rows of ``docs`` in shards 0 .. n_shards - 1 by ``doc_id`` (law ``key``).

    Columns: doc_id, size (UTF-8 bytes of the text plus 1; null text 1), text_crc32 (null text 0),
    law, shard, slot (gapless in the shard, from 0), grown_shard (with one more shard). Repeated
    rows keep one slot each; rows of a null doc_id share one shard; an empty table gives no rows;
    other columns of ``docs`` are ignored. ``shard`` may be named in ``docs``: it is not read.
    """
    digest = docs.select(
        F.col("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        rendezvous(F.col("doc_id"), [1.0] * n_shards).alias("shard"),
        rendezvous(F.col("doc_id"), [1.0] * (n_shards + 1)).alias("grown_shard"))
    out = slots(digest, "shard", ["doc_id", "text_crc32", "size", "grown_shard"], "doc_id")
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
                      "slot", "grown_shard")
