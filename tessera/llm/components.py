"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_A_TASK = 50_000


def gathered(df: DataFrame, rows: int) -> DataFrame:
    """``df`` in one task for each ``ROWS_A_TASK`` of its ``rows`` rows, eight at least: a small table
    does not leave a file behind for each shuffle partition, a large one keeps all of them."""
    return df.coalesce(max(8, -(-rows // ROWS_A_TASK)))


def components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(id, comp) for every id in ``edges`` (a, b): ``comp`` is the smallest id of its component.

    Each step hangs the larger neighbours of a node on the smallest one around it (large star), then
    the smaller ones (small star); the number of rounds grows with the logarithm of the longest chain.
    Smallest neighbours are partial aggregations joined back, so a hub is never one task's group. The
    edges of each round go to the checkpoint folder; only two numbers come to the driver.
    """
    def sign(e: DataFrame) -> tuple:
        r = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).collect()[0]
        return r["n"], r["x"]

    def star(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("low"))
        return pairs.join(least, "u")

    rows = 2 * edges.count()
    now = gathered(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b")
                   .distinct(), rows).checkpoint()
    seen = sign(now)
    for _ in range(max_rounds):
        both = now.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            now.select(F.col("b").alias("u"), F.col("a").alias("v")))
        large = gathered(star(both).where("v > u").select(F.col("v").alias("a"), F.col("low").alias("b")), rows).distinct()
        # Every edge now points from a larger to a smaller id.
        down = large.select(F.col("a").alias("u"), F.col("b").alias("v"))
        small = gathered(star(down).select(F.explode(F.array(F.struct(F.col("u").alias("a"), F.col("low").alias("b")),
                                                                F.struct(F.col("v").alias("a"), F.col("low").alias("b")))).alias("e"))
                         .select("e.a", "e.b").where("a <> b"), rows).distinct()
        now = gathered(small, rows).checkpoint()
        after = sign(now)
        if after == seen:
            break
        seen = after
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    top = now.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()
    return now.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(top)


def joined_components(comp: DataFrame, found: DataFrame) -> DataFrame:
    """(id, comp) after the edges ``found`` (a, b) were added to those behind ``comp``.

    Only the components that ``found`` links are worked on, each as one node; an id that ``comp``
    lacks is a component of its own.
    """
    ends = found.select(F.col("a").alias("id")).unionByName(found.select(F.col("b").alias("id"))).distinct()
    fresh = ends.join(comp, "id", "left_anti").select("id", F.col("id").alias("comp"))
    every = comp.unionByName(fresh).checkpoint()
    linked = (found.join(every.select(F.col("id").alias("a"), F.col("comp").alias("ca")), "a")
              .join(every.select(F.col("id").alias("b"), F.col("comp").alias("cb")), "b")
              .where("ca <> cb").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct().checkpoint())
    moved = components(linked).select(F.col("id").alias("old"), F.col("comp").alias("new"))
    return (every.join(moved, F.col("comp") == F.col("old"), "left")
            .select("id", F.coalesce("new", "comp").alias("comp")))
