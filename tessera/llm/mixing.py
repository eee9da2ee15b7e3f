"""Mixing sources to target weights by entropy balancing.

Documents get rates ``r`` that are closest in entropy to one copy each while the words of every
source meet a target: minimise ``sum r ln r - r`` under ``sum size * r = target`` and
``0 <= r <= cap``. The convex dual has one multiplier per source, and its solution tilts documents
exponentially, ``r = min(cap, exp(lambda * size / mean))``. Newton steps on the dual run as Spark
aggregations over the (source, size) histogram, which has the same sums as the documents; a bracket
keeps each step safe. Rates are then rounded into whole copies by running sums in order of size,
which leaves each source within about one document of its target, and a copy more or less of one size
brings it nearer still.

Sums run over integers (rates as multiples of 2^-20), so that they do not depend on the order in
which tasks finish: reruns agree. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .blocks import privately

UNIT = 1 << 20
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Sources in code-point order, null last, take the weights in turn and share ``share`` of all
    words; no target passes ``cap`` times its source, and what is cut off is shared anew by weight.
    That is one water level ``z`` with ``target = min(cap * size, weight * z)``; the level follows
    from running sums over the sources in order of ``cap * size / weight``. The windows are over
    one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights)) + 1)
    ranked = (sizes.withColumn("w", weight.cast("double"))
              .withColumn("full", F.col("source_size") * F.lit(float(cap)))
              .withColumn("level", F.col("full") / F.col("w")))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    below = order.rowsBetween(Window.unboundedPreceding, -1)
    above = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    levels = (ranked
              .withColumn("z", (total - F.coalesce(F.sum("full").over(below), F.lit(0.0)))
                          / F.sum("w").over(above)))
    # The level of the first source that stays below its limit; none: every source is full.
    fits = F.min(F.when(F.col("z") <= F.col("level"), F.struct("level", "z"))).over(Window.partitionBy())
    z = fits.getField("z")
    return levels.select("source", "source_size",
                         F.when(z.isNull(), F.col("full")).otherwise(F.least("full", F.col("w") * z))
                         .alias("target"))


def _rate(lam: Column, x: Column, cap: float) -> Column:
    """Copies of a document as a multiple of 1 / UNIT; the exponent is cut where the cap holds."""
    import math
    return F.round(F.least(F.lit(float(cap)), F.exp(F.least(lam * x, F.lit(math.log(cap) + 1)))) * UNIT).cast("long")


def solve_rates(hist: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-4,
                max_iter: int = 60, checkpoint_every: int = 8) -> DataFrame:
    """(l_source, lam, mean, target) that meets each target to ``tolerance``, by bracketed Newton steps.

    ``hist`` (source, size, n) counts documents with words, ``targets`` (source, source_size,
    target). One step is one aggregation by source; only the number of sources still off comes to
    the driver. A target at the cap (or 0) needs no step: every rate is ``cap`` (or 0).
    """
    mean = (hist.groupBy(F.col("source").alias("m_source"))
            .agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean")))
    lam = (targets.join(mean, F.equal_null("source", "m_source"))
           .select("source", "target", "mean",
                   F.when(F.col("target") >= F.col("source_size") * (cap - 1e-9), F.lit(1e9))
                   .when(F.col("target") <= 0, F.lit(-1e9)).otherwise(F.lit(0.0)).alias("lam"),
                   F.lit(-1e9).alias("lo"), F.lit(1e9).alias("hi"))
           .withColumn("done", F.abs("lam") >= 1e9))
    lam = lam.checkpoint()
    big = "decimal(38,0)"
    for step in range(1, max_iter + 1):
        joined = hist.join(lam.where(~F.col("done")).withColumnRenamed("source", "l_source"), F.equal_null("source", "l_source"))
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("lam"), x, cap)
        words = F.col("size").cast(big) * F.col("n").cast(big)
        slope = F.when(rate < F.lit(int(cap * UNIT)), F.floor(rate * x).cast(big)).otherwise(F.lit(0).cast(big))
        sums = (joined.groupBy("l_source").agg(
            F.sum((words * rate.cast(big)).cast(big)).alias("got"),
            F.sum((words * slope).cast(big)).alias("grow")))
        g = F.col("got").cast("double") / UNIT - F.col("target")
        h = F.col("grow").cast("double") / UNIT
        lo = F.when(g < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(g > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.when(h > 0, F.col("lam") - F.try_divide(g, h))
        open_end = F.when(F.col("hi2") >= 1e9, F.col("lam") + F.greatest(F.lit(1.0), F.abs("lam"))).when(
            F.col("lo2") <= -1e9, F.col("lam") - F.greatest(F.lit(1.0), F.abs("lam"))).otherwise(
            (F.col("lo2") + F.col("hi2")) / 2)
        inside = (F.col("newton") > F.col("lo2")) & (F.col("newton") < F.col("hi2")) & (
            F.abs(F.col("newton") - F.col("lam")) <= F.greatest(F.lit(2.0), F.abs("lam")))
        hit = F.abs(g) <= F.col("target") * F.lit(tolerance)
        lam = (lam.join(sums, F.equal_null("source", "l_source"), "left")
               .withColumn("hit", F.coalesce(F.col("done") | hit, F.col("done")))
               .withColumn("lo2", F.when(F.col("hit"), F.col("lo")).otherwise(lo))
               .withColumn("hi2", F.when(F.col("hit"), F.col("hi")).otherwise(hi))
               .withColumn("newton", newton)
               .withColumn("lam", F.when(F.col("hit"), F.col("lam"))
                           .when(inside, F.col("newton")).otherwise(open_end))
               .select("source", "target", "mean", "lam", F.col("lo2").alias("lo"),
                       F.col("hi2").alias("hi"), F.col("hit").alias("done")))
        lam = lam.checkpoint()
        if lam.where(~F.col("done")).isEmpty():
            break
    return lam.select(F.col("source").alias("l_source"), "lam", "mean", "target")


def _nearer(rated: DataFrame, cap: int) -> DataFrame:
    """One copy more or less of one size in each source, where that brings its words nearer to the
    target: of the sizes that allow it, the one nearest to what is missing (ties: the smaller)."""
    off = rated.groupBy(F.col("source").alias("o_source")).agg(
        (F.first("target") - F.sum(F.col("size") * (F.col("whole") * F.col("n") + F.col("more")))).alias("off"))
    seen = rated.join(off, F.equal_null("source", "o_source"))
    can = F.when(F.col("off") > 0, (F.col("more") < F.col("n")) & (F.col("whole") < cap)).otherwise(F.col("more") > 0)
    left = F.abs(F.abs("off") - F.col("size"))
    pick = seen.where(can & (left < F.abs("off"))).groupBy(F.col("source").alias("p_source")).agg(
        F.min(F.struct(left.alias("l"), F.col("size").alias("s"), F.signum("off").cast("long").alias("d"))).alias("p"))
    return (rated.join(pick, F.equal_null("source", "p_source"), "left")
            .withColumn("more", F.col("more") + F.when(F.col("size") == F.col("p.s"), F.col("p.d")).otherwise(F.lit(0)))
            .drop("p_source", "p"))


def mix_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
               weights: list[int] = (5, 2, 1), share: float = 1.5, cap: int = 2,
               chunks: int = 256) -> DataFrame:
    """Copies of each document in the mix: key, source, size, source_size, target, n, first, whole, more, r_n.

    One row per group of equal (key, source, size); ``n`` rows of the input stand behind it, and ``copies_at(i)`` is
    how often the mix takes the i-th of them. Documents without words get no copy. A null key or
    source is a value like any other. Extra columns of ``docs`` are not read.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(source).cast("string").alias("source"),
                       word_count(F.col(text)).alias("size"))
    same = slim.groupBy("key", "source", "size").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    hist_all = same.groupBy("source", "size").agg(F.sum("n").alias("n"))
    sizes = hist_all.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    targets = source_targets(sizes, list(weights), share, cap).checkpoint()
    hist = hist_all.where("size > 0").checkpoint()
    lam = solve_rates(hist, targets, cap)
    # Expected copies beyond the whole ones, summed in order of size within a source: a document
    # gets one more where the running sum passes a whole number.
    rated = (hist.join(lam, F.equal_null("source", "l_source")).drop("l_source")
             .withColumn("rate", _rate(F.col("lam"), F.col("size") / F.col("mean"), float(cap)))
             .withColumn("whole", F.expr(f"rate div {UNIT}"))
             .withColumn("frac", F.col("rate") % UNIT))
    by_size = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    half = UNIT // 2
    rated = (rated.withColumn("before", F.coalesce(F.sum(F.col("frac") * F.col("n")).over(by_size), F.lit(0)))
             .select("source", "size", "n", "whole", "target",
                     F.expr(f"(before + frac * n + {half}) div {UNIT} - (before + {half}) div {UNIT}").alias("more")))
    for _ in range(3):
        rated = _nearer(rated, cap)
    rated = rated.select(F.col("source").alias("r_source"), F.col("size").alias("r_size"), F.col("n").alias("r_n"), "whole", "more").checkpoint()
    # Place of each document among those of its source and size: parts by a hash of the key, then
    # a running count inside the part.
    part = F.pmod(F.xxhash64("key"), F.lit(chunks)).cast("int")
    spread = same.withColumn("part", part)
    counts = spread.groupBy("source", "size", "part").agg(F.sum("n").alias("c"))
    run = Window.partitionBy("source", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(F.col("source").alias("b_source"), F.col("size").alias("b_size"),
                          F.col("part").alias("b_part"),
                          F.coalesce(F.sum("c").over(run), F.lit(0)).alias("base"))
    inside = (Window.partitionBy("source", "size", "part").orderBy(F.col("key").asc_nulls_first())
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (spread.withColumn("ahead", F.coalesce(F.sum("n").over(inside), F.lit(0)))
              .join(bases, F.equal_null("source", F.col("b_source")) & (F.col("size") == F.col("b_size"))
                    & (F.col("part") == F.col("b_part")))
              .join(rated, F.equal_null("source", F.col("r_source")) & (F.col("size") == F.col("r_size")), "left")
              .join(targets.withColumnRenamed("source", "t_source"),
                    F.equal_null("source", F.col("t_source"))))
    return placed.select("key", "source", "size", "source_size", "target", "n",
                         (F.col("base") + F.col("ahead")).alias("first"), "whole", "more", "r_n")


def copies_at(i: str) -> Column:
    """How often the mix takes the ``i``-th row (from 0) of a group of ``mix_copies``."""
    return F.expr(f"coalesce(whole + ((first + {i} + 1) * more) div r_n - ((first + {i}) * more) div r_n, 0L)")


RUN = 4096  # rows of one group that one row stands for while groups are dealt out


def mix_report(docs: DataFrame, **kw) -> DataFrame:
    """doc_id, size, source_size, target, taken, copies: one row per document of ``docs``.

    Groups of equal rows are cut into runs, which are dealt out before they become rows, so that a group of any
    size is the work of many tasks."""
    runs = (mix_copies(docs, **kw).withColumn("__from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(RUN).cast("long"))))
            .repartition("key", "__from"))
    rows = runs.withColumn("__i", F.explode(F.sequence("__from", F.least(F.col("__from") + RUN, F.col("n")) - 1))).withColumn("copies", copies_at("__i"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("copies").cast("int").alias("copies"))


def mix_documents(docs: DataFrame, **kw) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as it is taken (all columns kept, extra ones of any name).

    Rows with equal key, source and size differ in no input of the decision. Such rows are numbered, and the number
    decides: their place in their partition plus the rows of the group in the partitions before.
    """
    used = [kw.get("key", "doc_id"), kw.get("text", "text"), kw.get("source", "source")]
    return privately(docs, used, lambda d: _mixed(d, *used, **kw))


def _mixed(docs: DataFrame, key: str, text: str, source: str, **kw) -> DataFrame:
    decided = mix_copies(docs, **kw).select(
        F.col("key").alias("__k"), F.col("source").alias("__s"), F.col("size").alias("__z"), "n", "first", "whole", "more", "r_n")
    sized = docs.withColumn("__size", word_count(F.col(text)))
    joined = sized.join(decided, F.equal_null(sized[key], F.col("__k"))
                        & F.equal_null(sized[source].cast("string"), F.col("__s"))
                        & (F.col("__size") == F.col("__z")))
    one = joined.where("n = 1").withColumn("__take", copies_at("0L"))
    group = ["__k", "__s", "__z"]
    # Checkpointed, so that the numbers stay if a task runs again.
    many = joined.where("n > 1").checkpoint().withColumn("__at", F.monotonically_increasing_id())
    many = many.withColumn("__p", F.shiftrightunsigned("__at", 33))
    before = Window.partitionBy(*group).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    counts = (many.groupBy(*group, "__p").agg(F.count(F.lit(1)).alias("__c"))
              .select(*[F.col(c).alias(c + "b") for c in [*group, "__p"]], F.coalesce(F.sum("__c").over(before), F.lit(0)).alias("__ahead")))
    inside = Window.partitionBy(*group, "__p").orderBy("__at")  # rows of one partition at most
    same = [F.equal_null(c, c + "b") for c in group] + [F.col("__p") == F.col("__pb")]
    many = (many.withColumn("__r", F.row_number().over(inside) - 1).join(counts, same)
            .withColumn("__take", copies_at("(__ahead + __r)")))
    both = one.select(*docs.columns, "__take").unionByName(many.select(*docs.columns, "__take")).where("__take > 0")
    return both.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("__take").cast("int"))))
