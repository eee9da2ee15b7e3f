"""Logistic-regression spam scoring: instances, training, scoring and ensembles.

Update rule (fixed by the studied learner): for an instance with label ``y`` and
features ``f1..fn`` (repeats counted), ``p = 1 / (1 + exp(-sum w[f]))`` and every
occurrence adds ``(y - p) * delta`` to ``w[f]``.

* Full batch (M4): one gradient over all instances per epoch, exact and order-free;
  several models train in the same job, keyed by ``model_id``.
* Sharded (M5): the sequential rule inside each of ``n_shards`` shards, weights averaged. A shard is one
  partition, sorted by the seeded order; Python streams over its rows and holds the weights only, so a shard may
  be larger than memory. Their number is a parameter, as another number is another model.

How a model is joined is left to AQE, which sees its size at run time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import feature_id, nonempty, tokenize
from tessera.sources.tables import spread

DELTA = 0.002  # learning rate of the studied learner
BUCKETS = 1000  # feature hash buckets of the test stand-in


def instances(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
              label_col: str = "quality") -> DataFrame:
    """M1/T7 stand-in: labelled documents -> (doc_id, y INT, features ARRAY<INT>)."""
    lab = labels.select("doc_id", F.col(label_col).cast("int").alias("y"))
    docs = spread(documents.select("doc_id", "text"), "doc_id").join(lab, "doc_id")
    return docs.select("doc_id", "y",
                       F.transform(tokenize(F.col("text")), lambda t: feature_id(t, buckets).cast("int"))
                       .alias("features"))


def occurrences(inst: DataFrame, model_col: str | None = None) -> DataFrame:
    """(model_id, doc_id, y, f, cnt): features counted per instance."""
    mid = F.col(model_col).cast("int") if model_col else F.lit(0)
    return (inst.select(mid.alias("model_id"), "doc_id", "y", F.explode_outer("features").alias("f"))
            .where(nonempty("f"))
            .groupBy("model_id", "doc_id", "y", "f").agg(F.count(F.lit(1)).alias("cnt")))


def train_fullbatch(occ: DataFrame, epochs: int = 2, delta: float = DELTA) -> DataFrame:
    """Full-batch training of every ``model_id`` in ``occ`` -> (model_id, f, w).

    Per epoch: score each instance with a window sum over its own rows (no join back),
    then one partially aggregated ``groupBy(model_id, f)``. The occurrences are
    checkpointed once and the model after every epoch.
    """
    spark = occ.sparkSession
    # Rows of one instance must sit together for the per-instance window; instances
    # spread by doc_id already are, and the checkpoint keeps that partitioning.
    occ = occ.checkpoint(eager=True)
    model = spark.createDataFrame([], "model_id int, f int, w double")
    per_doc = Window.partitionBy("model_id", "doc_id")
    for _ in range(epochs):
        scored = (occ.join(model, ["model_id", "f"], "left")
                  .withColumn("s", F.sum(F.col("cnt") * F.coalesce("w", F.lit(0.0))).over(per_doc)))
        grad = (scored.groupBy("model_id", "f")
                .agg((F.lit(delta) * F.sum(F.col("cnt") * (F.col("y") - 1.0 / (1.0 + F.exp(-F.col("s"))))))
                     .alias("g")))
        model = (model.join(grad, ["model_id", "f"], "full_outer")
                 .select("model_id", "f", (F.coalesce("w", F.lit(0.0)) + F.coalesce("g", F.lit(0.0))).alias("w"))
                 .checkpoint(eager=True))
    return model


def score(occ: DataFrame, model: DataFrame) -> DataFrame:
    """(model_id, doc_id, score) with ``score = sum cnt * w``; an unknown feature
    weighs 0. ``occ`` carries no model id here: every model scores every instance."""
    o = occ.select("doc_id", "f", "cnt")
    return (o.join(model, "f")
            .groupBy("model_id", "doc_id").agg(F.sum(F.col("cnt") * F.col("w")).alias("score")))


def score_documents(inst: DataFrame, model: DataFrame) -> DataFrame:
    """One model -> (doc_id, y, score, predicted); score < 0 is ham, else spam."""
    s = score(occurrences(inst), model)
    out = inst.select("doc_id", "y").join(s.select("doc_id", "score"), "doc_id", "left")
    sc = F.coalesce("score", F.lit(0.0))
    return out.select("doc_id", "y", sc.alias("score"),
                      F.when(sc < 0, F.lit("ham")).otherwise(F.lit("spam")).alias("predicted"))


def ensemble(inst: DataFrame, models: DataFrame, method: str, n_models: int) -> DataFrame:
    """Score with every model; ``average`` of the scores or ``vote``
    (models with score > 0 minus the rest); label spam when the result is > 0.
    A model that has none of a document's features scores it 0."""
    if method not in ("average", "vote"):
        raise ValueError(f"unknown ensemble method {method!r}")
    s = score(occurrences(inst), models)
    per_doc = s.groupBy("doc_id").agg(F.sum("score").alias("total"),
                                      F.count_if(F.col("score") > 0).alias("n_pos"))
    j = inst.select("doc_id", "y").join(per_doc, "doc_id", "left")
    if method == "average":
        val = F.coalesce("total", F.lit(0.0)) / F.lit(float(n_models))
    else:
        val = (F.lit(2) * F.coalesce("n_pos", F.lit(0)) - F.lit(n_models)).cast("int")
    return j.select("doc_id", "y", val.alias("score"),
                    F.when(val > 0, F.lit("spam")).otherwise(F.lit("ham")).alias("predicted"))


# ---------------------------------------------------------------- order and shards

def seeded_hash(key: Column, seed: int) -> Column:
    """MD5 text of seed and key: an order that any engine can repeat."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))


def ranked(df: DataFrame, by: list[str], name: str = "rank", partitions: int | None = None) -> DataFrame:
    """The rows numbered from 1 in the order of ``by`` -> adds ``name``.

    Range partitions are sorted each by itself; a row's number is its place in its partition plus the rows of the
    partitions before, which is one row a partition. No task sorts or counts all rows. Rows equal in ``by`` are
    numbered in whichever order they come."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = (df.repartitionByRange(n, *by).sortWithinPartitions(*by)
            .withColumn("_at", F.monotonically_increasing_id()).checkpoint())  # one sampling of the ranges for both uses
    part = F.shiftrightunsigned("_at", 33)  # the upper bits of the id number the partition
    sizes = rows.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)  # over at most ``n`` rows
    shift = sizes.select("_p", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return (rows.withColumn("_p", part).join(F.broadcast(shift), "_p")
            .select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name)))


def shuffle_order(inst: DataFrame, seed: int = 42) -> DataFrame:
    """A seeded, repeatable random order -> adds ``ord``, to sort by (``ranked`` numbers it)."""
    return inst.withColumn("ord", seeded_hash(F.col("doc_id"), seed))


def _sgd(delta: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        w: dict[int, float] = {}
        for pdf in batches:
            for y, feats in zip(pdf["y"].to_numpy(), pdf["features"]):
                s = sum(w.get(f, 0.0) for f in feats.tolist())
                step = (y - 0.5 * (1.0 + math.tanh(s / 2.0))) * delta  # no overflow at large scores
                for f in feats.tolist():
                    w[f] = w.get(f, 0.0) + step
        if w:
            yield pd.DataFrame({"f": list(w), "w": list(w.values())}).astype({"f": "int32"})
    return run


def train_sharded(inst: DataFrame, n_shards: int, delta: float = DELTA, seed: int = 42) -> DataFrame:
    """M5/A10: sequential SGD inside each of ``n_shards`` shards in the seeded order, then the average of
    the shard models (a feature missing from a shard counts 0) -> (f, w). A shard takes the ids of one residue of
    the first 32 bits of their seeded hash."""
    shard = F.pmod(F.conv(F.substring("ord", 1, 8), 16, 10).cast("bigint"), F.lit(n_shards)).cast("int")
    rows = shuffle_order(inst, seed).withColumn("shard", shard).select("shard", "ord", "doc_id", "y", "features")
    models = (rows.repartitionById(n_shards, F.col("shard")).sortWithinPartitions("ord", "doc_id")
              .select("y", "features").mapInPandas(_sgd(delta), "f int, w double"))
    return models.groupBy("f").agg((F.sum("w") / F.lit(float(n_shards))).alias("w"))
