"""Instances, full-batch and sharded training, scoring, ensembles, model text."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import linear as L
from tessera.sources.sinks import write_model, write_model_text
from tessera.sources.tables import read_instances_text, read_model_text


def _inst(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, y int, features array<int>")


ROWS = [(1, 1, [1, 2, 2, 3]), (2, 0, [2, 4]), (3, 1, [1, 5, 5, 5]), (4, 0, [4, 4, 2]), (5, 1, []),
        (6, 0, [3, 6]), (7, 1, [1, 6, 7])]


def _replay(rows, delta=0.002):
    """Plain Python replay of the sequential rule (repeats counted, p before updates)."""
    w = {}
    for _, y, fs in rows:
        s = sum(w.get(f, 0.0) for f in fs)
        p = 1.0 / (1.0 + math.exp(-s))
        for f in fs:
            w[f] = w.get(f, 0.0) + (y - p) * delta
    return w


def test_one_shard_equals_sequential_replay(spark):
    inst = _inst(spark, ROWS)
    order = [(r.doc_id, r.y, list(r.features))
             for r in L.shuffle_order(inst, 7).orderBy("ord", "doc_id").collect()]
    got = {r.f: r.w for r in L.train_sharded(inst, 1, seed=7).collect()}
    want = _replay(order)
    assert set(got) == set(want)
    assert all(abs(got[f] - want[f]) < 1e-15 for f in want)


def test_shards_average(spark):
    inst = _inst(spark, ROWS)
    ordered = L.shuffle_order(inst, 3).withColumn("shard", F.conv(F.substring("ord", 1, 8), 16, 10).cast("long") % 2)
    per_shard = {}
    for r in ordered.orderBy("ord", "doc_id").collect():
        per_shard.setdefault(r.shard, []).append((r.doc_id, r.y, list(r.features)))
    ws = [_replay(v) for v in per_shard.values()]
    want = {f: sum(w.get(f, 0.0) for w in ws) / 2 for f in set().union(*ws)}
    got = {r.f: r.w for r in L.train_sharded(inst, 2, seed=3).collect()}
    assert set(got) == set(want) and all(abs(got[f] - want[f]) < 1e-15 for f in want)


def test_full_batch_against_python(spark):
    inst = _inst(spark, ROWS)
    model = {r.f: r.w for r in L.train_fullbatch(L.occurrences(inst), 3).collect()}
    w = {}
    for _ in range(3):
        g = {}
        for _, y, fs in ROWS:
            p = 1.0 / (1.0 + math.exp(-sum(w.get(f, 0.0) for f in fs)))
            for f in fs:
                g[f] = g.get(f, 0.0) + (y - p)
        w = {f: w.get(f, 0.0) + 0.002 * g.get(f, 0.0) for f in set(w) | set(g)}
    assert set(model) == set(w) and all(abs(model[f] - w[f]) < 1e-14 for f in w)


def test_score_zero_is_spam_for_one_model_ham_for_ensemble(spark):
    inst = _inst(spark, [(1, 1, [9]), (2, 0, [1])])
    model = spark.createDataFrame([(0, 1, -0.5)], "model_id int, f int, w double")
    got = {r.doc_id: (r.score, r.predicted) for r in L.score_documents(inst, model).collect()}
    assert got == {1: (0.0, "spam"), 2: (-0.5, "ham")}
    ens = {r.doc_id: r.predicted for r in L.ensemble(inst, model, "average", 1).collect()}
    assert ens == {1: "ham", 2: "ham"}
    with pytest.raises(ValueError):
        L.ensemble(inst, model, "median", 1)


def test_vote_counts_models(spark):
    inst = _inst(spark, [(1, 1, [1, 2])])
    models = spark.createDataFrame([(0, 1, 1.0), (1, 2, 0.5), (2, 1, -3.0)], "model_id int, f int, w double")
    r = L.ensemble(inst, models, "vote", 3).first()
    assert (r.score, r.predicted) == (1, "spam")
    r4 = L.ensemble(inst, models, "vote", 4).first()  # a fourth model without these features
    assert (r4.score, r4.predicted) == (0, "ham")


def test_instance_and_model_text_round_trip(spark, tmp_dir):
    with open(tmp_dir + "/inst.txt", "w") as fh:
        fh.write("d1 spam 3 4 4\nd2 ham 7\nd3 spam x 5\n")
    inst = {r.doc_id: (r.y, list(r.features)) for r in read_instances_text(spark, tmp_dir + "/inst.txt").collect()}
    assert inst == {"d1": (1, [3, 4, 4]), "d2": (0, [7]), "d3": (1, [5])}
    model = spark.createDataFrame([(1, -0.25), (20, 1e-7)], "f int, w double")
    write_model_text(model, tmp_dir + "/m")
    back = sorted(tuple(r) for r in read_model_text(spark, tmp_dir + "/m").collect())
    assert back == [(1, -0.25), (20, 1e-7)]
    write_model(model.withColumn("model_id", F.lit(2)), tmp_dir + "/mp")
    assert spark.read.parquet(tmp_dir + "/mp").where("model_id = 2").count() == 2


def test_seeded_order_is_numbered_without_a_single_task(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).cast("int").alias("y"))
    got = L.ranked(L.shuffle_order(rows, 11), ["ord", "doc_id"], partitions=7)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan or "SinglePartition" not in plan.split("rangepartitioning")[0]
    seen = sorted((r["rank"], r.doc_id, r.ord) for r in got.collect())
    assert [r[0] for r in seen] == list(range(1, 3001))
    assert [r[2] for r in seen] == sorted(r[2] for r in seen) and sorted(r[1] for r in seen) == list(range(3000))
    again = sorted((r["rank"], r.doc_id, r.ord) for r in L.ranked(L.shuffle_order(rows, 11), ["ord", "doc_id"], partitions=3).collect())
    assert again == seen
    assert [r[1] for r in sorted((r["rank"], r.doc_id) for r in L.ranked(L.shuffle_order(rows, 12), ["ord"]).collect())] != [r[1] for r in seen]


def test_ranked_with_ties_and_no_rows(spark):
    rows = spark.createDataFrame([(1, "a")] * 5 + [(0, "b")], "k int, v string")
    got = L.ranked(rows, ["k"], partitions=4).collect()
    assert sorted(r["rank"] for r in got) == [1, 2, 3, 4, 5, 6] and min(got, key=lambda r: r["rank"]).v == "b"
    assert L.ranked(rows.where("1 = 0"), ["k"]).count() == 0


def test_a_shard_is_streamed(spark):
    """Batches of two rows give the same model: a shard is not one frame."""
    rows = [(i, i % 2, [i % 5, i % 3 + 5]) for i in range(60)]
    inst = _inst(spark, rows)
    whole = {r.f: r.w for r in L.train_sharded(inst, 3).collect()}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        assert {r.f: r.w for r in L.train_sharded(inst, 3).collect()} == whole
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_instances_written_as_text_come_back(spark, tmp_dir):
    from tessera.sources.sinks import write_instances_text
    inst = _inst(spark, ROWS)
    write_instances_text(inst, tmp_dir + "/t")
    assert {"5 spam", "2 ham 2 4"} <= {r.value for r in spark.read.text(tmp_dir + "/t").collect()}
    back = read_instances_text(spark, tmp_dir + "/t").collect()
    assert sorted((int(r.doc_id), r.y, list(r.features)) for r in back) == ROWS
