"""Graph build, PageRank mass, missing structure, resume, top-k, adjacency text, log-sum-exp."""

import math
import os
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.sources.tables import read_adjacency_text


def _graph(spark, edges, nodes=None):
    e = spark.createDataFrame(edges, "src string, dst string")
    ids = nodes if nodes is not None else sorted({x for ed in edges for x in ed})
    n = spark.createDataFrame([(i,) for i in ids], "id string")
    return n, e


def _py_ppr(nodes, edges, sources, steps, alpha=0.15):
    out = {n: [d for s, d in edges if s == n] for n in nodes}
    r = {n: (1.0 / len(sources) if n in sources else 0.0) for n in nodes}
    for _ in range(steps):
        recv = {n: 0.0 for n in nodes}
        dangling = sum(r[n] for n in nodes if not out[n])
        for n in nodes:
            for d in out[n]:
                if d in recv:
                    recv[d] += r[n] / len(out[n])
        r = {n: (1 - alpha) * (recv[n] + (dangling / len(sources) if n in sources else 0.0))
             + (alpha / len(sources) if n in sources else 0.0) for n in nodes}
    return r


EDGES = [("1", "2"), ("2", "3"), ("3", "1"), ("1", "4"), ("4", "5"), ("2", "5")]


def test_mass_is_kept_without_missing_nodes(spark):
    nodes, edges = _graph(spark, EDGES)
    st = G.ppr_run(G.build_state(nodes, edges, ["1", "2"]), edges, ["1", "2"], 5)
    got = {r.id: r.rank for r in st.collect()}
    assert abs(sum(got.values()) - 1.0) < 1e-12
    want = _py_ppr(sorted({x for e in EDGES for x in e}), EDGES, ["1", "2"], 5)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_mass_vanishes_into_missing_nodes(spark):
    ids = ["1", "2", "3", "4"]  # "5" has no node row
    nodes, edges = _graph(spark, EDGES, ids)
    st = G.ppr_run(G.build_state(nodes, edges, ["1"]), edges, ["1"], 2)
    total = st.agg(F.sum("rank")).first()[0]
    assert total < 1.0
    miss = {r.id: r.n_messages for r in G.missing_targets(nodes, edges).collect()}
    assert miss == {"5": 2}
    got = {r.id: r.rank for r in st.collect()}
    want = _py_ppr(ids, EDGES, ["1"], 2)
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_resume_equals_straight_run(spark, tmp_dir):
    nodes, edges = _graph(spark, EDGES)
    s0 = G.build_state(nodes, edges, ["3"])
    straight = {r.id: r.rank for r in G.ppr_run(s0, edges, ["3"], 3).collect()}
    G.ppr_run(s0, edges, ["3"], 1, save_base=tmp_dir)
    resumed = G.ppr_run(G.read_iteration(spark, tmp_dir, 1), edges, ["3"], 2, save_base=tmp_dir, start=1)
    got = {r.id: r.rank for r in resumed.collect()}
    assert all(abs(got[k] - straight[k]) < 1e-15 for k in straight)
    assert sorted(d for d in os.listdir(tmp_dir) if d.startswith("iter=")) == ["iter=0001", "iter=0002", "iter=0003"]
    assert spark.read.parquet(tmp_dir).where("iter = 3").count() == 5


def test_topk_format_and_order(spark):
    st = spark.createDataFrame([("a", 0.5), ("b", 0.25), ("c", 0.25), ("d", 0.125)], "id string, rank double")
    got = [tuple(r) for r in G.top_ranked(st, 3).collect()]
    assert got == [("a", 0.5, "0.50000"), ("b", 0.25, "0.25000"), ("c", 0.25, "0.25000")]


def test_build_stats_and_duplicates(spark):
    nodes, edges = _graph(spark, EDGES)
    st = G.build_state(nodes, edges, ["1", "2"])
    s = G.graph_stats(st, ["1", "2"]).first()
    assert (s.n_nodes, s.n_edges, s.n_active, s.n_dangling, s.n_sources) == (5, 6, 4, 1, 2)
    twice = nodes.union(nodes.where("id = '3'"))
    assert [(r.id, r.n) for r in G.duplicate_ids(twice).collect()] == [("3", 2)]
    with pytest.raises(Exception, match="node listed twice: 3"):
        G.build_state(twice, edges, ["1"]).collect()


def test_a_saved_table_with_a_node_twice_raises(spark, tmp_dir):
    from tessera.sources.sinks import write_iteration
    nodes, edges = _graph(spark, EDGES)
    st = G.build_state(nodes, edges, ["1"])
    write_iteration(st.union(st.where("id = '4'")), tmp_dir, 7)
    with pytest.raises(Exception, match="node listed twice: 4"):
        G.read_iteration(spark, tmp_dir, 7).collect()


def test_adjacency_text_keeps_isolated_nodes(spark, tmp_dir):
    with open(tmp_dir + "/adj.txt", "w") as fh:
        fh.write("1 2 3\n2\t3\n3\n  4 1  \n")
    nodes, edges = read_adjacency_text(spark, tmp_dir + "/adj.txt")
    assert sorted(r.id for r in nodes.collect()) == ["1", "2", "3", "4"]
    assert sorted(tuple(r) for r in edges.collect()) == [("1", "2"), ("1", "3"), ("2", "3"), ("4", "1")]


def test_partition_graph_range_is_contiguous(spark):
    nodes, edges = _graph(spark, EDGES)
    st = G.partition_graph(G.build_state(nodes, edges, ["1"]), 2, by_range=True)
    parts = {}
    for r in st.collect():
        parts.setdefault(r.part, []).append(r.id)
    ranges = sorted((min(v), max(v)) for v in parts.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_log_sum_exp_no_overflow(spark):
    vals = [1000.0, 1001.0, 999.5, -math.inf]
    df = spark.createDataFrame([("k", v if v != -math.inf else None) for v in vals], "k string, x double")
    got = G.log_sum_exp(df, ["k"], "x").first().lse
    finite = np.array([v for v in vals if v != -math.inf])
    want = finite.max() + math.log(np.exp(finite - finite.max()).sum())
    assert abs(got - want) < 1e-9


def test_step_counters_by_observe(spark):
    ids = ["1", "2", "3", "4"]  # "5" is missing: mass leaks from step 2 on
    nodes, edges = _graph(spark, EDGES, ids)
    metrics = []
    G.ppr_run(G.build_state(nodes, edges, ["1"]), edges, ["1"], 3, metrics=metrics)
    assert [m["iteration"] for m in metrics] == [1, 2, 3]
    assert all(m["nodes"] == 4 for m in metrics)
    want = [sum(_py_ppr(ids, EDGES, ["1"], k).values()) for k in (1, 2, 3)]
    assert all(abs(m["mass"] - w) < 1e-12 for m, w in zip(metrics, want))
    assert abs(metrics[0]["mass"] - 1.0) < 1e-12 and metrics[2]["mass"] < 1.0
    # By hand: 1->2, 1->4, 2->3, 2->5, 3->1, 4->5; the two to "5" reach no node.
    assert all((m["messages"], m["received"], m["missing"]) == (6, 4, 2) for m in metrics)


def _hub_graph(n=600):
    """Node ``h`` sends to every other node: a third of all edges; the others to the next two."""
    ids = [f"v{i}" for i in range(n)]
    edges = [("h", v) for v in ids] + [(ids[i], ids[(i + 1) % n]) for i in range(n)] + [(ids[i], "h") for i in range(n)]
    return ids + ["h"], edges


def test_hub_of_a_third_of_all_edges(spark):
    ids, edges = _hub_graph()
    n, e = _graph(spark, edges, ids)
    state = G.build_state(n, e, ["v1"])
    want = _py_ppr(ids, edges, ["v1"], 3)
    for hub_edges in (50, 10**6):  # with the hub split off, and without
        metrics = []
        got = {r.id: r.rank for r in G.ppr_run(state, e, ["v1"], 3, hub_edges=hub_edges, metrics=metrics).collect()}
        assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-12 for k in want)
        assert all((m["messages"], m["missing"]) == (1800, 0) for m in metrics)
    made = G.prepare_edges(e, state, hub_edges=50)
    assert [r.id for r in made.hubs.collect()] == ["h"]
    assert made.of_hubs.count() == 600 and made.plain.count() == 1200
    sizes = [r.n for r in made.of_hubs.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert max(sizes) < 600 / 3  # not in one partition
    made.release()
    none = G.prepare_edges(e, state)
    assert none.hubs is None and none.plain.count() == 1800
    none.release()


def test_the_state_is_not_shuffled_in_a_step(spark):
    ids, edges = _hub_graph(80)
    n, e = _graph(spark, edges, ids)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        name, state = G.place_state(G.build_state(n, e, ["v1"]))
        made = G.prepare_edges(e, state, hub_edges=50)
        for _ in range(2):
            nxt = G.ppr_step(state, made, ["v1"])
            plan = nxt._jdf.queryExecution().executedPlan().toString()
            assert re.findall(r"Exchange hashpartitioning\((\w+)#", plan) == ["dst"], plan  # only the received sums
            last, state = G.place_state(nxt)
            spark.sql(f"DROP TABLE {name}")
            name = last
        spark.sql(f"DROP TABLE {name}")
        made.release()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_a_run_leaves_no_tables_and_one_file_a_bucket(spark, tmp_dir):
    nodes, edges = _graph(spark, EDGES)
    G.ppr_run(G.build_state(nodes, edges, ["1"]), edges, ["1"], 2, save_base=tmp_dir)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tessera_")]
    files = [f for f in os.listdir(tmp_dir + "/iter=0002") if f.startswith("part-")]
    assert 0 < len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_partition_graph_by_hash_is_physical(spark):
    nodes, edges = _graph(spark, EDGES)
    got = G.partition_graph(G.build_state(nodes, edges, ["1"]), 4).withColumn("at", F.spark_partition_id()).collect()
    assert len(got) == 5 and all(r.part == r["at"] for r in got)


def test_adjacency_text_round_trip(spark, tmp_dir):
    from tessera.sources.sinks import write_adjacency_text
    nodes, edges = _graph(spark, EDGES)
    write_adjacency_text(nodes, edges, tmp_dir + "/adj")
    assert "5" in {r.value for r in spark.read.text(tmp_dir + "/adj").collect()}
    n, e = read_adjacency_text(spark, tmp_dir + "/adj")
    assert sorted(r.id for r in n.collect()) == ["1", "2", "3", "4", "5"] and sorted(map(tuple, e.collect())) == sorted(EDGES)


def test_top_ranked_keeps_the_order_of_small_ranks(spark):
    from tessera.operators.graph import top_ranked
    df = spark.createDataFrame([("a", 1e-11), ("b", 2e-10), ("c", 4e-10)], "id string, rank double")
    assert [r["id"] for r in top_ranked(df, 2).collect()] == ["c", "b"]


def test_log_sum_exp_of_minus_infinity(spark):
    from tessera.operators.graph import log_sum_exp
    inf = float("-inf")
    df = spark.createDataFrame([("a", inf), ("a", inf), ("b", inf), ("b", 0.0)], "k string, x double")
    assert {r["k"]: r["lse"] for r in log_sum_exp(df, ["k"], "x").collect()} == {"a": inf, "b": 0.0}
