from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import graph as G
from tessera.plans.registry import register
from tessera.session import scratch_path
from tessera.sources.sinks import write_adjacency_text
from tessera.sources.tables import read_adjacency_text, read_table

SOURCES = ["s1", "s2"]  # fixed personalization sources
DIGITS = 9

GRAPH_CTE = """li AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
edges AS (SELECT 's' || l_suppkey AS src, 'p' || l_partkey AS dst FROM li
          UNION SELECT 'p' || l_partkey AS src, 's' || l_suppkey AS dst FROM li WHERE l_partkey % 2 = 0),
nodes AS (SELECT src AS id FROM edges UNION SELECT dst AS id FROM edges),
deg AS (SELECT src, count(*) AS d FROM edges GROUP BY src),
r0 AS (SELECT n.id, CAST(coalesce(deg.d, 0) AS BIGINT) AS out_degree,
              CASE WHEN n.id IN ('s1', 's2') THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS rank
       FROM nodes n LEFT JOIN deg ON deg.src = n.id)"""


def _step_sql(prev: str, cur: str) -> str:
    return f""",
{cur} AS (SELECT r.id, r.out_degree,
    CAST(0.85 AS DOUBLE) * (coalesce(m.recv, 0.0) + CASE WHEN r.id IN ('s1', 's2')
        THEN (SELECT coalesce(sum(rank), 0.0) FROM {prev} WHERE out_degree = 0) / 2.0 ELSE 0.0 END)
    + CASE WHEN r.id IN ('s1', 's2') THEN CAST(0.15 AS DOUBLE) / 2.0 ELSE 0.0 END AS rank
  FROM {prev} r LEFT JOIN (SELECT e.dst, sum(p.rank / p.out_degree) AS recv FROM edges e
                           JOIN {prev} p ON p.id = e.src GROUP BY e.dst) m ON m.dst = r.id)"""


def _ppr_sql(steps: int) -> str:
    body = "WITH " + GRAPH_CTE + "".join(_step_sql(f"r{i}", f"r{i + 1}") for i in range(steps))
    return body


def _graph(spark, sf):
    return G.graph_from_lineitem(read_table(spark, sf, "lineitem"))


def _state(spark, sf):
    nodes, edges = _graph(spark, sf)
    return G.build_state(nodes, edges, SOURCES), edges


def _out(state):
    return state.select("id", "out_degree", F.round("rank", DIGITS).alias("rank"))


@register("graph_build", "WITH " + GRAPH_CTE + " SELECT id, out_degree, rank FROM r0")
def graph_build(spark, sf):
    return _state(spark, sf)[0]


@register("graph_stats", "WITH " + GRAPH_CTE + """
SELECT count(*) AS n_nodes, CAST(sum(out_degree) AS BIGINT) AS n_edges, count(*) FILTER (WHERE out_degree > 0) AS n_active,
       count(*) FILTER (WHERE out_degree = 0) AS n_dangling, count(*) FILTER (WHERE id IN ('s1', 's2')) AS n_sources
FROM r0""")
def graph_stats(spark, sf):
    return G.graph_stats(_state(spark, sf)[0], SOURCES)


@register("graph_duplicates", "WITH " + GRAPH_CTE + """,
listed AS (SELECT 's' || s_suppkey AS id FROM supplier UNION ALL SELECT 'p' || p_partkey FROM part
           UNION ALL SELECT id FROM nodes)
SELECT id, count(*) AS n FROM listed GROUP BY id HAVING count(*) > 1""")
def graph_duplicates(spark, sf):
    # Two node listings merged: one from the supplier and part tables, one from the edges.
    nodes, _ = _graph(spark, sf)
    listed = (read_table(spark, sf, "supplier").select(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("id"))
              .unionByName(read_table(spark, sf, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id")))
              .unionByName(nodes))
    return G.duplicate_ids(listed)


MISSING_CTE = """big AS (SELECT 'p' || p_partkey AS id FROM part WHERE p_size > 40),
mnodes AS (SELECT id FROM nodes WHERE id NOT IN (SELECT id FROM big)),
medges AS (SELECT * FROM edges WHERE src NOT IN (SELECT id FROM big))"""


def _missing_graph(spark, sf):
    nodes, edges = _graph(spark, sf)
    big = (read_table(spark, sf, "part").where(F.col("p_size") > 40)
           .select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id")))
    nodes = nodes.join(big, "id", "left_anti")
    edges = edges.join(big, edges["src"] == big["id"], "left_anti")
    return nodes, edges


@register("graph_missing", "WITH " + GRAPH_CTE + ", " + MISSING_CTE + """
SELECT dst AS id, count(*) AS n_messages FROM medges WHERE dst NOT IN (SELECT id FROM mnodes) GROUP BY dst""")
def graph_missing(spark, sf):
    nodes, edges = _missing_graph(spark, sf)
    return G.missing_targets(nodes, edges)


@register("graph_partition", "WITH " + GRAPH_CTE + """
SELECT id, out_degree, rank, CAST(CAST(('0x' || substr(md5(id), 1, 8)) AS BIGINT) % 8 AS INTEGER) AS part FROM r0""")
def graph_partition(spark, sf):
    return G.partition_graph(_state(spark, sf)[0], 8)


@register("graph_from_text", "WITH " + GRAPH_CTE + " SELECT id, out_degree, rank FROM r0")
def graph_from_text(spark, sf):
    # The test tables have no adjacency text: the graph is written as lines, then read back.
    path = scratch_path(spark, "adjacency")
    write_adjacency_text(*_graph(spark, sf), path)
    return G.build_state(*read_adjacency_text(spark, path), SOURCES)


@register("ppr_step", _ppr_sql(1) + f" SELECT id, out_degree, round(rank, {DIGITS}) AS rank FROM r1")
def ppr_step(spark, sf):
    state, edges = _state(spark, sf)
    return _out(G.ppr_step(state, edges, SOURCES))


@register("ppr_run", _ppr_sql(3) + f" SELECT id, out_degree, round(rank, {DIGITS}) AS rank FROM r3")
def ppr_run(spark, sf):
    state, edges = _state(spark, sf)
    return _out(G.ppr_run(state, edges, SOURCES, 3))


@register("ppr_resume", _ppr_sql(3) + f" SELECT id, out_degree, round(rank, {DIGITS}) AS rank FROM r3")
def ppr_resume(spark, sf):
    # One step saved as iter=1, then resumed from the saved table for two more.
    state, edges = _state(spark, sf)
    base = scratch_path(spark, "ppr")
    G.ppr_run(state, edges, SOURCES, 1, save_base=base)
    saved = G.read_iteration(spark, base, 1)
    return _out(G.ppr_run(saved, edges, SOURCES, 2, save_base=base, start=1))


MISSING_SQL = ("WITH " + GRAPH_CTE.split(",\ndeg AS")[0] + ", " + MISSING_CTE + """,
deg AS (SELECT src, count(*) AS d FROM medges GROUP BY src),
r0 AS (SELECT n.id, CAST(coalesce(deg.d, 0) AS BIGINT) AS out_degree,
              CASE WHEN n.id IN ('s1', 's2') THEN CAST(0.5 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS rank
       FROM mnodes n LEFT JOIN deg ON deg.src = n.id)""" + _step_sql("r0", "r1").replace("FROM edges e", "FROM medges e")
               + f" SELECT id, out_degree, round(rank, {DIGITS}) AS rank FROM r1")


@register("ppr_missing", MISSING_SQL)
def ppr_missing(spark, sf):
    nodes, edges = _missing_graph(spark, sf)
    return _out(G.ppr_step(G.build_state(nodes, edges, SOURCES), edges, SOURCES))


@register("ppr_topk", _ppr_sql(3) + f"""
SELECT id, round(rank, {DIGITS}) AS rank, printf('%.5f', rank) AS rank_text FROM r3
ORDER BY CAST(printf('%.9e', rank) AS DOUBLE) DESC, id LIMIT 100""")
def ppr_topk(spark, sf):
    state, edges = _state(spark, sf)
    return G.top_ranked(G.ppr_run(state, edges, SOURCES, 3), 100, DIGITS)


@register("log_sum_exp", """
SELECT l_suppkey, round(ln(sum(l_extendedprice)), 6) AS lse FROM lineitem GROUP BY l_suppkey""")
def log_sum_exp(spark, sf):
    li = read_table(spark, sf, "lineitem").select("l_suppkey", F.log("l_extendedprice").alias("x"))
    return G.log_sum_exp(li, ["l_suppkey"], "x").withColumn("lse", F.round("lse", 6))
