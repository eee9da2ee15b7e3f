"""Graph records and personalized PageRank as joins and aggregates.

State is ``(id, out_degree, rank)`` with linear (not log) double ranks. One step: every
node with out-edges sends ``rank / out_degree`` along each edge (a join of the edge table
with the ranks, then a partially aggregated ``groupBy(dst)``); the mass of dangling nodes
is one scalar subquery and goes to the sources; ``new = (1 - alpha) * received`` plus
``alpha / |S|`` on a source. Mass sent to a node without structure vanishes (left join
from the node table) and is counted.

Through all steps the state lies bucketed on ``id`` and the edges of ordinary nodes on ``src``
alike, so that of a step's joins only the received sums are shuffled. The edges of
hubs (few by definition) lie spread over all partitions and get their shares by broadcast.
Every step is stored below the shared checkpoint folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tessera.operators.words import partition_number
from tessera.session import scratch_path
from tessera.sources.sinks import iteration_path

ALPHA = 0.15  # teleport probability


# ---------------------------------------------------------------- build (G1, SRC5 stand-in)

def graph_from_lineitem(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stand-in graph: supplier -> part for every (supplier, part) pair of a line item,
    and part -> supplier when the part key is even. Ids ``s<key>``, ``p<key>``.
    -> (nodes(id), edges(src, dst))."""
    pairs = lineitem.select("l_suppkey", "l_partkey").distinct()
    s = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    p = F.concat(F.lit("p"), F.col("l_partkey").cast("string"))
    forward = F.struct(s.alias("src"), p.alias("dst"))
    back = F.struct(p.alias("src"), s.alias("dst"))
    # Both directions from one pass over the distinct pairs (a union would aggregate twice).
    edges = pairs.select(F.inline(F.when(F.col("l_partkey") % 2 == 0, F.array(forward, back))
                                  .otherwise(F.array(forward))))
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()
    return nodes, edges


def _is_source(sources: list[str]) -> Column:
    return F.col("id").isin(list(sources))


def build_state(nodes: DataFrame, edges: DataFrame, sources: list[str]) -> DataFrame:
    """G1: (id, out_degree, rank) with ``1/|S|`` on each source and 0 elsewhere.

    A17: a node listed twice in ``nodes`` raises. Listings and out-edges are counted by one aggregation; edges of a
    node that is not listed are left out."""
    if not sources:
        raise ValueError("personalized PageRank needs at least one source")
    both = (nodes.select("id", F.lit(1).alias("listed"), F.lit(0).alias("out"))
            .unionByName(edges.select(F.col("src").alias("id"), F.lit(0).alias("listed"), F.lit(1).alias("out"))))
    return (both.groupBy("id").agg(_once(F.sum("listed")).alias("listed"), F.sum("out").alias("out_degree"))
            .where(F.col("listed") > 0)
            .select("id", "out_degree", F.when(_is_source(sources), F.lit(1.0 / len(sources))).otherwise(F.lit(0.0)).alias("rank")))


def _once(n: Column) -> Column:
    """A count of listings; more than one raises."""
    message = F.concat(F.lit("node listed twice: "), F.col("id").cast("string"))
    return F.when(n > 1, F.raise_error(message).cast("bigint")).otherwise(n)


def unique_nodes(state: DataFrame) -> DataFrame:
    """The rows of a node table; an id that stands there twice raises."""
    cols = [c for c in state.columns if c != "id"]
    return (state.groupBy("id").agg(_once(F.count(F.lit(1))).alias("_n"), *[F.first(c).alias(c) for c in cols])
            .where(F.col("_n") == 1).select(*state.columns))


def graph_stats(state: DataFrame, sources: list[str]) -> DataFrame:
    """One row (n_nodes, n_edges, n_active, n_dangling, n_sources)."""
    return state.agg(
        F.count(F.lit(1)).alias("n_nodes"),
        F.sum("out_degree").cast("bigint").alias("n_edges"),
        F.count_if(F.col("out_degree") > 0).alias("n_active"),
        F.count_if(F.col("out_degree") == 0).alias("n_dangling"),
        F.count_if(_is_source(sources)).alias("n_sources"))


def duplicate_ids(node_rows: DataFrame) -> DataFrame:
    """Ids listed more than once -> (id, n). Empty on a well-formed node table."""
    return node_rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def missing_targets(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edge targets without a node row and how many messages each would get."""
    return (edges.join(nodes, edges["dst"] == nodes["id"], "left_anti")
            .groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_messages")))


def partition_graph(state: DataFrame, n: int, by_range: bool = False) -> DataFrame:
    """The node table in ``n`` partitions, with the partition number as column ``part``: by the MD5 of the id
    (default; any engine computes the same number, and physical partition i holds part i), or by ranges of the id."""
    if by_range:
        return state.repartitionByRange(n, "id").withColumn("part", F.spark_partition_id())
    return state.withColumn("part", partition_number(F.col("id"), n)).repartitionById(n, F.col("part"))


# ---------------------------------------------------------------- steps

MAX_HUBS = 10_000  # nodes whose shares are broadcast at most
HUB_EDGES = 100_000  # a node of fewer out-edges is never a hub


@dataclass
class Edges:
    """The edges of a run: those of ordinary nodes bucketed on ``src`` like the state on ``id`` (``table`` is their name in the
    catalog), and, where there are hubs, their edges spread by ``dst`` and the hubs (``id``)."""
    plain: DataFrame
    table: str
    of_hubs: DataFrame | None = None
    hubs: DataFrame | None = None

    def release(self) -> None:
        """Forget the table; its files stay in the shared folder."""
        self.plain.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


def _bucketed(df: DataFrame, key: str, path: str) -> tuple[str, DataFrame]:
    """``df`` written at ``path`` in as many buckets on ``key`` as there are shuffle partitions, as a table of the catalog: a
    join on ``key`` reads it as it lies. The rows must be partitioned by ``key`` already, so that a task writes one file."""
    name = f"tessera_{uuid.uuid4().hex}"
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, key).option("path", path).mode("overwrite").saveAsTable(name)
    return name, df.sparkSession.table(name)


def _dealt(df: DataFrame, key: str) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def prepare_edges(edges: DataFrame, state: DataFrame, max_hubs: int = MAX_HUBS, hub_edges: int = HUB_EDGES) -> Edges:
    """Edges stored for all steps over ``state``. A hub has more than ``hub_edges`` out-edges and more than one in
    ``max_hubs`` of all, so there are fewer than ``max_hubs`` hubs however large the graph, and no bucket holds a node of more
    edges than that."""
    spark = edges.sparkSession
    edges = edges.select("src", "dst")
    least = F.greatest(F.lit(hub_edges), state.select(F.sum("out_degree") / F.lit(max_hubs)).scalar())
    hubs = state.where(F.col("out_degree") > least).select("id").checkpoint()
    if hubs.isEmpty():
        table, plain = _bucketed(_dealt(edges, "src"), "src", scratch_path(spark, "edges"))
        return Edges(plain, table)
    edges = edges.persist()
    few = F.broadcast(hubs)  # fewer than max_hubs rows
    table, plain = _bucketed(_dealt(edges.join(few, F.col("src") == F.col("id"), "left_anti"), "src"), "src", scratch_path(spark, "edges"))
    path = scratch_path(spark, "hub-edges")
    _dealt(edges.join(few, F.col("src") == F.col("id"), "left_semi"), "dst").write.parquet(path)
    edges.unpersist()
    return Edges(plain, table, spark.read.parquet(path), hubs)


def place_state(state: DataFrame, path: str | None = None) -> tuple[str, DataFrame]:
    """The node table bucketed on ``id``, as the steps keep it: the catalog's name and the table."""
    return _bucketed(_dealt(state, "id"), "id", path or scratch_path(state.sparkSession, "state"))


def ppr_step(state: DataFrame, edges: DataFrame | Edges, sources: list[str], alpha: float = ALPHA,
             sent: Observation | None = None) -> DataFrame:
    """One personalized PageRank step -> new (id, out_degree, rank); the message side is observed as ``sent``.

    ``edges`` are prepared ones, or a plain table for a single step (AQE splits its hubs, if it sees them)."""
    k = float(len(sources))
    shares = state.where(F.col("out_degree") > 0).select(F.col("id").alias("from_id"), (F.col("rank") / F.col("out_degree")).alias("share"))
    plain = edges if isinstance(edges, DataFrame) else edges.plain
    messages = plain.join(shares, F.col("src") == F.col("from_id")).select("dst", "share")
    if isinstance(edges, Edges) and edges.hubs is not None:
        few = F.broadcast(shares.join(F.broadcast(edges.hubs), F.col("from_id") == F.col("id")).drop("id"))  # a row for each hub
        messages = messages.unionByName(edges.of_hubs.join(few, F.col("src") == F.col("from_id")).select("dst", "share"))
    received = messages.groupBy("dst").agg(F.sum("share").alias("received"), F.count(F.lit(1)).alias("_messages"))
    if sent is not None:
        received = received.observe(sent, F.coalesce(F.sum("_messages"), F.lit(0)).alias("messages"))
    dangling = state.where(F.col("out_degree") == 0).select(
        F.coalesce(F.sum("rank"), F.lit(0.0))).scalar()
    src = _is_source(sources)
    inflow = F.coalesce(F.col("received"), F.lit(0.0)) + F.when(src, dangling / k).otherwise(F.lit(0.0))
    rank = F.lit(1.0 - alpha) * inflow + F.when(src, F.lit(alpha / k)).otherwise(F.lit(0.0))
    out = state.join(received, state["id"] == received["dst"], "left").select("id", "out_degree", rank.alias("rank"), "_messages")
    return out if sent is not None else out.drop("_messages")


def ppr_run(state: DataFrame, edges: DataFrame, sources: list[str], steps: int,
            alpha: float = ALPHA, save_base: str | None = None, start: int = 0,
            metrics: list | None = None, max_hubs: int = MAX_HUBS, hub_edges: int = HUB_EDGES) -> DataFrame:
    """``steps`` iterations. Every step is stored, as a table bucketed on ``id`` in the shared folder
    (``{save_base}/iter=0001`` and so on when given), so lineage stays one step long, a
    lost executor recomputes at most one step, and the next step joins the state as it lies.

    A16/D17: with ``metrics`` (a list), each step appends its counters, gathered by
    ``observe`` during the step's own write (no extra job): ``nodes``, ``mass`` (rank
    sum; below 1 when mass went to missing nodes), ``active`` (nodes with out-edges),
    ``messages`` (sent along edges), ``received`` (those that reached a node) and
    ``missing`` (those to a node without structure)."""
    spark = state.sparkSession
    name, cur = place_state(state)
    e = prepare_edges(edges, cur, max_hubs, hub_edges)
    path = None
    for i in range(start + 1, start + steps + 1):
        sent = got = None
        if metrics is not None:
            sent, got = Observation(f"ppr-sent-{i}"), Observation(f"ppr-step-{i}")
        nxt = ppr_step(cur, e, sources, alpha, sent)
        if got is not None:
            nxt = nxt.observe(got, F.count(F.lit(1)).alias("nodes"), F.sum("rank").alias("mass"),
                              F.count_if(F.col("out_degree") > 0).alias("active"),
                              F.coalesce(F.sum("_messages"), F.lit(0)).alias("received")).drop("_messages")
        path = iteration_path(save_base, i) if save_base else scratch_path(spark, "state")
        before = name
        name, cur = _bucketed(nxt, "id", path)
        spark.sql(f"DROP TABLE IF EXISTS {before}")
        if got is not None:
            m = {**got.get, **sent.get, "iteration": i}
            m["missing"] = m["messages"] - m["received"]
            metrics.append(m)
    e.release()
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.parquet(path) if path else state


def read_iteration(spark, base: str, iteration: int) -> DataFrame:
    """SRC6: the node table saved for ``iteration``; an id that stands there twice raises."""
    return unique_nodes(spark.read.parquet(iteration_path(base, iteration)))


def top_ranked(state: DataFrame, k: int = 100, digits: int = 9) -> DataFrame:
    """The ``k`` highest ranks (ties by id), with the ``%.5f`` text form. The order is that of the
    ranks themselves; ``digits`` only rounds what is shown.

    ``orderBy(..).limit(k)`` plans as a per-task bounded top-k merged once."""
    # Nine significant digits (not decimals): small ranks keep their order, and ties do not depend on
    # the order in which their shares were summed.
    key = F.format_string("%.9e", F.col("rank")).cast("double")
    top = state.select("id", "rank").orderBy(F.desc(key), "id").limit(k)
    return top.select("id", F.round("rank", digits).alias("rank"), F.format_string("%.5f", F.col("rank")).alias("rank_text"))


# ---------------------------------------------------------------- log-space sums

def log_sum_exp(df: DataFrame, keys: list[str], x: str, out: str = "lse") -> DataFrame:
    """``log(sum(exp(x)))`` per group without overflow: ``m + log(sum(exp(x - m)))``
    with ``m = max(x)``. Nulls are skipped; a group of only minus infinity
    (``log 0``) sums to minus infinity.

    The per-group maxima are one row per group; AQE broadcasts them when they are
    small, so the rows are not shuffled for the join and the sum is partial per task.
    """
    m = df.groupBy(*keys).agg(F.max(x).alias("_m"))
    return (df.join(m, keys)
            .groupBy(*keys)
            .agg(F.when(F.max("_m") == float("-inf"), F.max("_m"))
                 .otherwise(F.max("_m") + F.log(F.sum(F.exp(F.col(x) - F.col("_m"))))).alias(out)))
