"""Approximate nearest neighbours: stable projections, a kd-tree, and a chi-square stopping test.

Vectors are projected to ``M`` Gaussian (2-stable) directions. A projected distance divided by the true
one, squared, follows a chi-square law of ``M`` degrees, so a vector at true distance ``d`` lies within
``d * sqrt(t)`` of the query in the projection with probability ``p`` where ``t`` is the ``p`` quantile.
A query takes projected neighbours in growing distance, computes their true distance, and stops when the
next one is farther than ``d_k * sqrt(t)``.

The kd-tree has two levels. Its upper cells are split on a bounded sample and hold every vector; large
cells are cut into blocks by a hash. A query first searches its own cell, which gives a bound ``d_k``;
then it goes only to the cells that the stopping test leaves open. Inside a block a kd-tree of its own
orders the leaves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

M = 8
LEAF = 64


def chi_square_quantile(p: float, m: int = M) -> float:
    """Quantile for an even number of degrees (the law is a finite sum then), by bisection."""
    def below(x):
        term, total = 1.0, 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        return 1 - math.exp(-x / 2) * total
    lo, hi = 0.0, 1e3
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if below(mid) < p else (lo, mid)
    return hi


def matrix(column, dim: int) -> np.ndarray:
    col = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return col.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Cells:
    """A complete kd-tree of ``2 ** depth`` cells in the projection, from a sample of points."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.depth, m = depth, sample.shape[1]
        self.axis, self.cut = np.zeros(1 << depth, np.int64), np.zeros(1 << depth)
        self.low = np.full((1 << depth, m), -np.inf)
        self.high = np.full((1 << depth, m), np.inf)
        self._split(sample, 1, np.full(m, -np.inf), np.full(m, np.inf))

    def _split(self, pts, node, low, high):
        if node >= 1 << self.depth:
            self.low[node - (1 << self.depth)], self.high[node - (1 << self.depth)] = low, high
            return
        axis = int(np.argmax(pts.max(0) - pts.min(0))) if len(pts) else 0
        cut = float(np.median(pts[:, axis])) if len(pts) else 0.0
        self.axis[node], self.cut[node] = axis, cut
        left = pts[:, axis] <= cut
        up, down = high.copy(), low.copy()
        up[axis], down[axis] = min(high[axis], cut), max(low[axis], cut)
        self._split(pts[left], 2 * node, low, up)
        self._split(pts[~left], 2 * node + 1, down, high)

    def find(self, pts: np.ndarray) -> np.ndarray:
        node = np.ones(len(pts), np.int64)
        for _ in range(self.depth):
            node = 2 * node + (pts[np.arange(len(pts)), self.axis[node]] > self.cut[node])
        return node - (1 << self.depth)

    def distance2(self, p: np.ndarray) -> np.ndarray:
        """Squared distance from a point to each cell."""
        gap = np.maximum(np.maximum(self.low - p, p - self.high), 0)
        return (gap * gap).sum(1)


def leaves(pts: np.ndarray) -> list[np.ndarray]:
    """Rows of each leaf of a kd-tree over the points."""
    out, todo = [], [np.arange(len(pts))]
    while todo:
        rows = todo.pop()
        if len(rows) <= LEAF:
            out.append(rows)
            continue
        own = pts[rows]
        axis = int(np.argmax(own.max(0) - own.min(0)))
        order = np.argpartition(own[:, axis], len(rows) // 2)
        todo += [rows[order[:len(rows) // 2]], rows[order[len(rows) // 2:]]]
    return out


def search_block(ids, vecs, proj, q_ids, q_vecs, q_proj, bounds, k: int, t: float) -> list[tuple]:
    """(query, id, distance) of up to ``k`` nearest found in one block for each query.

    ``bounds`` are distances that the query's k-th neighbour is known not to exceed."""
    out = []
    if not len(ids):
        return out
    groups = leaves(proj)
    low = np.array([proj[g].min(0) for g in groups])
    high = np.array([proj[g].max(0) for g in groups])
    slack = 1e-9 * (1 + float(np.abs(proj).max()) ** 2)
    for qid, q, qp, bound in zip(q_ids, q_vecs, q_proj, bounds):
        gap = np.maximum(np.maximum(low - qp, qp - high), 0)
        near = (gap * gap).sum(1)
        best_d, best_i, limit = np.zeros(0), np.zeros(0, np.int64), bound
        for leaf in np.argsort(near, kind="stable"):
            if near[leaf] > t * limit * limit + slack:
                break                                   # the stopping test holds from here on
            rows = groups[leaf]
            rows = rows[ids[rows] != qid]
            diff = vecs[rows] - q
            dist = np.sqrt((diff * diff).sum(1))
            ok = dist <= limit
            best_d, best_i = np.concatenate([best_d, dist[ok]]), np.concatenate([best_i, ids[rows[ok]]])
            if len(best_d) > k:
                top = np.lexsort((best_i, best_d))[:k]
                best_d, best_i = best_d[top], best_i[top]
            if len(best_d) >= k:
                limit = min(limit, float(best_d.max()))
        out += [(qid, int(i), float(d)) for i, d in zip(best_i, best_d)]
    return out


def usable(vec: str = "embedding") -> F.Column:
    """Vectors that take part: not null, no null or non-finite component, not zero."""
    bad = F.exists(vec, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vec).isNotNull() & ~F.coalesce(bad, F.lit(False)) & F.exists(vec, lambda x: x != 0)


def nearest(rows: DataFrame, is_query: F.Column, k: int = 10, key: str = "vec_id", vec: str = "embedding",
            sample_rows: int = 20_000, cell_rows: int = 4_000, p: float = 0.995, seed: int = 7) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each query among all other rows.

    Vectors that are not ``usable`` and those whose length is not the commonest one take no part; nor
    does a row of null key. Rows that repeat a query's key are never its neighbours; a query key that is
    repeated is searched once; repeated other rows are each a candidate. The upper cells are fitted on
    at most ``sample_rows`` vectors, those of the smallest key hashes, and hold about ``cell_rows`` each.
    """
    spark = rows.sparkSession
    good = rows.where(usable(vec) & F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("id"), F.col(vec).alias("v"), is_query.alias("is_query"))
    sizes = good.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "n").limit(1).collect()
    out_schema = "query_id long, vec_id long, score double"
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = sizes[0]["n"], sizes[0]["c"]
    good = good.where(F.size("v") == dim)
    sample = np.array([r["v"] for r in good.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").collect()], float)
    stable = np.random.default_rng(seed).standard_normal((dim, M))
    depth = max(0, min(math.ceil(math.log2(max(1, total / cell_rows))), int(math.log2(max(1, len(sample) // 32)))))
    cells, t = Cells(sample @ stable, depth), chi_square_quantile(p)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell = cells.find(matrix(b.column(1), dim) @ stable)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell)], names=["id", "v", "is_query", "cell"])

    kind = good.schema["v"].dataType.simpleString()
    placed = good.mapInArrow(place, f"id long, v {kind}, is_query boolean, cell long").checkpoint()
    counts = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = {c: -(-n // (2 * cell_rows)) for c, n in counts.items()}     # one entry for each cell
    most = max(parts.values())
    widths = F.element_at(F.create_map(*[F.lit(x) for c, n in sorted(parts.items()) for x in (c, n)]), F.col("cell"))
    points = placed.select("id", "v", (F.col("cell") * most + F.pmod(F.xxhash64("id"), widths)).alias("block"))
    queries = placed.where("is_query").dropDuplicates(["id"]).select("id", "v", "cell")

    def search(pts: pa.Table, qs: pa.Table) -> pa.Table:
        found = []
        if pts.num_rows and qs.num_rows:
            v, q = matrix(pts["v"], dim), matrix(qs["v"], dim)
            found = search_block(pts["id"].to_numpy(), v, v @ stable, qs["id"].to_numpy(), q, q @ stable,
                                 qs["bound"].to_numpy(), k, t)
        a, b, d = zip(*found) if found else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(d, pa.float64())})

    def visit(qs: DataFrame) -> DataFrame:
        return points.groupBy("block").cogroup(qs.groupBy("block")).applyInArrow(search, out_schema)

    def best(found: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy("score", "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    blocks = F.transform(F.sequence(F.lit(0), widths.cast("int") - 1), lambda s: F.col("cell") * most + s)
    home = queries.select("id", "v", F.lit(float("inf")).alias("bound"), F.explode(blocks).alias("block"))
    near = best(visit(home)).checkpoint()
    bound = near.groupBy("query_id").agg(F.max("score").alias("d"), F.count(F.lit(1)).alias("n")).select(
        F.col("query_id").alias("id"), F.when(F.col("n") >= k, F.col("d")).otherwise(F.lit(float("inf"))).alias("bound"))
    bounded = queries.join(bound, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("inf"))))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The cells that the stopping test leaves open, beside the query's own."""
        for b in batches:
            proj = matrix(b.column(1), dim) @ stable if b.num_rows else []
            ids, vs, ds, cs = [], [], [], []
            for i, (qp, own, d) in enumerate(zip(proj, b.column(2).to_pylist(), b.column(3).to_pylist())):
                for c in np.flatnonzero(cells.distance2(qp) <= t * d * d):
                    if c != own and int(c) in parts:
                        ids.append(i), cs.append(int(c))
            take = pa.array(ids, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(take), b.column(1).take(take), b.column(3).take(take),
                                              pa.array(cs, pa.int64())], names=["id", "v", "bound", "cell"])

    far = (bounded.select("id", "v", "cell", "bound").mapInArrow(route, f"id long, v {kind}, bound double, cell long")
           .select("id", "v", "bound", F.explode(blocks).alias("block")))
    both = near.select("query_id", "vec_id", "score").unionByName(visit(far))
    return best(both).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def search_embeddings(embeddings: DataFrame) -> DataFrame:
    """The 10 nearest of every row whose vec_id is divisible by 100, among all other rows."""
    return nearest(embeddings, F.col("vec_id") % 100 == 0)
