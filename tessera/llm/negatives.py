"""Hard-negative mining over Hilbert-ordered candidate blocks with zone maps.

A vector's components become the whole numbers ``floor(256 x)``; a score is an integer inner product. Candidates are
sorted along a Hilbert curve through the dimensions of largest variance and written as Parquet in blocks of ``block_rows``
rows; each block has a zone map: the least and largest value of every dimension, and its labels. For an anchor a, the score
of anything in a block lies between ``sum(min(a lo, a hi))`` and ``sum(max(a lo, a hi))``.

What an anchor looks for are *windows* of scores: its positives (same label, any score), then for each positive the scores
between 80 % of its score and its score (other labels). Each window wants its first few rows, found in three steps:

1. *Own block.* The rows of the block in which the anchor lies give the window a threshold: the score of the last wanted.
2. *Zone maps.* A block is read for a window only if its bounds meet the window, at or above the threshold, and it holds a
   fitting label. Anchors and zone maps meet in slots, a bounded number of each in a task.
3. *Blocks.* The blocks chosen are scored against the anchors that chose them, slot by slot of anchors; each gives the
   first few rows of a window, and the first few of all these are the answer. It is exact: a block left out has no row
   that could be among them.

How much the zone maps leave out depends on how the vectors lie: ``mine(.., counts=[])`` reports it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .blocks import free_name

SCALE = 256
LAST = np.iinfo(np.int64).max  # stands for a null id
LOW = np.iinfo(np.int64).min


# ---------------------------------------------------------------- Hilbert order

def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells`` (rows x dimensions, values below ``2**bits``), as a number of
    dimensions * bits bits, 63 at most."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    # From the highest bit down, each sub-cube is turned and mirrored into the position of the first one.
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            mirror = (x[i] & q) != 0
            swap = np.where(mirror, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(mirror, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    # Gray code across the dimensions.
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _matrix(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _dot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two whole-number matrices: in doubles where these hold every sum."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    if float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1] < 2.0**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    return a @ b.T


def _lists(m: np.ndarray) -> pa.Array:
    width = m.shape[1] if m.ndim == 2 else 0
    return pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * width, pa.int32()), pa.array(np.ascontiguousarray(m).ravel(), pa.int32()))


def _numbers(column) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)


# ---------------------------------------------------------------- candidates

def candidates(embeddings: DataFrame, vector: str = "embedding", label: str = "label", key: str = "vec_id") -> DataFrame:
    """(vec_id, label, x) of the rows that take part.

    A null label, a null or empty vector and a null or non-finite component take no part, nor does a vector whose length d is
    not the commonest (the longer, on a tie), or with a component of ``2**31 / sqrt(d)`` or more after scaling: its scores might
    not fit 64 bits. A null id stays, and comes after all others in ties."""
    v = F.col(vector)
    ok = (F.col(label).isNotNull() & v.isNotNull() & (F.size(v) > 0)
          & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    rows = embeddings.where(F.coalesce(ok, F.lit(False)))
    sizes = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if sizes:
        d = sizes[0]["d"]
        rows = rows.where((F.size(v) == d) & F.forall(v, lambda c: F.abs(c.cast("double") * SCALE) < 2.0**31 / d**0.5))
    moved = F.when(F.col(key) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    return rows.select(F.col(key).cast("long").alias("vec_id"), moved.cast("long").alias("label"),
                       F.transform(v, lambda c: F.floor(c.cast("double") * SCALE).cast("int")).alias("x"))


def _spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray] | None:
    """Least and largest value and variance of each dimension; a few numbers for each task reach the driver, by way of a sum."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                m = _matrix(b.column(0)).astype(float)
                yield pa.RecordBatch.from_pydict({
                    "i": pa.array(range(m.shape[1]), pa.int32()), "n": pa.array([float(len(m))] * m.shape[1]), "lo": m.min(axis=0), "hi": m.max(axis=0),
                    "s": m.sum(axis=0), "ss": (m * m).sum(axis=0)})
    got = (rows.select("x").mapInArrow(run, "i int, n double, lo double, hi double, s double, ss double").groupBy("i")
           .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
           .orderBy("i").collect())
    if not got:
        return None
    n, lo, hi, s, ss = (np.array([r[c] for r in got]) for c in ("n", "lo", "hi", "s", "ss"))
    return lo, hi, ss / n - (s / n) ** 2


def write_blocks(rows: DataFrame, path: str, block_rows: int = 512, dims: int = 8, bits: int = 7) -> None:
    """Candidates in Hilbert order as Parquet at ``path``: (block, row, vec_id, label, x), blocks of ``block_rows`` rows at most.

    The curve runs through the ``dims`` dimensions of largest variance, each cut into ``2**bits`` cells. Equal places are
    dealt by id, so a vector that is repeated often fills blocks of its own."""
    found = _spread(rows)
    if found is None:
        rows.select(F.lit(0).cast("long").alias("block"), F.lit(0).cast("long").alias("row"), "*").write.parquet(path)
        return
    lo, hi, var = found
    used = np.sort(np.argsort(-var, kind="stable")[:min(dims, 63 // bits)])
    base, width = lo[used], np.maximum(hi[used] - lo[used], 1) / (1 << bits)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cells = np.minimum((_matrix(b.column(2))[:, used] - base) / width, (1 << bits) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(hilbert_key(cells.astype(np.int64), bits)), *b.columns], names=["h", "vec_id", "label", "x"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        first = TaskContext.get().partitionId() << 36
        seen = 0
        for b in batches:
            if b.num_rows:
                row = first + seen + np.arange(b.num_rows)
                seen += b.num_rows
                yield pa.RecordBatch.from_arrays([pa.array(row // block_rows), pa.array(row), *b.columns], names=["block", "row", "vec_id", "label", "x"])

    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    (rows.mapInArrow(place, "h long, vec_id long, label long, x array<int>")
     .repartitionByRange(parts, "h", "vec_id").sortWithinPartitions("h", "vec_id").drop("h")
     .mapInArrow(cut, "block long, row long, vec_id long, label long, x array<int>").write.parquet(path))


def zone_maps(blocks: DataFrame) -> DataFrame:
    """(block, lo, hi, labels): the least and largest value of each dimension, and the labels. A block that a batch border
    cuts has a zone map for each part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            block, label, m = b.column(0).to_numpy(), b.column(1).to_numpy(), _matrix(b.column(2))
            at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            held = [np.unique(label[i:j]).tolist() for i, j in zip(at, np.append(at[1:], len(block)))]
            yield pa.RecordBatch.from_arrays([pa.array(block[at]), _lists(np.minimum.reduceat(m, at)), _lists(np.maximum.reduceat(m, at)),
                                              pa.array(held, pa.list_(pa.int64()))], names=["block", "lo", "hi", "labels"])
    return blocks.select("block", "label", "x").mapInArrow(run, "block long, lo array<int>, hi array<int>, labels array<long>")


# ---------------------------------------------------------------- windows

def _first(score: np.ndarray, ids: np.ndarray, fits: np.ndarray, want: int) -> np.ndarray:
    """Places of the ``want`` first of those that fit: largest score, then smallest id."""
    at = np.flatnonzero(fits)
    if len(at) > want:
        edge = np.partition(score[at], len(at) - want)[len(at) - want]
        at = at[score[at] >= edge]
    return at[np.lexsort((ids[at], -score[at]))][:want]


class Anchors:
    """Rows (anchor, label, x, windows) of a task; a window is (number, low, high, threshold) of scores."""

    def __init__(self, t: pa.Table):
        self.row, self.label = t["anchor"].to_numpy(), t["label"].to_numpy()
        self.x = _matrix(t["x"])
        lists = t["windows"].combine_chunks() if isinstance(t["windows"], pa.ChunkedArray) else t["windows"]
        flat = lists.flatten()
        self.of = np.repeat(np.arange(t.num_rows), np.diff(lists.offsets.to_numpy()))
        self.w, self.low, self.high, self.least = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(4))


def _scan(t: pa.Table, a: Anchors, same: bool, want: int) -> pa.Table:
    """The first ``want`` rows of each window among the rows of one block."""
    row, ids, label = t["row"].to_numpy(), _numbers(t["vec_id"]), t["label"].to_numpy()
    scores = _dot(a.x, _matrix(t["x"]))
    out: list[tuple] = []
    for j in range(len(a.w)):
        i = a.of[j]
        s = scores[i]
        fits = (s >= max(a.low[j], a.least[j])) & (s <= a.high[j])
        fits &= (label == a.label[i]) & (row != a.row[i]) if same else label != a.label[i]
        for p in _first(s, ids, fits, want):
            out.append((int(a.row[i]), int(a.w[j]), int(s[p]), None if ids[p] == LAST else int(ids[p]), int(row[p])))
    cols = list(zip(*out)) if out else [[]] * 5
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor", "w", "score", "vec_id", "row"), cols)})


_FOUND = "anchor long, w long, score long, vec_id long, row long"
_WINDOWS = "array<struct<w: long, low: long, high: long, least: long>>"


def _thresholds(t: pa.Table, anchors: pa.Table, same: bool, want: int) -> pa.Table:
    """Step 1: each anchor with the threshold that its own block gives each of its windows."""
    if not anchors.num_rows or not t.num_rows:
        return pa.table({c: pa.array([], k) for c, k in (("anchor", pa.int64()), ("label", pa.int64()), ("x", pa.list_(pa.int32())), ("windows", _ARROW_WINDOWS))})
    a = Anchors(anchors)
    found = _scan(t, a, same, want)
    got: dict[tuple, list] = {}
    for i, w, s in zip(found["anchor"].to_pylist(), found["w"].to_pylist(), found["score"].to_pylist()):
        got.setdefault((i, w), []).append(s)
    windows: list[list] = [[] for _ in range(anchors.num_rows)]
    for j in range(len(a.w)):
        s = got.get((int(a.row[a.of[j]]), int(a.w[j])), [])
        windows[a.of[j]].append({"w": int(a.w[j]), "low": int(a.low[j]), "high": int(a.high[j]), "least": min(s) if len(s) == want else LOW})
    return pa.table({"anchor": anchors["anchor"], "label": anchors["label"], "x": anchors["x"], "windows": pa.array(windows, _ARROW_WINDOWS)})


_ARROW_WINDOWS = pa.list_(pa.struct([(n, pa.int64()) for n in ("w", "low", "high", "least")]))


def _choose(anchors: pa.Table, zones: pa.Table, same: bool) -> pa.Table:
    """Step 2: for each block, the anchors of the slot with a window that may have rows in it."""
    none = pa.table({"block": pa.array([], pa.int64()), "slot": pa.array([], pa.int64()), "wanted": pa.array([], pa.list_(pa.int64()))})
    if not anchors.num_rows or not zones.num_rows:
        return none
    a = Anchors(anchors)
    lo, hi = _matrix(zones["lo"]), _matrix(zones["hi"])
    up, down = np.maximum(a.x, 0), np.minimum(a.x, 0)
    most, least = _dot(up, hi) + _dot(down, lo), _dot(up, lo) + _dot(down, hi)  # anchors x zones
    labels = [set(x) for x in zones["labels"].to_pylist()]
    kinds = {k: np.array([k in s if same else bool(s - {k}) for s in labels]) for k in set(a.label.tolist())}
    may = np.zeros(most.shape, bool)
    for j in range(len(a.w)):
        i = a.of[j]
        may[i] |= (most[i] >= max(a.low[j], a.least[j])) & (least[i] <= a.high[j]) & kinds[int(a.label[i])]
    wanted: dict[int, set] = {}
    for z, b in enumerate(zones["block"].to_pylist()):
        hit = np.flatnonzero(may[:, z])
        if len(hit):
            wanted.setdefault(b, set()).update(a.row[hit].tolist())
    slot = anchors["slot"][0].as_py()
    return pa.table({"block": pa.array(list(wanted), pa.int64()), "slot": pa.array([slot] * len(wanted), pa.int64()),
                     "wanted": pa.array([sorted(s) for s in wanted.values()], pa.list_(pa.int64()))})


def _score(t: pa.Table, request: pa.Table, same: bool, want: int) -> pa.Table:
    """Step 3: the rows of one block against the anchors of one slot that chose it."""
    if not t.num_rows or not request.num_rows:
        return pa.table({n: pa.array([], pa.int64()) for n in ("anchor", "w", "score", "vec_id", "row")})
    return _scan(t, Anchors(request), same, want)


def search(blocks: DataFrame, zones: DataFrame, anchors: DataFrame, same: bool, want: int, slot_rows: int = 1024,
           counts: list | None = None) -> DataFrame:
    """(anchor, w, score, vec_id, row): the first ``want`` rows of every window of ``anchors`` (block, anchor, label, x, windows),
    among those of the anchor's label (``same``) or of others.

    ``counts``, if given, gets the number of (anchor, block) pairs that the zone maps left in and that of all."""
    cols = ["block", "row", "vec_id", "label", "x"]
    ready = (blocks.select(*cols).groupBy("block").cogroup(anchors.groupBy("block"))
             .applyInArrow(lambda t, a: _thresholds(t, a, same, want), f"anchor long, label long, x array<int>, windows {_WINDOWS}").checkpoint())
    n_anchors, n_zones = ready.count(), zones.count()
    a_slots, z_slots = max(1, -(-n_anchors // slot_rows)), max(1, -(-n_zones // slot_rows))
    slotted = ready.withColumn("slot", F.pmod(F.xxhash64("anchor"), F.lit(a_slots)))
    sides = (slotted.withColumn("zslot", F.explode(F.sequence(F.lit(0), F.lit(z_slots - 1)))).groupBy("slot", "zslot"))
    others = (zones.withColumn("zslot", F.pmod(F.xxhash64("block"), F.lit(z_slots)).cast("int"))
              .withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(a_slots - 1).cast("long")))).groupBy("slot", "zslot"))
    chosen = (sides.cogroup(others).applyInArrow(lambda a, z: _choose(a, z, same), "block long, slot long, wanted array<long>")
              .groupBy("block", "slot").agg(F.array_distinct(F.flatten(F.collect_list("wanted"))).alias("wanted")).checkpoint())
    if counts is not None:
        counts.append((chosen.agg(F.sum(F.size("wanted"))).first()[0] or 0, n_anchors * blocks.select("block").distinct().count()))
    asked = (chosen.select("block", "slot", F.explode("wanted").alias("anchor")).join(slotted, ["slot", "anchor"])
             .select(F.col("block").alias("b"), F.col("slot").alias("s"), "anchor", "label", "x", "windows"))
    read = blocks.select(*cols).join(chosen.select("block", "slot"), "block")
    found = (read.groupBy("block", "slot").cogroup(asked.groupBy("b", "s"))
             .applyInArrow(lambda t, q: _score(t, q, same, want), _FOUND))
    order = Window.partitionBy("anchor", "w").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("__r", F.row_number().over(order)).where(F.col("__r") <= want).withColumnRenamed("__r", "rank")


def mine(embeddings: DataFrame, every: int = 100, positives: int = 5, negatives: int = 5, block_rows: int = 512,
         counts: list | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Anchors are the rows whose id is divisible by ``every``; each has its first ``positives`` other rows of its label, and each of
    these the first ``negatives`` rows of other labels whose score is 80 to 100 % of its own. A positive of a score below zero has
    none. Order: larger score, then smaller id (a null id last), then place on the curve. A row that is repeated is so many rows;
    an anchor that is repeated gives its rows as often. Labels that are negative keep their sign in the change of label."""
    spark = embeddings.sparkSession
    path = scratch_path(spark, "negative-blocks")
    write_blocks(candidates(embeddings), path, block_rows)
    blocks = spark.read.parquet(path)
    zones = zone_maps(blocks)
    # Read apart: a table joined with what is made of it would have its columns twice.
    base = spark.read.parquet(path).where(F.col("vec_id") % every == 0).select("block", F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id"), "label", "x")
    any_score = F.array(F.struct(F.lit(0).cast("long").alias("w"), *[F.lit(v).cast("long").alias(n) for n, v in (("low", LOW), ("high", LAST), ("least", LOW))]))
    near = search(blocks, zones, base.select("block", "anchor", "label", "x", any_score.alias("windows")), True, positives, counts=counts)
    near = near.select("anchor", F.col("rank").cast("long").alias("w"), F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")).checkpoint()
    low = F.expr("positive_score - positive_score div 5")  # the least n of 80 p <= 100 n
    windows = (near.where("positive_score >= 0").groupBy("anchor")
               .agg(F.array_sort(F.collect_list(F.struct("w", low.alias("low"), F.col("positive_score").alias("high"), F.lit(LOW).alias("least")))).alias("windows")))
    far = search(blocks, zones, base.join(windows, "anchor").select("block", "anchor", "label", "x", "windows"), False, negatives, counts=counts)
    return (far.select("anchor", "w", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
            .join(near, ["anchor", "w"]).join(base.select("anchor", "anchor_id"), "anchor")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
