"""Embedding whitening by Chebyshev-filtered subspace iteration.

A component c of a vector becomes the whole number ``floor(64 c) + 1000000``. The model is fitted on the *fit list*,
each distinct vector once: its leading eigenvectors are found without forming the covariance V. A block of vectors Q
is multiplied by V in one distributed pass over the fit list (each task sums ``Xᵀ(XQ)`` of its centred rows, and the
driver adds matrices of dimension x block). Per round:

1. *Filter.* The Chebyshev recurrence of some degree, mapped to the interval from the lower end of the spectrum (a few
   Lanczos passes) to the smallest Ritz value of the block, damps that interval and lets what lies above grow.
2. *QR and Rayleigh-Ritz.* The block is made orthonormal, and the small matrix QᵀVQ rotates it onto Ritz pairs.
3. *Certificate.* The residuals ``|Vq - eq|`` of the wanted pairs must reach ``tol`` times the largest eigenvalue, or
   stop falling below a thousand times that.

Centring is exact: a row enters as ``(n x - S) / n`` with whole n, x and S.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .blocks import free_name

SCALE, SHIFT = 64, 1_000_000
LARGEST = float(1 << 40)  # of 64 c; beyond it sums of squares have no 64-bit form
GROUPS = 64  # partial matrices that reach the driver at once


@dataclass
class Whitening:
    """n fit vectors, per-dimension sums, eigenvalues (falling), components (one column each), trace of V, the largest
    entry of the whitened covariance minus the identity, and how many rounds and passes over the fit list it took."""
    n: int
    sums: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float
    identity_error: float
    rounds: int
    passes: int


def quantised(embeddings: DataFrame, vector: str = "embedding", name: str = "x") -> DataFrame:
    """The rows whose vector is usable, with the whole numbers ``name``.

    Vectors that are null, empty, hold null or non-finite entries, or entries of 2**34 or more, are dropped, and so
    are those whose length is not the commonest (the longer one, on a tie)."""
    v = F.col(vector)
    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < LARGEST))
    rows = embeddings.where(F.coalesce(ok, F.lit(False)))
    sizes = rows.groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not sizes:
        rows, d = rows.where("1 = 0"), 0
    else:
        d = sizes[0]["d"]
    return (rows.where(F.size(v) == d)
            .withColumn(name, F.transform(v, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT).cast("long"))))


def _matrix(column: pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0), np.int64)


def _pass(fit: DataFrame, work: Callable[[np.ndarray], np.ndarray]) -> np.ndarray | None:
    """Sum of ``work(x)`` over all batches x of the fit list; None if it is empty. Each task adds up its own; where there are
    many, groups of tasks are added before anything reaches the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = None
        for b in batches:
            if b.num_rows:
                part = work(_matrix(b.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_pydict({"task": [TaskContext.get().partitionId()], "m": [total.tobytes()],
                                              "kind": [total.dtype.str], "rows": [total.shape[0]]})

    def add(t: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, k) for _, x, k in sorted(zip(t["task"].to_pylist(), t["m"].to_pylist(), t["kind"].to_pylist()))]
        return pa.table({"task": t["task"].slice(0, 1), "m": [sum(parts[1:], parts[0]).tobytes()], "kind": t["kind"].slice(0, 1),
                         "rows": t["rows"].slice(0, 1)})

    kinds = "task long, m binary, kind string, rows long"
    parts = fit.select("x").mapInArrow(run, kinds)
    if fit.rdd.getNumPartitions() > GROUPS:
        parts = parts.groupBy(F.pmod(F.col("task"), F.lit(GROUPS)).alias("g")).applyInArrow(add, kinds)
    got = sorted(parts.collect(), key=lambda r: r["task"])
    if not got:
        return None
    whole = [np.frombuffer(r["m"], r["kind"]) for r in got]
    return sum(whole[1:], whole[0]).reshape(got[0]["rows"], -1)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    return (n * x - sums) / n


def chebyshev(apply: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float,
              degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of V on [low, high], times ``q``; ``vq`` is Vq, ``top`` the largest eigenvalue,
    at which the result is scaled to one."""
    half, centre = (high - low) / 2, (high + low) / 2
    first = sigma = half / (top - centre)
    before, now = q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (2 * after / half) * (apply(now) - centre * now) - sigma * after * before
        sigma = after
    return now


def _lower_end(apply: Callable[[np.ndarray], np.ndarray], d: int, steps: int, rng: np.random.Generator) -> float:
    """About the smallest eigenvalue, from below: the smallest Ritz value of a Lanczos run less its residual."""
    v = rng.standard_normal((d, 1))
    basis, alpha, beta = [v / np.linalg.norm(v)], [], []
    for _ in range(min(steps, d)):
        w = apply(basis[-1])
        alpha.append(float((basis[-1].T @ w)[0, 0]))
        held = np.hstack(basis)
        for _ in range(2):
            w = w - held @ (held.T @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-14 * max(alpha):
            break
        basis.append(w / beta[-1])
    m = len(alpha)
    values, vectors = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:m - 1], 1) + np.diag(beta[:m - 1], -1))
    return max(0.0, float(values[0] - abs(beta[m - 1] * vectors[-1, 0])))


def _degree(low: float, high: float, top: float, least: float, most: int) -> int:
    """The largest degree up to ``most`` at which the filter keeps the largest wanted eigenvalue within 10**10 of the least."""
    half, centre = (high - low) / 2, (high + low) / 2
    grow = np.arccosh(max((top - centre) / half, 1)) - np.arccosh(max((least - centre) / half, 1))
    return most if grow <= 0 else int(np.clip(np.log(1e10) / grow, 2, most))


def fit_whitening(fit: DataFrame, k: int = 16, guard: int = 16, degree: int = 10, lanczos: int = 10, tol: float = 1e-14,
                  max_rounds: int = 100, seed: int = 7) -> Whitening | None:
    """The whitening of a fit list (a column ``x`` of whole-number vectors of one length); None where it is empty.

    Up to ``k`` components, fewer where the dimension is smaller or V has fewer eigenvalues above 1e-12 of the largest
    (none at all where all vectors are equal). Ties of eigenvalues leave the basis within them open. What the driver
    holds is bounded by the dimension times ``k + guard``. A model that is not certified after ``max_rounds`` raises."""
    passes = 0
    got = _pass(fit, lambda x: np.vstack([np.full(x.shape[1], len(x), np.int64), x.sum(axis=0)]))
    if got is None:
        return None
    n, sums = int(got[0, 0]), got[1].astype(np.int64)
    d = len(sums)

    def apply(q: np.ndarray) -> np.ndarray:
        nonlocal passes
        passes += 1

        def work(x: np.ndarray) -> np.ndarray:
            c = _centred(x, n, sums)
            return c.T @ (c @ q)
        return _pass(fit, work) / n

    trace = float(_pass(fit, lambda x: np.array([[(_centred(x, n, sums) ** 2).sum()]]))[0, 0]) / n
    nothing = Whitening(n, sums, np.zeros(0), np.zeros((d, 0)), trace, 0.0, 0, 2)
    if trace == 0:
        return nothing
    rng = np.random.default_rng(seed)
    size = min(d, k + guard)
    low = 0.0 if size == d else _lower_end(apply, d, lanczos, rng)
    q = np.linalg.qr(rng.standard_normal((d, size)))[0]
    seen = np.inf
    for rounds in range(1, max_rounds + 1):
        vq = apply(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        wanted = min(k, int((values > 1e-12 * values[0]).sum()))
        worst = float(np.linalg.norm(vq[:, :wanted] - q[:, :wanted] * values[:wanted], axis=0).max()) / values[0]
        if worst <= tol or (worst <= 1000 * tol and worst > seen / 2):
            break
        seen = worst
        high = float(values[-1])
        if size == d or high <= 1e-12 * values[0]:
            y = vq  # nothing to damp
        else:
            edge = min(low, 0.999 * high)
            y = chebyshev(apply, q, vq, edge, high, values[0], _degree(edge, high, values[0], values[wanted - 1], degree))
        q = np.linalg.qr(y / np.linalg.norm(y, axis=0))[0]
    else:
        raise RuntimeError(f"residual {worst} of the largest eigenvalue after {max_rounds} rounds, {tol} wanted")
    values, q = values[:wanted].copy(), q[:, :wanted].copy()
    to_unit = q / np.sqrt(values)

    def products(x: np.ndarray) -> np.ndarray:
        w = _centred(x, n, sums) @ to_unit
        return np.vstack([w.T @ w, w.sum(axis=0)])
    total = _pass(fit, products) / n
    error = float(np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(wanted)).max())
    return Whitening(n, sums, values, q, trace, error, rounds, passes + 3)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> pa.Array:
    """Sum of (n x - S)**2 by row, exactly; null where that passes 64 bits."""
    t = n * x - sums
    if t.size and float(np.abs(t).max()) ** 2 * x.shape[1] >= 2.0**62:
        whole = [sum(int(v) ** 2 for v in row) for row in t]
        return pa.array([v if v < 2**63 else None for v in whole], pa.int64())
    return pa.array((t * t).sum(axis=1), pa.int64())


def whiten(rows: DataFrame, model: Whitening, keep: list[str] = ("vec_id",), x: str = "x") -> DataFrame:
    """``keep`` columns of ``rows``, deviation (exact; null beyond 64 bits) and whitened (one value for each component).
    Added columns whose names are taken are preceded by ``_``."""
    keep = list(keep)
    inner = [f"__k{i}" for i in range(len(keep))]
    added = [free_name(keep, "deviation"), free_name(keep, "whitened")]
    n, sums, to_unit = model.n, model.sums, model.components / np.sqrt(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            m = _matrix(b.column(0))
            w = _centred(m, n, sums) @ to_unit
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([*b.columns[1:], _deviation(m, n, sums), lists], names=[*inner, *added])

    kinds = ", ".join(f"`{i}` {rows.schema[c].dataType.simpleString()}" for i, c in zip(inner, keep))
    return (rows.select(F.col(x).alias("__x"), *[F.col(c).alias(i) for i, c in zip(inner, keep)])
            .mapInArrow(run, f"{kinds}, `{added[0]}` long, `{added[1]}` array<double>").toDF(*keep, *added))


def whitening_report(embeddings: DataFrame, k: int = 16) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row of ``embeddings`` and
    component; no row where no vector is usable or all are equal. Repeated rows appear as often as they stand there.
    The fit list is a table in the shared folder, which every pass reads."""
    rows = quantised(embeddings, name="__x").select("vec_id", F.col("__x").alias("x"))
    path = scratch_path(embeddings.sparkSession, "fit-list")
    rows.select("x").distinct().write.parquet(path)
    model = fit_whitening(embeddings.sparkSession.read.parquet(path), k)
    if model is None or not len(model.values):
        return (rows.where("1 = 0").select("vec_id", F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"),
                                           *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")]))
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return (whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("__i", "whitened"))
            .select("vec_id", (F.col("__i") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("__i") + 1).alias("explained"), F.lit(model.identity_error).alias("identity_error")))
