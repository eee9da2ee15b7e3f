"""Quality classifier: ordinal cumulative-link regression on graded ratings.

``P(grade <= k) = sigmoid(theta_k - w . x)`` with one weight vector for all grades and ordered
thresholds. ``x`` holds shares of hashed byte 3-grams over the whole text and four shares of
repetition and shape. The model is fitted on a bounded sample of rated rows in one task and is a
vector of fixed size; scoring is a lookup per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import mix, slices, words

BUCKETS = 1 << 14
DENSE = 4
SCALE = 30.0  # shares are small numbers; the weights stay of order one


def _grams(w) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each byte 3-gram inside a row, its row)."""
    d = w.data.astype(np.uint64)
    if len(d) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(w.off) - 1), np.diff(w.off))
    inside = row[2:] == row[:-2]
    key = (d[:-2] << np.uint64(16)) | (d[1:-1] << np.uint64(8)) | d[2:]
    return (mix(key[inside]) % np.uint64(BUCKETS)).astype(np.int64), row[:-2][inside]


def _dense(w) -> np.ndarray:
    """Per row: share of repeated words, mean word length, log length, share of non-letter bytes."""
    n, rows = w.n, len(w.n)
    h, row = w.hashes(), w.rows()
    distinct = np.bincount(np.unique(np.stack([row.astype(np.uint64), h]), axis=1)[0].astype(np.int64),
                           minlength=rows) if len(h) else np.zeros(rows)
    size = np.diff(w.off)
    letters = ((w.data | 32) - 97 < 26) | (w.data >= 128) | (w.data <= 32)
    odd = np.bincount(np.repeat(np.arange(rows), size)[~letters], minlength=rows)
    safe = np.maximum(n, 1)
    return np.stack([1 - distinct / safe, np.minimum(size / safe, 40) / 10, np.log1p(n) / 5,
                     odd / np.maximum(size, 1) * 5], axis=1)



def fit_ordinal(batches: list, grades: list[int], rounds: int = 250, l2: float = 1e-4) -> tuple:
    """(weights, thresholds) by Adam on the mean log-likelihood; ``batches`` are (rows, text, grade)."""
    col, row, dense, y, base = [], [], [], [], 0
    for text, grade in batches:
        w = words(text)
        g, r = _grams(w)
        key, count = np.unique(r * BUCKETS + g, return_counts=True)
        r = key // BUCKETS
        per = np.bincount(r, weights=count, minlength=len(text))
        col.append(np.stack([key % BUCKETS, r + base]))
        row.append(SCALE * count / per[r])
        dense.append(_dense(w))
        y.append(np.searchsorted(grades, grade))
        base += len(text)
    (gram, doc), val = np.concatenate(col, axis=1), np.concatenate(row)
    dense, y, k = np.concatenate(dense), np.concatenate(y), len(grades)
    share = np.bincount(y, minlength=k) / len(y)
    cum = np.clip(np.cumsum(share)[:-1], 1e-3, 1 - 1e-3)
    theta = np.log(cum / (1 - cum))
    first, gaps = theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))
    par = np.concatenate([np.zeros(BUCKETS + DENSE), first, gaps])
    m, v = np.zeros_like(par), np.zeros_like(par)
    sig = lambda t: 0.5 * (1 + np.tanh(t / 2))
    for step in range(1, rounds + 1):
        wt, wd = par[:BUCKETS], par[BUCKETS:BUCKETS + DENSE]
        th = np.cumsum(np.concatenate([par[BUCKETS + DENSE:][:1], np.exp(par[BUCKETS + DENSE + 1:])]))
        s = np.bincount(doc, weights=val * wt[gram], minlength=len(y)) + dense @ wd
        edge = np.concatenate([[-np.inf], th, [np.inf]])
        up, lo = sig(edge[y + 1] - s), sig(edge[y] - s)
        p = np.maximum(up - lo, 1e-12)
        dup, dlo = up * (1 - up) / p, lo * (1 - lo) / p
        ds = (dup - dlo) / len(y)                     # d(-log p)/ds
        gth = np.zeros(k + 1)
        np.add.at(gth, y + 1, -dup / len(y))
        np.add.at(gth, y, dlo / len(y))
        gth = gth[1:k]
        back = np.cumsum(gth[::-1])[::-1]             # thresholds are running sums of the gaps
        grad = np.concatenate([np.bincount(gram, weights=val * ds[doc], minlength=BUCKETS) + l2 * wt,
                               dense.T @ ds + l2 * wd, back[:1], back[1:] * np.exp(par[BUCKETS + DENSE + 1:])])
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        par = par - 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    th = np.cumsum(np.concatenate([par[BUCKETS + DENSE:][:1], np.exp(par[BUCKETS + DENSE + 1:])]))
    return par[:BUCKETS + DENSE], th


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample_rows: int) -> DataFrame:
    """(text, label) of the documents of at most ``sample_rows`` label rows, those of the smallest hash
    of their doc_id. The rows are chosen from the labels alone, so only the texts of the sample are
    read on; the chosen rows are few by the parameter, and are sent to every task."""
    few = (labels.where(F.col(label).isNotNull()).select("doc_id", F.col(label).cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(sample_rows))
    return docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").select("text", "label")


def train(rated: DataFrame) -> tuple | None:
    """(weights, thresholds, grades) from a bounded sample of (text, label) rows, which move to one task
    once they are joined (the join and its scan stay in many); null texts count as empty. None without two grades."""
    sample = rated.repartition(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column(0), b.column(1).to_numpy()) for b in slices(batches)]
        grades = sorted({int(g) for _, y in parts for g in y})
        if len(grades) < 2:
            return
        weights, th = fit_ordinal(parts, grades)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()]), pa.array([th.tolist()]),
                                          pa.array([grades], pa.list_(pa.int32()))], names=["w", "theta", "grades"])

    got = sample.select("text", "label").mapInArrow(run, "w array<double>, theta array<double>, grades array<int>").collect()
    return (np.array(got[0]["w"]), np.array(got[0]["theta"]), list(got[0]["grades"])) if got else None


def score(docs: DataFrame, model: tuple | None, keep: list[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """``keep`` columns, expected_grade, tail_prob (chance of the highest grade). Without a model both
    are null. Null and empty texts are scored as empty."""
    keep = list(keep)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += ", expected_grade double, tail_prob double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            n = part.num_rows
            if model is None:
                exp, tail = pa.nulls(n, pa.float64()), pa.nulls(n, pa.float64())
            else:
                weights, theta, grades = model
                w = words(part.column(part.schema.get_field_index(text)))
                g, r = _grams(w)
                per = np.bincount(r, minlength=n)
                s = SCALE * np.bincount(r, weights=weights[:BUCKETS][g], minlength=n) / np.maximum(per, 1)
                s += _dense(w) @ weights[BUCKETS:]
                below = 0.5 * (1 + np.tanh((theta[None, :] - s[:, None]) / 2))
                p = np.diff(np.concatenate([np.zeros((n, 1)), below, np.ones((n, 1))], axis=1), axis=1)
                exp, tail = pa.array(p @ np.array(grades, float)), pa.array(p[:, -1])
            cols = [part.column(part.schema.get_field_index(c)) for c in keep]
            yield pa.RecordBatch.from_arrays(cols + [exp, tail], names=keep + ["expected_grade", "tail_prob"])

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(run, schema)


def quality_report(docs: DataFrame, labels: DataFrame, min_tail: float = 0.5, sample_rows: int = 6000) -> DataFrame:
    """doc_id, held_out, expected_grade, tail_prob, selected. Rows whose crc32(doc_id as text) mod 5
    is 0 are held out of training. Without a model every document is selected."""
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rated = labelled_sample(docs, labels.where(~out), "quality", sample_rows)
    scored = score(docs.select("doc_id", "text", out.alias("held_out")), train(rated), keep=["doc_id", "held_out"])
    return scored.withColumn("selected", F.coalesce(F.col("tail_prob") >= min_tail, F.lit(True)))
