"""Near duplicates by ProbMinHash over weighted word shingles.

A text is the set of its runs of ``SHINGLE`` words (a text of fewer words is one shingle), each weighted
by one plus the logarithm of its count: a line that a text repeats a hundred times weighs more than one
that stands once, but cannot make two otherwise different texts alike. Every shingle sends arrivals of a Poisson process of its weight to random
registers; a register keeps the first shingle that reaches it, and a shingle stops as soon as its next
arrival is later than every register of the text (early termination). Two registers agree with the
probability Jaccard similarity of the texts. Registers are cut into bands; texts that share a band are
candidates, and the similarity of candidates is computed exactly.

Equal texts are one class (by MD5). In each band bucket the text with the most company is a hub, and all
members are verified against it; members that end up in another component than the hub become hubs in later
rounds, a growing number at a time, until no two components of a bucket hold an unchecked pair. Pairs of
these rounds must agree in ``AGREE`` of ``64 * len(SKETCH)`` further registers (one bit of each), which are made
for texts of such buckets only, before their texts are read; pairs with a text of ``FEW`` shingles or fewer
are verified without that.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import _STEP, Words, give_back, mix, privately, slices, words
from .components import components, gathered, joined_components

SHINGLE = 5
BANDS, ROWS = 24, 5
SKETCH = [f"s{i}" for i in range(16)]  # one bit of 64 registers each
AGREE = 896  # of the 1024 bits: 0.8 similar texts agree in 922 on average and fall below with a chance of 0.004
FEW = 16
GROUP = 256  # members that are verified against one copy of a hub


def shingles(w: Words, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle hash, weight) of each different shingle of each row, in order of row."""
    h, row = w.hashes(), w.rows()
    at, hs = w.windows(h, k)
    rows, els = [row[at]], [hs]
    for short in range(1, k):
        if np.any(w.n == short):
            at, hs = w.windows(h, short)
            own = w.n[row[at]] == short
            rows.append(row[at][own])
            els.append(hs[own] ^ _STEP[short])
    rows, els = np.concatenate(rows), np.concatenate(els)
    _, first, count = np.unique(mix(els ^ mix(rows.astype(np.uint64) + np.uint64(11))), return_index=True, return_counts=True)
    order = np.argsort(rows[first], kind="stable")
    return rows[first][order], els[first][order], 1 + np.log(count[order])


def prob_min_hash(row: np.ndarray, el: np.ndarray, weight: np.ndarray, n_rows: int, m: int) -> np.ndarray:
    """Registers (n_rows x m) of element hashes; rows without elements keep zeros."""
    when = np.full(n_rows * m, np.inf)
    who = np.zeros(n_rows * m, np.uint64)
    latest = np.full(n_rows, np.inf)
    clock = np.zeros(len(el))
    step, due = 0, 1
    while len(el):
        step += 1
        draw = mix(el + np.uint64(step * 0x9E3779B97F4A7C15 % 2**64))
        clock = clock - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        live = clock < latest[row]
        row, el, weight, clock, draw = row[live], el[live], weight[live], clock[live], draw[live]
        slot = row * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        np.minimum.at(when, slot, clock)
        won = when[slot] == clock
        who[slot[won]] = el[won]
        if step >= due:  # a bound that is renewed later only lets more arrivals pass
            due = step + 1 + step // 8
            some = np.unique(row)
            latest[some] = when.reshape(n_rows, m)[some].max(axis=1)
    return who.reshape(n_rows, m)


def _signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, id, bands): MD5 of the text and its band keys (none for a text without words)."""
    key_type = docs.schema[key].dataType.simpleString()

    def banded(part: pa.RecordBatch) -> pa.RecordBatch:
        w = words(part.column(2))
        row, el, n = shingles(w)
        reg = prob_min_hash(row, el, n, part.num_rows, BANDS * ROWS)
        full = np.zeros((part.num_rows, BANDS), np.uint64)
        for b in range(BANDS):
            for r in range(ROWS):
                full[:, b] += reg[:, b * ROWS + r] * _STEP[r]
            full[:, b] = mix(full[:, b] + np.uint64((b + 1) * int(_STEP[20]) % 2**64))
        has = w.n > 0
        off = np.concatenate([[0], np.cumsum(np.where(has, BANDS, 0))]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(off), pa.array(full[has].reshape(-1).view(np.int64)))
        return pa.RecordBatch.from_arrays([part.column(0), part.column(1), bands], names=["key", "id", "bands"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield banded(part)
        give_back()

    slim = docs.select(F.col(key).alias("key"), _id(F.col(text)).alias("id"), F.col(text).alias("text"))
    return slim.mapInArrow(run, f"key {key_type}, id binary, bands array<long>")


def sketch_bits(row: np.ndarray, el: np.ndarray, weight: np.ndarray, n_rows: int) -> np.ndarray:
    """One bit of each of ``64 * len(SKETCH)`` registers, 64 in a number. A bit depends on the register too:
    one shingle wins many registers of a short text, and must not give them all the same bit."""
    m = 64 * len(SKETCH)
    reg = prob_min_hash(row, mix(el ^ _STEP[21]), weight, n_rows, m)
    return np.packbits((mix(reg ^ mix(np.arange(m, dtype=np.uint64))) & np.uint64(1)).astype(np.uint8), axis=1).view(np.int64)


def _sketches(texts: DataFrame) -> DataFrame:
    """(id, few, s0 ..): ``sketch_bits`` of the texts (id, text), and whether one has ``FEW`` shingles at most."""
    def sketched(part: pa.RecordBatch) -> pa.RecordBatch:
        row, el, n = shingles(words(part.column(1)))
        sketch = sketch_bits(row, el, n, part.num_rows)
        few = np.bincount(row, minlength=part.num_rows) <= FEW
        return pa.RecordBatch.from_arrays(
            [part.column(0), pa.array(few), *[pa.array(np.ascontiguousarray(sketch[:, i])) for i in range(len(SKETCH))]],
            names=["id", "few", *SKETCH])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, rows=1 << 9):
            yield sketched(part)
        give_back()

    return texts.select("id", "text").mapInArrow(run, "id binary, few boolean, " + ", ".join(f"{c} long" for c in SKETCH))


def _id(text):
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _weights(text: str) -> tuple[np.ndarray, np.ndarray]:
    _, el, n = shingles(words(pa.array([text or ""])))
    order = np.argsort(el)
    return el[order], n[order]


def prob_jaccard(a: tuple, b: tuple) -> float:
    """Probability Jaccard similarity of two weighted sets given as (sorted elements, weights)."""
    both, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    x, y = a[1][ia], b[1][ib]
    order = np.argsort(x / y, kind="stable")
    x, y = x[order], y[order]
    ratio = x / y
    first = np.searchsorted(ratio, ratio, side="left")     # equal ratios count with the larger side
    more = np.append(np.cumsum(x[::-1])[::-1], 0.0)[first] + (a[1].sum() - x.sum())
    less = np.concatenate([[0.0], np.cumsum(y)])[first] + (b[1].sum() - y.sum())
    return float(np.sum(1.0 / (more / x + less / y)))


def _agreeing() -> F.Column:
    """Equal bits of sketches ``s0 ..`` and ``h0 ..``."""
    differ = F.lit(0)
    for c in SKETCH:
        differ = differ + F.bit_count(F.col(c).bitwiseXOR(F.col("h" + c[1:])))
    return F.lit(64 * len(SKETCH)) - differ


def verify(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) whose texts are ``threshold`` similar or more.

    Members travel to the copy of their hub: a hub with many members has one copy of its text for
    every ``GROUP`` of them, so a hot hub is spread over tasks and its text is not sent with each pair.
    """
    size = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("parts"))
    dealt = pairs.join(size, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"))
    hub_rows = (dealt.select("a", "part").distinct().join(texts.withColumnRenamed("id", "a"), "a")
                .select("a", "part", F.lit(None).cast("binary").alias("b"), "text"))
    member_rows = dealt.join(texts.withColumnRenamed("id", "b"), "b").select("a", "part", "b", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_key, held = None, None, None
        for batch in batches:
            out_a, out_b = [], []
            for a, part, b, text in zip(*[c.to_pylist() for c in batch.columns]):
                if b is None:
                    hub, hub_key = _weights(text), (a, part)
                elif hub_key == (a, part):
                    held = _weights(text)
                    if prob_jaccard(hub, held) >= threshold:
                        out_a.append(a), out_b.append(b)
                else:
                    raise RuntimeError("a member came before its hub")
            yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.binary()), pa.array(out_b, pa.binary())], names=["a", "b"])
        give_back()

    return (hub_rows.unionByName(member_rows).repartition("a", "part")
            .sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
            .select("a", "part", "b", "text").mapInArrow(run, "a binary, b binary"))


def near_duplicates(docs: DataFrame, threshold: float = 0.8, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: key, id (MD5 of the text), comp (smallest id of its near
    duplicates, its own if none).

    A null text is an empty one. Texts without words have no shingles: they are near duplicates of
    equal texts only. Repeated rows are exact copies. Other columns of ``docs`` are not read.
    """
    signed = _signed(docs, key, text).checkpoint()
    rows = signed.select("id", F.explode("bands").alias("band"))
    shared = rows.groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("top")).where("low <> top").select("band")
    members = rows.join(shared, "band").distinct().checkpoint()      # buckets of two or more texts
    # Hubs are the texts with the most company: the origin of a group of near copies shares more bands
    # with each copy than two copies do, and links them all.
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("n"))
    degree = members.join(sizes, "band").groupBy("id").agg(F.sum("n").alias("degree"))
    members = members.join(degree, "id")
    hubs = members.groupBy("band").agg(F.max(F.struct("degree", "id")).getField("id").alias("hub"))
    members = members.join(hubs, "band").select("band", "id", "degree", "hub").checkpoint()
    involved = members.select("id").distinct()
    texts = (docs.select(_id(F.col(text)).alias("id"), F.col(text).alias("text"))
             .join(involved, "id", "left_semi").dropDuplicates(["id"]).checkpoint())
    pairs = members.where("id <> hub").select("hub", "id").distinct().checkpoint()
    pairs = pairs.withColumnsRenamed({"hub": "a", "id": "b"})
    edges = verify(pairs, texts, threshold).checkpoint()
    comp = components(edges).checkpoint()
    # Buckets of three texts or more that still lie in several components; the others are done.
    apart = (members.join(comp, "id", "left").groupBy("band")
             .agg(F.count(F.lit(1)).alias("n"), F.min(F.coalesce("comp", "id")).alias("low"),
                  F.max(F.coalesce("comp", "id")).alias("top")).where("n > 2 and low <> top"))
    members = members.join(apart.select("band"), "band", "left_semi").checkpoint()
    rows = members.count()
    members = gathered(members, rows)
    texts = gathered(texts.join(members.select("id").distinct(), "id", "left_semi"), rows).checkpoint()
    sketches = _sketches(texts).checkpoint()
    used = members.select("band", F.col("hub").alias("id")).distinct()
    done, hubs_at_once = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), 4
    while True:
        placed = gathered(members.join(comp, "id", "left").withColumn("comp", F.coalesce("comp", "id")), rows).checkpoint()
        main = placed.where("id = hub").select("band", F.col("comp").alias("main"))
        todo = (placed.join(main, "band").where("comp <> main").join(used, ["band", "id"], "left_anti")
                .withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(hubs_at_once))))
        new = gathered(todo.groupBy("band", "slice").agg(F.max(F.struct("degree", "id", "comp")).alias("h")).select(
            "band", F.col("h.id").alias("a"), F.col("h.comp").alias("acomp")), rows).checkpoint()
        if new.isEmpty():
            break
        hub = new.join(sketches.select(F.col("id").alias("a"), F.col("few").alias("hfew"), *[F.col(c).alias("h" + c[1:]) for c in SKETCH]), "a")
        fresh = hub.join(placed.select("band", "id", "comp").join(sketches, "id"), "band").where(
            (F.col("comp") != F.col("acomp")) & (F.col("few") | F.col("hfew") | (_agreeing() >= AGREE))).select(
            F.least("a", "id").alias("a"), F.greatest("a", "id").alias("b"))
        fresh = gathered(gathered(fresh, rows).distinct().join(done, ["a", "b"], "left_anti"), rows).checkpoint()
        used = used.unionByName(new.select("band", F.col("a").alias("id")))
        found = gathered(verify(fresh, texts, threshold), rows).checkpoint()
        done = done.unionByName(fresh)
        if not found.isEmpty():
            comp = joined_components(comp, found).checkpoint()
        hubs_at_once *= 16
    return (signed.select("key", "id").join(comp, "id", "left")
            .select(F.col("key").alias(key), "id", F.coalesce("comp", "id").alias("comp")))


def duplicate_report(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the near duplicates; null if all are null), exact_id
    (smallest doc_id of the equal texts), class_docs, kept (the first row of its class).

    Of rows that tie for the smallest doc_id (repeated rows), all are marked as kept here;
    ``drop_near_duplicates`` keeps one.
    """
    found = near_duplicates(docs, threshold).checkpoint()
    exact = found.groupBy("id", "comp").agg(F.min("doc_id").alias("exact_id"), F.count(F.lit(1)).alias("n")).checkpoint()
    cls = exact.groupBy("comp").agg(F.min("exact_id").alias("class_id"), F.sum("n").alias("class_docs"))
    lookup = exact.join(cls, "comp").select("id", "exact_id", "class_id", "class_docs")
    return found.join(lookup, "id").select(
        "doc_id", "class_id", "exact_id", "class_docs",
        F.equal_null("doc_id", "class_id").alias("kept"))


def drop_near_duplicates(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """One row of ``docs`` of each class of near duplicates: the one of the smallest doc_id (nulls
    last), of equal ones the one of the smallest text hash; repeated rows are reduced to one. Extra columns may have any names."""
    return privately(docs, ["doc_id", "text"], lambda d: _first_of_classes(d, threshold))


def _first_of_classes(docs: DataFrame, threshold: float) -> DataFrame:
    found = near_duplicates(docs, threshold)
    last = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("id").alias("i"))
    kept = (found.groupBy("comp").agg(F.min(last).alias("k")).select(F.col("k.d").alias("__d"), F.col("k.i").alias("__i")))
    times = found.groupBy("doc_id", "id").agg(F.count(F.lit(1)).alias("__n")).withColumnRenamed("doc_id", "__td")
    kept = kept.join(times, F.equal_null("__d", F.col("__td")) & (F.col("__i") == F.col("id"))).select("__d", "__i", "__n")
    tagged = docs.withColumn("__id", _id(F.col("text")))
    joined = tagged.join(kept.checkpoint(), F.equal_null(tagged["doc_id"], F.col("__d")) & (F.col("__id") == F.col("__i")))
    # Only repeated rows (same doc_id and text) need a second look; its partial aggregation comes first.
    repeated = joined.where("__n > 1").dropDuplicates(["doc_id", "__id"])
    return joined.where("__n = 1").unionByName(repeated).select(*docs.columns)
