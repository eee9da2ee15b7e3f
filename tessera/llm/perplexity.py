"""Quality rules by n-gram perplexity.

A modified Kneser-Ney model of byte n-grams (order ``ORDER``) is counted over every text: tasks count
their own rows in sorted arrays, Spark adds the counts up, and the lower orders (how many different
bytes precede an n-gram), discounts and probabilities are DataFrame aggregations and joins. Each
language (its ``lang`` value; null is one of its own) has its own model: 24 bits of the language's
CRC-32 stand above the n-gram in a 64-bit key, so a key holds its n-gram exactly. Finished models are
sorted arrays of mixed keys with log probabilities, found by the leading bits of the hash.

Documents are rejected outside a band of log perplexity that is set for each language from the
quartiles of its documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocks import _BYTE, _SPACE, _STEP, Words, mix, place_weights, slices, words

ORDER = 5
BODY = (1 << 40) - 1
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_ANY = _BYTE.copy()
_ANY[_SPACE] = _STEP[40:46]
_ANY[10] = 0


def lang_code(lang: str | None) -> int:
    return (zlib.crc32(lang.encode()) if lang is not None else 0x5EED) & 0xFFFFFF


def gram_keys(data: np.ndarray, off: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Key of the n-gram that ends at each byte; a row starts after ORDER - 1 zero bytes."""
    if not data.size:
        return np.zeros(0, np.uint64)
    size, pad = np.diff(off), ORDER - 1
    at = np.arange(data.size) + pad * np.repeat(np.arange(1, len(size) + 1), size)
    full = np.zeros(data.size + pad * len(size), np.uint64)
    full[at] = data
    key = full[at].copy()
    for j in range(1, ORDER):
        key |= full[at - j] << np.uint64(8 * j)
    return key | np.repeat(codes.astype(np.uint64) << np.uint64(40), size)


def _codes(part: pa.RecordBatch, lang: str) -> np.ndarray:
    memo: dict = {}
    col = part.column(part.schema.get_field_index(lang)).to_pylist()
    return np.array([memo.setdefault(x, lang_code(x)) for x in col], np.uint64)


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    key = np.concatenate([p[0] for p in parts])
    n = np.concatenate([p[1] for p in parts])
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, int)
    return key[first], np.add.reduceat(n, first) if len(key) else n


def count_grams(docs: DataFrame, text: str = "text", lang: str = "lang", hold: int = 1 << 21) -> DataFrame:
    """(key, n) of the n-grams of all texts. A task keeps at most about 2 * ``hold`` different keys
    before it passes its counts on."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(key, n):
            for i in range(0, len(key), 200_000):
                yield pa.RecordBatch.from_arrays([pa.array(key[i:i + 200_000].view(np.int64)),
                                                  pa.array(n[i:i + 200_000].astype(np.int64))], names=["key", "n"])

        parts, size = [], 0
        for part in slices(batches, text):
            w = words(part.column(part.schema.get_field_index(text)))
            key = np.sort(gram_keys(w.data, w.off, _codes(part, lang)))
            if not len(key):
                continue
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            parts.append((key[first], np.diff(np.append(first, len(key)))))
            size += len(first)
            if size > hold:
                parts = [_merge(parts)]
                size = len(parts[0][0])
                if size > hold:
                    yield from out(*parts[0])
                    parts, size = [], 0
        if parts:
            yield from out(*_merge(parts))

    return (docs.select(text, lang).mapInArrow(run, "key long, n long")
            .groupBy("key").agg(F.sum("n").alias("n")))


def kneser_ney(counts: DataFrame) -> list[DataFrame]:
    """Orders ORDER .. 1, each (key, logp, loggamma): the log probability of each n-gram seen, and the
    log weight that its order leaves to the one below where ``key`` is the context (null if not)."""
    lang = F.shiftrightunsigned("key", 40)
    tables = {ORDER: counts.select("key", F.col("n").alias("c"))}
    for k in range(ORDER - 1, 0, -1):
        body = F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        head = F.shiftleft(lang, 40)
        tables[k] = (tables[k + 1].groupBy((head + body).alias("key")).agg(F.count(F.lit(1)).alias("c")).checkpoint())
    prob, out = None, []
    for k in range(1, ORDER + 1):
        t = tables[k].withColumn("lang", lang).withColumn("ctx", F.shiftleft(lang, 40) + F.shiftrightunsigned(
            F.col("key").bitwiseAND(F.lit(BODY)), 8))
        n = [F.sum((F.col("c") == i).cast("double")) for i in (1, 2, 3, 4)]
        d = t.groupBy("lang").agg(*[x.alias(f"n{i + 1}") for i, x in enumerate(n)])
        y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))

        def disc(i, y=y):
            raw = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
            ok = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col(f"n{i}") > 0)
            return F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), F.when(ok, raw).otherwise(F.lit(0.5 * i))))
        d = d.select("lang", *[disc(i).alias(f"d{i}") for i in (1, 2, 3)])
        t = t.join(d, "lang").withColumn("d", F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2"))
                                         .otherwise(F.col("d3")))
        ctx = t.groupBy("ctx").agg(F.sum("c").alias("tot"), F.sum("d").alias("left")).select(
            "ctx", "tot", (F.col("left") / F.col("tot")).alias("gamma")).checkpoint()
        t = t.select("key", "c", "d", "ctx", (F.shiftleft("lang", 40) + F.col("key").bitwiseAND(
            F.lit((1 << (8 * (k - 1))) - 1))).alias("low")).join(ctx, "ctx")
        lower = F.lit(1.0 / 256)
        if prob is not None:
            t = t.join(prob.select(F.col("key").alias("low"), F.col("p").alias("plow")), "low")
            lower = F.col("plow")
        prob = t.select("key", ((F.col("c") - F.col("d")) / F.col("tot") + F.col("gamma") * lower).alias("p")).checkpoint()
        out.append((prob.select("key", F.log("p").alias("logp")), ctx.select(F.col("ctx").alias("key"), F.log("gamma").alias("loggamma"))))
    return out[::-1]


class HashArray:
    """Sorted mixed keys and their values; ``get`` gives (value, found) for many keys at once."""

    def __init__(self, key: np.ndarray, value: np.ndarray):
        h = mix(key.view(np.uint64))
        order = np.argsort(h)
        self.h, self.value = h[order], value[order].astype(np.float32)
        self.bits = max(1, int(np.ceil(np.log2(len(h) + 2))))
        self.start = np.searchsorted(self.h >> np.uint64(64 - self.bits), np.arange((1 << self.bits) + 1)).astype(np.int32)

    def get(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = mix(key)
        value, found = np.zeros(len(h), np.float32), np.zeros(len(h), bool)
        if not len(self.h):
            return value, found
        top = (h >> np.uint64(64 - self.bits)).astype(np.int64)
        at, end = self.start[top], self.start[top + 1]
        todo = np.flatnonzero(at < end)
        at, end = at[todo], end[todo]
        while len(todo):
            same = self.h[at] == h[todo]
            value[todo[same]] = self.value[at[same]]
            found[todo[same]] = True
            on = ~same & (at + 1 < end)
            todo, at, end = todo[on], at[on] + 1, end[on]
        return value, found


def log_probs(key: np.ndarray, orders: list[tuple[HashArray, HashArray]]) -> np.ndarray:
    """Log probability of each n-gram: the longest order seen, with the weights of the longer ones."""
    total = np.zeros(len(key), np.float64)
    todo = np.arange(len(key))
    lang, body = key & ~np.uint64(BODY), key & np.uint64(BODY)
    for i, (grams, contexts) in enumerate(orders):
        k = ORDER - i
        now = lang[todo] | (body[todo] & np.uint64((1 << (8 * k)) - 1))
        value, found = grams.get(now)
        total[todo[found]] += value[found]
        todo, now = todo[~found], now[~found]
        if not len(todo):
            return total
        gamma, _ = contexts.get((now & ~np.uint64(BODY)) | ((now & np.uint64(BODY)) >> np.uint64(8)))
        total[todo] += gamma
    total[todo] += np.log(1 / 256)
    return total


def _per_row(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    run = np.concatenate([[0], np.cumsum(values)])
    return run[off[1:]] - run[off[:-1]]


def repeated_words(w: Words, k: int = 8) -> np.ndarray:
    """Per row, words inside a window of ``k`` words that stands twice or more in the row."""
    at, h = w.windows(w.hashes(), k)
    row = w.rows()
    h = h ^ mix(row[at].astype(np.uint64) + np.uint64(1))
    s = np.sort(h)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    cover = np.zeros(len(w.start) + 1, np.int64)
    if len(twice):
        place = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
        hits = at[twice[place] == h]
        np.add.at(cover, hits, 1)
        np.add.at(cover, hits + k, -1)
    return np.bincount(row[np.cumsum(cover)[:-1] > 0], minlength=len(w.n))


def repeated_lines(w: Words) -> np.ndarray:
    """Per row, lines (cut at line feeds) that hold a word and equal an earlier line of the row."""
    rows = len(w.n)
    if not w.data.size:
        return np.zeros(rows, np.int64)
    brk = w.data == 10
    opens = ~brk
    opens[1:] &= brk[:-1] | np.isin(np.arange(1, w.data.size), w.off)
    start = np.flatnonzero(opens)
    if not len(start):
        return np.zeros(rows, np.int64)
    at = np.zeros(w.data.size, np.int64)
    at[start] = start
    place = np.arange(w.data.size) - np.maximum.accumulate(at)
    h = np.add.reduceat(_ANY[w.data] * place_weights(place), start)
    size = np.add.reduceat((~brk).astype(np.int64), start)
    row = np.searchsorted(w.off, start, side="right") - 1
    held = np.diff(np.searchsorted(w.start, np.append(start, w.data.size))) > 0
    key = mix(h + size.astype(np.uint64) * _STEP[62]) ^ mix(row.astype(np.uint64) + np.uint64(7))
    distinct = np.unique(np.stack([row[held].astype(np.uint64), key[held]]), axis=1)[0].astype(np.int64)
    return np.bincount(row[held], minlength=rows) - np.bincount(distinct, minlength=rows)


BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def base_counts(w: Words) -> list[np.ndarray]:
    letter = ((w.data & 0xC0) != 0x80) & ~_SPACE[w.data]
    return [w.n, _per_row(letter, w.off), _per_row(SYMBOLS[w.data], w.off), repeated_lines(w), repeated_words(w)]


def _collect(table: DataFrame, value: str) -> HashArray:
    got = table.toArrow()
    return HashArray(got["key"].to_numpy().astype(np.int64), got[value].to_numpy())


def measure(docs: DataFrame, orders: list, broadcast_rows: int = 6_000_000, text: str = "text",
            lang: str = "lang", key: str = "doc_id") -> DataFrame:
    """doc key, lang, base counts and ``logppl`` (mean minus log probability of a byte; null for an
    empty text) of every row of ``docs``.

    Models of at most ``broadcast_rows`` n-grams (counted first) go to every task as hash arrays;
    a larger one stays a table and is joined with the n-grams of the documents.
    """
    size = sum(g.count() + c.count() for g, c in orders)
    schema = (f"`{key}` {docs.schema[key].dataType.simpleString()}, lang string, "
              + ", ".join(f"{c} long" for c in BASE))
    small = size <= broadcast_rows
    sent = None
    if small:
        arrays = [(_collect(g, "logp"), _collect(c, "loggamma")) for g, c in orders]
        sent = docs.sparkSession.sparkContext.broadcast(arrays)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            w = words(part.column(part.schema.get_field_index(text)))
            cols = [part.column(part.schema.get_field_index(key)),
                    part.column(part.schema.get_field_index(lang)).cast(pa.string())]
            cols += [pa.array(x.astype(np.int64)) for x in base_counts(w)]
            names = [key, "lang", *BASE]
            if small:
                logp = log_probs(gram_keys(w.data, w.off, _codes(part, lang)), sent.value)
                n = np.diff(w.off)
                mean = -_per_row(logp, w.off) / np.maximum(n, 1)
                cols.append(pa.array(mean, mask=n == 0))
                names.append("logppl")
            else:
                cols.append(part.column(part.schema.get_field_index("text_md5")))
                names.append("text_md5")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    slim = docs.select(key, text, F.col(lang).cast("string").alias(lang))
    if small:
        return slim.mapInArrow(run, schema + ", logppl double")
    slim = slim.withColumn("text_md5", F.md5(F.concat_ws("\x00", F.coalesce(F.col(lang), F.lit("\x01")), F.col(text))))
    means = _joined_means(slim, orders, text, lang)
    return slim.mapInArrow(run, schema + ", text_md5 string").join(means, "text_md5", "left").drop("text_md5")


def _joined_means(slim: DataFrame, orders: list, text: str, lang: str) -> DataFrame:
    """(text_md5, logppl) by joins with the model tables, order by order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, 1 << 20):
            w = words(part.column(part.schema.get_field_index(text)))
            keys = gram_keys(w.data, w.off, _codes(part, lang))
            ids = part.column(part.schema.get_field_index("text_md5"))
            for d in range(part.num_rows):
                key, n = np.unique(keys[w.off[d]:w.off[d + 1]], return_counts=True)
                if len(key):
                    yield pa.RecordBatch.from_arrays([pa.array([ids[d].as_py()] * len(key)), pa.array(key.view(np.int64)),
                                                      pa.array(n.astype(np.int64))], names=["text_md5", "key", "n"])

    left = (slim.dropDuplicates(["text_md5"]).mapInArrow(run, "text_md5 string, key long, n long")
            .withColumn("add", F.lit(0.0)))
    sums = []
    for i, (grams, contexts) in enumerate(orders):
        k = ORDER - i
        lang_bits = F.shiftleft(F.shiftrightunsigned("key", 40), 40)
        left = left.withColumn("key", lang_bits + F.col("key").bitwiseAND(F.lit((1 << (8 * k)) - 1)))
        seen = left.join(grams, "key", "left")
        sums.append(seen.where("logp is not null").select("text_md5", "n", (F.col("logp") + F.col("add")).alias("lp")))
        ctx = contexts.select(F.col("key").alias("ctx"), "loggamma")
        left = (seen.where("logp is null")
                .withColumn("ctx", lang_bits + F.shiftrightunsigned(F.col("key").bitwiseAND(F.lit(BODY)), 8))
                .join(ctx, "ctx", "left")
                .select("text_md5", "key", "n", (F.col("add") + F.coalesce("loggamma", F.lit(0.0))).alias("add")))
    sums.append(left.select("text_md5", "n", (F.col("add") + F.lit(float(np.log(1 / 256)))).alias("lp")))
    every = sums[0]
    for s in sums[1:]:
        every = every.unionByName(s)
    return every.groupBy("text_md5").agg((-F.sum(F.col("lp") * F.col("n")) / F.sum("n")).alias("logppl"))


def bands(measured: DataFrame, reach: float = 2.5, least: float = 0.002) -> DataFrame:
    """(lang, low, high): quartiles of log perplexity, widened by ``reach`` times their distance
    (``least``, two steps of the histogram, at the smallest). Quartiles are read off a histogram of steps of 0.001, so they do not
    depend on the order of the rows."""
    hist = (measured.where("logppl is not null and not base_failed")
            .groupBy("lang", F.floor(F.col("logppl") * 1000).alias("b")).agg(F.count(F.lit(1)).alias("n")))
    run = Window.partitionBy("lang").orderBy("b")
    all_ = Window.partitionBy("lang")
    upto = hist.withColumn("u", F.sum("n").over(run)).withColumn("t", F.sum("n").over(all_))
    q = upto.groupBy("lang").agg(
        (F.min(F.when(F.col("u") >= 0.25 * F.col("t"), F.col("b"))) / 1000).alias("q1"),
        (F.min(F.when(F.col("u") >= 0.75 * F.col("t"), F.col("b"))) / 1000).alias("q3"))
    wide = F.greatest((F.col("q3") - F.col("q1")) * reach, F.lit(least))
    return q.select("lang", (F.col("q1") - wide).alias("low"), (F.col("q3") + wide).alias("high"))


def perplexity_report(docs: DataFrame, broadcast_rows: int = 6_000_000) -> DataFrame:
    """doc_id, base counts, base_failed, logppl, low, high, kept for every row of ``docs``.

    Null and empty texts have no words and fail the base rules. Repeated rows count as often as they
    stand. A language whose documents all fail has no band and keeps nothing.
    """
    counts = count_grams(docs).checkpoint()
    orders = kneser_ney(counts)
    seen = measure(docs, orders, broadcast_rows)
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    seen = seen.withColumn("base_failed", failed).checkpoint()
    band = bands(seen)
    joined = seen.join(band, F.equal_null(seen["lang"], band["lang"]), "left").drop(band["lang"])
    inside = F.col("logppl").between(F.col("low"), F.col("high"))
    return joined.select("doc_id", *BASE, "base_failed",
                         (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
                         "logppl", "low", "high")
