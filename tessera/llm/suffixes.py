"""Substring dedup by a hash-compared suffix sort, over the UTF-8 bytes of whole texts.

A byte goes when a ``WINDOW``-byte string that covers it also starts in a document of a smaller id. Only
suffixes that can recur are sorted, and they meet where equal ones must meet:

1. *Candidates.* Documents are dealt into chunks of about ``chunk_bytes``. A window's sign is the smallest
   hash of its ``GRAM``-byte grams, so equal windows have equal signs. A chunk sends its distinct signs, and a
   fingerprint of each text with the smallest id that holds it; a bucket of signs answers whether another chunk
   (or another document) has the sign, whether many chunks have it, and whether a smaller id holds the whole
   text. Copies of a smaller id take no further part: what they hold, that id holds too.
2. *Suffixes.* Neighbouring windows of one sign form a segment. A chunk sends each distinct segment under a
   recurring sign once, with the smallest id that holds it, to the bucket of the sign. The bucket sorts the
   suffixes of its segments by their first ``WINDOW`` bytes: those whose 16 leading bytes tie are merge sorted,
   and two suffixes are compared by their longest common extension, found by binary search over prefix
   polynomial hashes. Neighbours that compare as equal are checked byte by byte; after a collision the
   suffixes are sorted by the bytes themselves. The answer is a bit for each window: does a smaller id hold it?
3. *Removal.* A chunk covers the bytes of its confirmed windows.

Under a sign that ``hot`` chunks or more hold, segments are single windows dealt by their own hash, so that a
passage common to many documents does not bring all that surrounds it into one bucket. Hashes here only deal and
compare; equality is settled on bytes, but for whole texts, which are told by 128-bit fingerprints.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import free_name, mix, released, text_buffers

WINDOW, GRAM = 50, 24
LAST = np.iinfo(np.int64).max  # stands for a null id: no other id is larger

_RNG = np.random.default_rng(1303)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: np.uint64, n: int) -> np.ndarray:
    """The first ``n`` powers of ``base``; a process keeps the longest run that a chunk needed."""
    known = _POWERS.get(int(base))
    if known is None or len(known) < n:
        known = np.full(max(n, 2), base, np.uint64)
        known[0] = 1
        known = np.cumprod(known, dtype=np.uint64)
        if n <= 4 << 20:
            _POWERS[int(base)] = known
    return known[:n]


class Prefix:
    """Prefix polynomial hashes of a byte string; ``of(p, n)`` is the hash of ``n`` bytes from ``p``."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _powers(_BASE, len(data)), dtype=np.uint64, out=self.sums[1:])
        self.shift = _powers(_INVERSE, len(data) + 1)

    def of(self, p, n):
        return (self.sums[p + n] - self.sums[p]) * self.shift[p]

    def grams(self, n: int) -> np.ndarray:
        """Hash of the ``n`` bytes from each place."""
        if len(self.data) < n:
            return np.zeros(0, np.uint64)
        return (self.sums[n:] - self.sums[:-n]) * self.shift[:len(self.sums) - n]


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Smallest of each ``n`` neighbours."""
    if len(x) < n:
        return x[:0]
    step = 1
    while 2 * step <= n:
        x = np.minimum(x[:-step], x[step:])
        step *= 2
    return np.minimum(x[:len(x) - (n - step)], x[n - step:]) if n > step else x


# ---------------------------------------------------------------- the suffix sort

def _words(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that sorts as they do."""
    v = np.lib.stride_tricks.sliding_window_view(data, 8)[at]
    return np.ascontiguousarray(v).view(">u8").ravel().astype(np.uint64)


def compare(text: Prefix, a: np.ndarray, b: np.ndarray, known: int, depth: int) -> np.ndarray:
    """-1, 0 or 1: order of the suffixes at ``a`` and ``b`` by their first ``depth`` bytes, of which ``known`` agree.

    The longest common extension is found by binary search: two runs of equal length agree when their
    prefix hashes do, so a comparison takes a logarithm of ``depth`` steps."""
    out = np.zeros(len(a), np.int8)
    differ = np.flatnonzero(text.of(a, depth) != text.of(b, depth))
    a, b = a[differ], b[differ]
    ha, hb, sa, sb = text.sums[a], text.sums[b], text.shift[a], text.shift[b]
    low, high = np.full(len(a), known), np.full(len(a), depth - 1)  # low bytes agree; more than high do not
    for _ in range(int(depth - 1 - known).bit_length()):
        mid = (low + high + 1) >> 1
        same = (text.sums[a + mid] - ha) * sa == (text.sums[b + mid] - hb) * sb
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    out[differ] = np.where(text.data[a + low] < text.data[b + low], -1, 1)
    return out


def merge_sort(text: Prefix, at: np.ndarray, order: np.ndarray, group: np.ndarray, known: int, depth: int) -> np.ndarray:
    """``order`` (numbers into the places ``at``), each group of neighbours in it merge sorted by the first ``depth``
    bytes of their suffixes.

    ``group`` numbers the groups, whose members agree in ``known`` bytes. Runs of a width are merged in pairs: the
    rank of a suffix in the run beside its own is found by binary search with ``compare``, for all suffixes at once."""
    order = order.copy()
    first = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(order) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(order)))
    begin, count = np.repeat(first, size), np.repeat(size, size)
    width = 1
    active = np.flatnonzero(count > width)
    while len(active):
        place = active - begin[active]
        run = place // width
        other = begin[active] + (run ^ 1) * width  # first of the run beside
        stop = np.minimum(other + width, begin[active] + count[active])
        left = (run & 1) == 0
        low, high = other.copy(), np.maximum(stop, other)
        mine = order[active]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            mid = (low[open_] + high[open_]) >> 1
            c = compare(text, at[order[mid]], at[mine[open_]], known, depth)
            before = (c < 0) | ((c == 0) & ~left[open_])  # stable: of equals, those of the left run come first
            low[open_] = np.where(before, mid + 1, low[open_])
            high[open_] = np.where(before, high[open_], mid)
            open_ = open_[low[open_] < high[open_]]
        rank = np.where(stop > other, low - other, 0)
        order[begin[active] + (run & ~1) * width + place % width + rank] = mine
        width *= 2
        active = active[count[active] > width]
    return order


def _same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int, rows: int = 1 << 15) -> bool:
    """Whether ``depth`` bytes agree from each place of ``a`` and its one of ``b``."""
    view = np.lib.stride_tricks.sliding_window_view(data, depth)
    return all(np.array_equal(view[a[i:i + rows]], view[b[i:i + rows]]) for i in range(0, len(a), rows))


def suffix_classes(data: np.ndarray, at: np.ndarray, depth: int = WINDOW) -> np.ndarray:
    """For each suffix of ``at`` (``depth`` bytes at least follow each, 16 or more), the number of its class in
    sorted order: equal numbers for equal first ``depth`` bytes."""
    if not len(at):
        return np.zeros(0, np.int64)
    lead, more = _words(data, at), _words(data, at + 8)
    by = np.lexsort([more, lead])
    lead, more = lead[by], more[by]
    fresh = np.concatenate([[True], (lead[1:] != lead[:-1]) | (more[1:] != more[:-1])])
    group = np.cumsum(fresh) - 1
    some = np.flatnonzero(np.bincount(group)[group] > 1)
    text = Prefix(data)
    by[some] = merge_sort(text, at, by[some], group[some], 16, depth)
    pairs = np.flatnonzero(~fresh)
    a, b = at[by[pairs - 1]], at[by[pairs]]
    same = compare(text, a, b, 16, depth) == 0
    fresh[pairs] = ~same
    if not _same_bytes(data, a[same], b[same], depth):
        # Two hashes collided: sort by the bytes themselves.
        words = [_words(data, at + k) for k in [*range(0, depth - 8, 8), depth - 8]]
        by = np.lexsort(words[::-1])
        fresh[1:] = np.logical_or.reduce([w[by[1:]] != w[by[:-1]] for w in words])
    out = np.empty(len(at), np.int64)
    out[by] = np.cumsum(fresh) - 1
    return out


# ---------------------------------------------------------------- chunks

def _least(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, the smallest id of each, whether several ids hold it, and each input's place."""
    known, place = np.unique(keys, return_inverse=True)
    low, high = np.full(len(known), LAST), np.full(len(known), np.iinfo(np.int64).min)
    np.minimum.at(low, place, ids)
    np.maximum.at(high, place, ids)
    return known, low, low != high, place


def _expand(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, .. of each run of ``n``."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(int(n.sum())) if len(n) else start


class Chunk:
    """Texts of a chunk, their fingerprints, and the segments of those that no smaller id of the chunk holds whole."""

    def __init__(self, table: pa.Table, null_last: bool = True):
        self.data, self.off = text_buffers(table["__text"])
        keys = table["__key"].combine_chunks().cast(pa.int64())
        self.ids = keys.fill_null(LAST).to_numpy(zero_copy_only=False)
        null = keys.is_null().to_numpy(zero_copy_only=False)
        self.apart = np.zeros(len(null), bool) if null_last else null  # no id is smaller than theirs
        self.size = np.diff(self.off)
        raw, off = self.data.tobytes(), self.off.tolist()
        self.raw = raw
        print_ = b"".join(hashlib.blake2b(raw[a:b], digest_size=16).digest() for a, b in zip(off, off[1:]))
        two = np.frombuffer(print_, np.dtype([("a", "<u8"), ("b", "<u8")]))
        self.prints, self.print_low, _, self.print_of = _least(two, self.ids)
        self.copy = (self.size >= WINDOW) & (self.ids > self.print_low[self.print_of]) & ~self.apart
        self.alive = (self.size >= WINDOW) & ~self.copy & ~self.apart
        self._segments()

    def _segments(self) -> None:
        total = len(self.data)
        none = np.zeros(0, np.int64)
        self.start, self.n, self.doc, self.sign = none, none, none, np.zeros(0, np.uint64)
        if total < WINDOW:
            return
        # Windows that lie within a living document.
        room = np.zeros(total + 1, np.int8)
        live = np.flatnonzero(self.alive)
        room[self.off[live]] += 1
        room[self.off[live + 1] - WINDOW + 1] -= 1
        inside = np.cumsum(room[:-1], dtype=np.int8)[:total - WINDOW + 1].astype(bool)
        sign = _sliding_min(Prefix(self.data).grams(GRAM), WINDOW - GRAM + 1)
        new = inside.copy()
        new[1:] &= ~inside[:-1] | (sign[1:] != sign[:-1])
        self.start = np.flatnonzero(new)
        closes = inside.copy()
        closes[:-1] &= ~inside[1:] | new[1:]
        self.n = np.flatnonzero(closes) + 1 - self.start
        self.doc = np.searchsorted(self.off, self.start, side="right") - 1
        self.sign = mix(sign[self.start])  # one to one; the low bits of the hashes are poor


def _send(chunk: int, buckets: int, bucket: np.ndarray, columns: list) -> pa.Table:
    """One row for each bucket that gets something; ``columns``: functions from the numbers sent to bytes."""
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    used = np.flatnonzero(np.diff(ends))
    parts = [order[ends[b]:ends[b + 1]] for b in used.tolist()]
    return pa.table({"bucket": pa.array(used, pa.int64()), "chunk": pa.array([chunk] * len(used), pa.int64()),
                     **{f"x{i}": pa.array([f(p) for p in parts], pa.binary()) for i, f in enumerate(columns)}})


def _answers(table: pa.Table, kind: int, flags: list[np.ndarray], sizes: list[int]) -> pa.Table:
    cuts = np.cumsum(sizes)[:-1]
    cols = [[np.packbits(x).tobytes() for x in np.split(f, cuts)] for f in flags]
    cols += [[b""] * table.num_rows] * (2 - len(cols))
    return pa.table({"chunk": table["chunk"], "bucket": table["bucket"], "kind": pa.array([kind] * table.num_rows, pa.int32()),
                     **{f"bits{i}": pa.array(c, pa.binary()) for i, c in enumerate(cols)}})


def _read(replies: pa.Table, kind: int, buckets: int, bucket: np.ndarray, which: int = 0, n: np.ndarray | None = None) -> np.ndarray:
    """The bits of all buckets, in the order in which things were sent (``n`` bits for each, one if not given)."""
    size = np.ones(len(bucket), np.int64) if n is None else n
    begin = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros(int(begin[-1]), bool)
    order = np.argsort(bucket, kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k, b, bits in zip(replies["kind"].to_pylist(), replies["bucket"].to_pylist(), replies[f"bits{which}"].to_pylist()):
        if k == kind:
            mine = order[ends[b]:ends[b + 1]]
            at = _expand(begin[mine], size[mine])
            out[at] = np.unpackbits(np.frombuffer(bits, np.uint8), count=len(at)).astype(bool)
    return out


_SIGNS, _TEXTS, _WINDOWS = 1, 2, 3


def _of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes % np.uint64(buckets)).astype(np.int64)


def _signs(table: pa.Table, buckets: int, null_last: bool = True) -> pa.Table:
    """Message 1: distinct signs with whether several ids hold each; fingerprints with their smallest id."""
    c, chunk = Chunk(table, null_last), table["__chunk"][0].as_py()
    known, _, multi, _ = _least(c.sign, c.ids[c.doc])
    signs = _send(chunk, buckets, _of(known, buckets), [lambda p: known[p].tobytes(), lambda p: multi[p].tobytes()])
    texts = _send(chunk, buckets, _of(c.prints["a"], buckets), [lambda p: c.prints[p].tobytes(), lambda p: c.print_low[p].tobytes()])
    return pa.concat_tables([t.append_column("kind", pa.array([k] * t.num_rows, pa.int32())) for t, k in ((signs, _SIGNS), (texts, _TEXTS))])


def _answer_signs(table: pa.Table, hot: int) -> pa.Table:
    out = []
    kinds = table["kind"].to_numpy()
    for kind in (_SIGNS, _TEXTS):
        rows = table.filter(pa.array(kinds == kind))
        if not rows.num_rows:
            continue
        parts = [np.frombuffer(x, np.uint64 if kind == _SIGNS else np.dtype([("a", "<u8"), ("b", "<u8")])) for x in rows["x0"].to_pylist()]
        sizes = [len(p) for p in parts]
        if kind == _SIGNS:
            multi = np.concatenate([np.frombuffer(x, bool) for x in rows["x1"].to_pylist()])
            _, place, count = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            held = count[place]  # chunks that hold it: each sends a sign once
            out.append(_answers(rows, kind, [multi | (held > 1), held >= hot], sizes))
        else:
            low = np.concatenate([np.frombuffer(x, np.int64) for x in rows["x1"].to_pylist()])
            _, least, _, place = _least(np.concatenate(parts), low)
            out.append(_answers(rows, kind, [least[place] < low], sizes))
    return pa.concat_tables(out)


class Sent:
    """The distinct segments that a chunk sends, after the answers about its signs and texts."""

    def __init__(self, c: Chunk, replies: pa.Table, buckets: int):
        known, place = np.unique(c.sign, return_inverse=True)
        recurs = _read(replies, _SIGNS, buckets, _of(known, buckets))[place]
        hot = _read(replies, _SIGNS, buckets, _of(known, buckets), 1)[place]
        elsewhere = _read(replies, _TEXTS, buckets, _of(c.prints["a"], buckets))[c.print_of]
        self.copy = c.copy | (c.alive & elsewhere)  # a smaller id holds the whole text
        take = recurs & ~self.copy[c.doc]
        cold, warm = np.flatnonzero(take & ~hot), np.flatnonzero(take & hot)
        start = np.concatenate([c.start[cold], _expand(c.start[warm], c.n[warm])])
        self.start, self.id = start, c.ids[np.concatenate([c.doc[cold], np.repeat(c.doc[warm], c.n[warm])])]
        windows = np.concatenate([c.n[cold], np.ones(len(start) - len(cold), np.int64)])
        seen: dict[bytes, int] = {}
        self.which = np.array([seen.setdefault(c.raw[a:b], len(seen)) for a, b in
                               zip(start.tolist(), (start + windows + WINDOW - 1).tolist())], np.int64)
        self.texts = list(seen)
        self.low = np.full(len(seen), LAST)
        np.minimum.at(self.low, self.which, self.id)
        self.n = np.zeros(len(seen), np.int64)
        self.n[self.which] = windows
        sign = np.zeros(len(seen), np.uint64)
        sign[self.which[:len(cold)]] = c.sign[cold]
        if len(warm):
            alone = self.which[len(cold):]
            sign[alone] = mix(Prefix(c.data).of(start[len(cold):], WINDOW))
        self.windows, self.bucket = windows, _of(sign, buckets)


def _segments(table: pa.Table, replies: pa.Table, buckets: int, null_last: bool = True) -> pa.Table:
    """Message 2: distinct segments under recurring signs, their lengths and smallest ids."""
    if not table.num_rows:
        return _send(0, buckets, np.zeros(0, np.int64), [lambda p: b""] * 3)
    s = Sent(Chunk(table, null_last), replies, buckets)
    small = zstandard.ZstdCompressor(level=1).compress
    return _send(table["__chunk"][0].as_py(), buckets, s.bucket, [
        lambda p: small(b"".join([s.texts[i] for i in p.tolist()])), lambda p: small(s.n[p].astype(np.uint32).tobytes()),
        lambda p: small(s.low[p].tobytes())])


def _answer_segments(table: pa.Table) -> pa.Table:
    """For each window of each segment: does a smaller id hold it? Equal segments of several chunks are sorted once."""
    large = zstandard.ZstdDecompressor().decompress
    per_row = [np.frombuffer(large(x), np.uint32).astype(np.int64) for x in table["x1"].to_pylist()]
    ids = np.concatenate([np.frombuffer(large(x), np.int64) for x in table["x2"].to_pylist()])
    seen: dict[bytes, int] = {}
    which = np.empty(len(ids), np.int64)
    i = 0
    for x, n in zip(table["x0"].to_pylist(), per_row):
        raw, ends = large(x), np.cumsum(n + WINDOW - 1).tolist()
        for a, b in zip([0, *ends], ends):
            which[i] = seen.setdefault(raw[a:b], len(seen))
            i += 1
    low = np.full(len(seen), LAST)
    np.minimum.at(low, which, ids)
    data = np.frombuffer(b"".join(seen), np.uint8)
    n = np.fromiter(map(len, seen), np.int64, len(seen)) - (WINDOW - 1)
    del seen
    first = np.concatenate([[0], np.cumsum(n)[:-1]])  # of a segment's windows
    kind = suffix_classes(data, _expand(np.concatenate([[0], np.cumsum(n + WINDOW - 1)[:-1]]), n))
    least = np.full(int(kind.max()) + 1, LAST)
    np.minimum.at(least, kind, np.repeat(low, n))
    least = least[kind]
    sent = n[which]
    return _answers(table, _WINDOWS, [least[_expand(first[which], sent)] < np.repeat(ids, sent)], [int(x.sum()) for x in per_row])


def _remove(table: pa.Table, replies: pa.Table, buckets: int, keep: int, names: list[str], null_last: bool = True) -> pa.Table:
    c = Chunk(table, null_last)
    s = Sent(c, replies, buckets)
    bits = _read(replies, _WINDOWS, buckets, s.bucket, 0, s.n)
    begin = np.concatenate([[0], np.cumsum(s.n)[:-1]]).astype(np.int64) if len(s.n) else s.n
    gone = bits[_expand(begin[s.which], s.windows)] | np.repeat(s.id > s.low[s.which], s.windows)
    at = _expand(s.start, s.windows)[gone]
    total = len(c.data)
    edge = np.zeros(total + 1, np.int32)
    edge[at] += 1  # a place starts one window only
    edge[at + WINDOW] -= 1
    copies = np.flatnonzero(s.copy)
    edge[c.off[copies]] += 1
    np.add.at(edge, c.off[copies + 1], -1)
    out = np.cumsum(edge[:-1]) > 0
    held = np.concatenate([[0], np.cumsum(~out)])
    offsets = held[c.off]
    head = np.zeros(total + 1, bool)
    head[c.off] = True
    opens = out & head[:-1]
    opens[1:] |= out[1:] & ~out[:-1]
    closes = out & head[1:]
    closes[:-1] |= out[:-1] & ~out[1:]
    a, b = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    doc = np.searchsorted(c.off, a, side="right") - 1
    spans = pa.ListArray.from_arrays(
        pa.array(np.searchsorted(a, c.off), pa.int32()),
        pa.StructArray.from_arrays([pa.array(a - c.off[doc], pa.int64()), pa.array(b - c.off[doc], pa.int64())], ["start", "end"]))
    kept = pa.Array.from_buffers(pa.large_binary(), len(c.size), [None, pa.py_buffer(offsets.astype(np.int64).tobytes()),
                                                                  pa.py_buffer(c.data[~out].tobytes())]).cast(pa.binary())
    values = [table[f"__k{i}"] for i in range(keep)]
    values += [pa.array(c.size), pa.array(c.size - np.diff(offsets)), kept, spans]
    return pa.Table.from_arrays(values, names=names)


def remove_repeated_bytes(docs: DataFrame, keep: list[str] = ("doc_id",), key: str = "doc_id", text: str = "text",
                          chunk_bytes: int = 2 << 20, hot: int = 256, null_last: bool = True) -> DataFrame:
    """``keep`` columns of every row of ``docs``, n_bytes, n_removed, kept (binary: the bytes that stay) and removed
    (spans of byte places, end excluded).

    A null text is empty; a text shorter than the window keeps all. A null key counts as larger than any other or,
    without ``null_last``, is neither smaller nor larger than any, so that its row keeps all its bytes;
    rows of equal keys are never smaller than one another, so what only they share stays. Any columns of simple type
    may be kept; where one has the name of an added column, the added one is preceded by ``_``. The number of chunks
    follows the total of text bytes (one aggregation); a task holds some 60 times its longest text or chunk.
    """
    keep = list(keep)
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("b")).collect()[0]["b"]
    chunks = max(1, -(-int(total) // chunk_bytes))
    buckets = max(1, -(-chunks // 4))
    dealt = docs.select(F.pmod(F.xxhash64(key, text), F.lit(chunks)).alias("__chunk"), F.col(key).cast("long").alias("__key"),
                        F.col(text).alias("__text"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(keep)])
    added = [free_name(keep, c) for c in ("n_bytes", "n_removed", "kept", "removed")]
    inner = [f"__k{i}" for i in range(len(keep))] + added
    groups = dealt.groupBy("__chunk")
    answer = "chunk long, bucket long, kind int, bits0 binary, bits1 binary"
    first = (groups.applyInArrow(lambda t: released(lambda x: _signs(x, buckets, null_last), t), "bucket long, chunk long, x0 binary, x1 binary, kind int")
             .groupBy("bucket").applyInArrow(lambda t: released(lambda x: _answer_signs(x, hot), t), answer))
    second = (groups.cogroup(first.groupBy("chunk")).applyInArrow(
        lambda t, r: released(lambda x, y: _segments(x, y, buckets, null_last), t, r), "bucket long, chunk long, x0 binary, x1 binary, x2 binary")
        .groupBy("bucket").applyInArrow(lambda t: released(_answer_segments, t), answer))
    kinds = [docs.schema[c].dataType.simpleString() for c in keep] + ["long", "long", "binary", "array<struct<start: long, end: long>>"]
    out = groups.cogroup(first.unionByName(second).groupBy("chunk")).applyInArrow(
        lambda t, r: released(lambda x, y: _remove(x, y, buckets, len(keep), inner, null_last), t, r),
        ", ".join(f"`{n}` {k}" for n, k in zip(inner, kinds)))
    return out.toDF(*keep, *added)


def suffix_report(docs: DataFrame, null_last: bool = True) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every row of ``docs``."""
    out = remove_repeated_bytes(docs, null_last=null_last)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("long").alias("n_spans"),
                      F.sha2(F.col("kept"), 256).alias("kept_sha256"))
