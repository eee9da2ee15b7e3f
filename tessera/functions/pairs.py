"""Counting of word pairs inside tasks, on Arrow arrays: Spark deals the lines, shuffles and sorts what a run of lines
holds, and deals it again. Nothing here sees more than a bounded run of lines or of sorted rows.

A bounded number of words, the most frequent ones, have codes that all tasks share (``Known``); all other words are compared
as words. A pair of two known words x < y is a number (``Known.key``), the numbers are cut into tiles, and a row of the
exchange is what a run holds of a tile: the steps from each pair's number to the next one's, a byte or two a pair. Any other
pair is a partner of its word that is not known (of two such words, of the later one): a row is such a word ``x`` with the
steps between its known partners' codes, and the bytes, lengths and counts of its others. Without known words, a partner's
piece is ``crc32(y) mod PIECES``, so that the partners of a very common word are several tasks'.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECES = 4
PAIRS = 1 << 22  # pairs of a run of lines; the known ones among them are held over several runs
HELD = 3  # runs, a little less as they exceed their size
PART = 4  # parts of a run that are worked on at a time; entries of a run of sorted rows are one part
BYTES = 1 << 25  # of one Arrow column handed over
ROWS = 1 << 17  # of one Arrow batch handed over
WORDS = 1 << 17  # known words at most
TILES = 1 << 10  # of about as many pairs each, besides those cut for their width
LOAD = 1 << 20  # pairs of a tile, while there are fewer than TILES
WIDTH = 1 << 23  # numbers of a tile at most: it can be summed in an array
SLOTS = 1 << 24  # bits that tell which of the other words may take part

EXCHANGE = "x string, piece int, y binary, size binary, n binary, codes binary, more binary"


class Known:
    """The words that have codes, the most frequent one first, with the tiles of their pairs.

    ``slots``, if given, holds (in bytes, their lowest bit first) the bit ``crc32(word) mod SLOTS`` of every other word that takes part;
    words without it are left out."""

    def __init__(self, words: pa.Array, n_lines: np.ndarray, slots: np.ndarray | None = None):
        size = len(words)
        self.words, self.n_lines, self.slots = words, n_lines, slots
        self.others = slots is None or bool(slots.any())  # whether any other word takes part
        x = np.arange(size, dtype=np.int64)
        self.start = x * (2 * size - x - 1) // 2  # number of the first pair of a word with a later one
        self.shift = self.start - x - 1  # from the code of y to the number of the pair
        self.order = np.empty(size, np.int64)  # place of a word in the order of the words' bytes
        self.order[pc.sort_indices(words).to_numpy()] = x
        total = size * (size - 1) // 2
        self.edges = np.append(_tiles(n_lines.astype(float), self.start, total), total)

    def pair(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = np.searchsorted(self.start, key, side="right") - 1
        return x, key - self.shift[x]


def _tiles(n: np.ndarray, start: np.ndarray, total: int) -> np.ndarray:
    """First numbers of the tiles: cut where words that stood independently in lines would have equally many pairs."""
    if not total:
        return np.zeros(0, np.int64)
    upto = np.cumsum(n)
    before = np.concatenate([[0], np.cumsum(n * (upto[-1] - upto))])
    many = int(np.clip(16 * upto[-1] / LOAD, 1, TILES))
    goal = before[-1] * np.arange(1, many) / many
    x = np.clip(np.searchsorted(before, goal, side="right") - 1, 0, len(n) - 1)
    y = np.clip(np.searchsorted(upto, upto[x] + (goal - before[x]) / n[x]), x + 1, len(n))
    cut = np.concatenate([np.arange(0, total, WIDTH), start[x] + y - x - 1])
    return np.unique(cut[cut < total])


NOTHING = Known(pa.array([], pa.string()), np.zeros(0))


def _pieces(lens: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours whose sizes sum to about ``limit``, one at least."""
    total = np.concatenate([[0], np.cumsum(lens)])
    a = 0
    while a < len(lens):
        b = max(a + 1, int(np.searchsorted(total, total[a] + limit, side="right")) - 1)
        yield a, b
        a = b


def _upto(values: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(values, dtype=np.int64)])


def _packed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, all but a number's last marked -> (bytes, where each number begins, and the end)."""
    size = np.ones(len(values), np.int8)
    left = values >> 7
    while left.any():
        size += left > 0
        left >>= 7
    begin = _upto(size)
    out, at = np.empty(begin[-1], np.uint8), begin[:-1]
    while len(at):
        on = values > 127
        out[at] = (values & 127) | (on << 7)
        at, values = at[on] + 1, values[on] >> 7
    return out, begin


def _unpacked(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """-> (numbers, place of each number's last byte)."""
    last = np.flatnonzero(data < 128)
    begin = np.concatenate([[0], last[:-1] + 1])[:len(last)]
    values, size, k = (data[begin] & 127).astype(np.int64), last - begin, 1
    on = np.flatnonzero(size)
    while len(on):
        values[on] |= (data[begin[on] + k] & 127).astype(np.int64) << (7 * k)
        k += 1
        on = on[size[on] >= k]
    return values, last


def _distinct(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted numbers -> (each once, how often)."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])[:len(key)])
    return key[first], np.diff(np.append(first, len(key)))


def _by_size(codes: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Lines of equally many words (two or more), a bounded number at a time, each with its codes sorted -> (places of the lines, codes)."""
    begin = np.cumsum(size) - size
    for k in np.unique(size[size > 1]).tolist():
        every, step = np.flatnonzero(size == k), max(1, PAIRS // PART // k ** 2)
        for at in (every[i:i + step] for i in range(0, len(every), step)):
            yield at, np.sort(codes[begin[at][:, None] + np.arange(k)], axis=1)


class _Numbers:
    """Numbers of the pairs of known words, held until there are too many."""

    def __init__(self, known: Known):
        self.known, self.held, self.used = known, np.empty(HELD * PAIRS, np.int64), 0

    def add(self, codes: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        pairs = int((size * (size - 1) // 2).sum())
        if self.used + pairs > len(self.held):
            yield from self.rows()
        if pairs > len(self.held):
            self.held = np.empty(pairs, np.int64)
        for _, lines in _by_size(codes, size):
            i, j = np.triu_indices(lines.shape[1], 1)
            out = self.held[self.used:self.used + len(lines) * len(i)].reshape(len(lines), len(i))
            np.add(self.known.shift[lines][:, i], lines[:, j], out=out)
            self.used += out.size

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.held[:self.used].sort()
        yield from _tile_rows(self.held[:self.used], self.known)
        self.used = 0


def _other_pairs(codes: np.ndarray, size: np.ndarray, others: np.ndarray, known: int, every: int) -> np.ndarray:
    """(later word - known) * every + earlier word of the pairs whose later word is not known, sorted; ``others`` such words a line."""
    found = [np.zeros(0, np.int64)]
    some = others > 0
    codes, size, others = codes[np.repeat(some, size)], size[some], others[some]
    for at, lines in _by_size(codes, size):
        i, j = np.triu_indices(lines.shape[1], 1)
        may = j >= lines.shape[1] - others[at].max()
        a, b = lines[:, i[may]], lines[:, j[may]]
        mine = b >= known
        found.append((b[mine].astype(np.int64) - known) * every + a[mine])
    key = np.concatenate(found)
    key.sort()
    return key


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Values that follow each other in ``data``, cut at ``ends`` (in elements)."""
    own = np.ascontiguousarray(data[ends[0]:ends[-1]])
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(((ends - ends[0]) * data.itemsize).astype(np.int32)), pa.py_buffer(own)])


def _steps(values: np.ndarray, n: np.ndarray, cut: np.ndarray, first: np.ndarray) -> tuple[tuple, tuple]:
    """Ascending numbers, cut into rows (whose first step is from ``first``), and their counts -> for the columns ``codes`` and ``more``,
    (bytes, where each row begins, and the end). A step's lowest bit says that its count is above 1 and told in ``more``."""
    step = np.diff(values, prepend=0)
    row = cut[:-1] < cut[1:]
    step[cut[:-1][row]] = values[cut[:-1][row]] - first[row]
    several = n > 1
    codes, at = _packed(step << 1 | several)
    more, more_at = _packed(n[several] - 2)
    return (codes, at[cut]), (more, more_at[_upto(several)[cut]])


def _send(lists: pa.Array, known: Known, numbers: _Numbers) -> Iterator[pa.RecordBatch]:
    """The distinct pairs of some lines (each a list of distinct words), as rows of the exchange; ``numbers`` holds those of known words."""
    flat = pc.dictionary_encode(lists.flatten())
    words, k = flat.dictionary, len(known.words)
    size = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    code = pc.fill_null(pc.index_in(words, value_set=known.words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    other = np.flatnonzero(code < 0)
    crc = np.fromiter((zlib.crc32(w) for w in words.take(pa.array(other)).cast(pa.binary()).to_pylist()), np.int64, len(other))
    if known.slots is not None:
        may = (known.slots[crc % SLOTS // 8] >> (crc % 8).astype(np.uint8) & 1) == 1
        other, crc = other[may], crc[may]
    rank = np.empty(len(other), np.int64)
    rank[pc.sort_indices(words.take(pa.array(other))).to_numpy()] = np.arange(len(other))  # in the order of the words' bytes
    piece = crc % PIECES if not k else np.zeros(len(other), np.int64)
    ordered = np.lexsort([rank, piece])
    names, piece = words.take(pa.array(other[ordered])), piece[ordered]
    code[other[ordered]] = k + np.arange(len(other))
    codes = code.astype(np.int32)[flat.indices.to_numpy()]
    line = np.repeat(np.arange(len(size), dtype=np.int32), size)
    if known.slots is not None:
        codes, line = codes[codes >= 0], line[codes >= 0]
        size = np.bincount(line, minlength=len(size))
    own = codes < k
    n_own = np.bincount(line[own], minlength=len(size))
    yield from numbers.add(codes[own], n_own)
    key, n = _distinct(_other_pairs(codes, size, size - n_own, k, k + len(names)))
    if len(key):
        yield from _word_rows(*np.divmod(key, k + len(names)), n, names, piece, k)


def _tile_rows(key: np.ndarray, known: Known) -> Iterator[pa.RecordBatch]:
    cut = np.searchsorted(key, known.edges)
    tile = np.flatnonzero(cut[1:] > cut[:-1])
    cut = np.append(cut[tile], len(key))
    for a, b in _pieces(np.diff(cut), PAIRS // PART):
        first = known.edges[tile[a:b]]
        found, n = _distinct(key[cut[a]:cut[b]])
        columns = _steps(found, n, np.append(np.searchsorted(found, first), len(found)), first)
        none = pa.array([b""] * (b - a), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.nulls(b - a, pa.string()), pa.array(tile[a:b].astype(np.int32)), none, none, none,
                                          *[_binary(*c) for c in columns]], names=["x", "piece", "y", "size", "n", "codes", "more"])


def _word_rows(x: np.ndarray, y: np.ndarray, n: np.ndarray, names: pa.Array, piece: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    word = y >= k
    part = np.zeros(len(y), np.int64)
    part[word] = piece[y[word] - k]
    start = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (part[1:] != part[:-1])]))
    cut = _upto(word)[np.append(start, len(x))]  # of the partners that are words
    codes, more = _steps(y[~word], n[~word], np.append(start, len(x)) - cut, np.zeros(len(start), np.int64))
    y, n = y[word] - k, n[word].astype(np.int32)
    ordered = names.cast(pa.binary())
    lens = pc.binary_length(ordered).to_numpy(zero_copy_only=False).astype(np.int32)
    ends, size = _upto(lens[y]), lens[y]
    for a, b in _pieces(np.diff(ends[cut]) + 8 * np.diff(cut) + np.diff(codes[1]) + np.diff(more[1]) + lens[x[start]], BYTES):
        own, at = slice(cut[a], cut[b]), cut[a:b + 1]
        data = _raw(ordered.take(pa.array(y[own])), np.uint8)[0]
        yield pa.RecordBatch.from_arrays([names.take(pa.array(x[start[a:b]])).cast(pa.string()), pa.array(part[start[a:b]].astype(np.int32)),
                                          _binary(data, ends[at] - ends[at[0]]), _binary(size, at), _binary(n, at),
                                          *[_binary(data, ends[a:b + 1]) for data, ends in (codes, more)]],
                                         names=["x", "piece", "y", "size", "n", "codes", "more"])


def send_pairs(batches: Iterator[pa.RecordBatch], known: Known = NOTHING) -> Iterator[pa.RecordBatch]:
    """Lines (a list of distinct words each) to rows of ``EXCHANGE``; pairs are counted over runs of lines first."""
    held, pairs, numbers = [], 0, _Numbers(known)
    for batch in batches:
        lists = batch.column(0)
        size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        lists, size = lists.filter(pa.array(size > 1)), size[size > 1]
        for a, b in _pieces(size * (size - 1) // 2, PAIRS // PART):
            held.append(lists.slice(a, b - a))
            pairs += int((size[a:b] * (size[a:b] - 1) // 2).sum())
            if pairs >= PAIRS:
                yield from _send(pa.concat_arrays(held), known, numbers)
                held, pairs = [], 0
    if held:
        yield from _send(pa.concat_arrays(held), known, numbers)
    yield from numbers.rows()


def _raw(c: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """Values of a binary column one after another -> (elements, where each row begins, and the end)."""
    off = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1].astype(np.int64) if len(c) else np.zeros(1, np.int64)
    data = np.zeros(0, kind) if c.buffers()[2] is None else np.frombuffer(c.buffers()[2], np.uint8)[off[0]:off[-1]].view(kind)
    return data, (off - off[0]) // data.itemsize


def _entries(codes: pa.Array, more: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What ``_steps`` wrote -> (numbers, counts, numbers of each row)."""
    data, off = _raw(codes, np.uint8)
    step, last = _unpacked(data)
    cut = np.searchsorted(last, off)
    n = np.ones(len(step), np.int64)
    n[(step & 1) == 1] = _unpacked(_raw(more, np.uint8)[0])[0] + 2
    value = _upto(step >> 1)
    held = np.diff(cut)
    return value[1:] - np.repeat(value[cut[:-1]], held), n, held


def _sums(key: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    found = pa.table({"k": key, "n": n}).group_by("k", use_threads=False).aggregate([("n", "sum")])
    key, n = found["k"].to_numpy(), found["n_sum"].to_numpy()
    return (key[n >= least], n[n >= least]) if least > 1 else (key, n)


def _out(heads: pa.Array, head: np.ndarray, partners: pa.Array, partner: np.ndarray, n: np.ndarray, both: bool) -> Iterator[pa.RecordBatch]:
    """Pairs by place in ``heads`` and ``partners`` -> (x, y, n), x the word of smaller bytes, or ``both`` ways."""
    lens = (pc.binary_length(heads).to_numpy(zero_copy_only=False)[head].astype(np.int64)
            + pc.binary_length(partners).to_numpy(zero_copy_only=False)[partner])
    for i in range(0, len(n), ROWS):
        for a, b in _pieces(lens[i:i + ROWS], BYTES):
            at = slice(i + a, i + b)
            one, two = (w.take(pa.array(p[at])).cast(pa.string()) for w, p in ((heads, head), (partners, partner)))
            count = pa.array(n[at])
            if both:
                yield pa.RecordBatch.from_arrays([two, one, count], names=["x", "y", "n"])
            else:
                later = pc.less(two, one)
                one, two = pc.if_else(later, two, one), pc.if_else(later, one, two)
            yield pa.RecordBatch.from_arrays([one, two, count], names=["x", "y", "n"])


class _Tile:
    """Sums of one tile: entries are held and sorted while they are few, else summed in an array."""

    def __init__(self, number: int, known: Known):
        self.number, self.known, self.held, self.entries, self.sums = number, known, [], 0, None
        self.width = int(known.edges[number + 1] - known.edges[number])

    def add(self, rows: pa.RecordBatch) -> None:
        key, n, held = _entries(rows.column("codes"), rows.column("more"))
        self.held.append((key, n, held))
        self.entries += len(key)
        if self.entries >= PAIRS // PART:
            self._sum()

    def _sum(self) -> None:
        if self.sums is None:
            self.sums = np.zeros(self.width, np.int64)
        for key, n, held in self.held:
            ends = np.cumsum(held)
            for a, b in zip(ends - held, ends):  # a row holds a pair once
                self.sums[key[a:b]] += n[a:b]
        self.held, self.entries = [], 0

    def pairs(self, least: int, both: bool, totals: bool) -> Iterator[pa.RecordBatch]:
        if self.sums is not None:
            self._sum()
            key = np.flatnonzero(self.sums >= least)
            n = self.sums[key]
        else:
            key, n = (np.concatenate([h[i] for h in self.held]) for i in (0, 1))
            ordered = np.argsort(key, kind="stable") if n.max() >> 40 else None
            if ordered is None:  # numbers below WIDTH and counts in one word each
                both_in_one = np.sort(key << 40 | n)
                key, n = both_in_one >> 40, both_in_one & ((1 << 40) - 1)
            else:
                key, n = key[ordered], n[ordered]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            key, n = key[first], np.add.reduceat(n, first)
            key, n = key[n >= least], n[n >= least]
        x, y = self.known.pair(key + self.known.edges[self.number])
        if not both:
            swap = self.known.order[y] < self.known.order[x]
            x, y = np.where(swap, y, x), np.where(swap, x, y)
        at = 0
        for b in _out(self.known.words, x, self.known.words, y, n, both):
            if totals:
                to = at + b.num_rows
                for name, c in (("n_x", x), ("n_y", y)):
                    b = b.append_column(name, pa.array(self.known.n_lines[c[at:to]]))
                at = to
            yield b


def _merge(rows: pa.Table, least: int, both: bool, known: Known) -> Iterator[pa.RecordBatch]:
    """Sums of neighbouring rows of one word and piece -> (x, y, n)."""
    x, piece = rows["x"].combine_chunks(), rows["piece"].to_numpy()
    y, size, n, codes, more = (rows[c].combine_chunks() for c in ("y", "size", "n", "codes", "more"))
    fresh = np.ones(len(x), bool)
    if len(x) > 1:
        same = pc.equal(x.slice(1), x.slice(0, len(x) - 1)).to_numpy(zero_copy_only=False)
        fresh[1:] = ~same | (piece[1:] != piece[:-1])
    run, heads = np.cumsum(fresh) - 1, x.filter(pa.array(fresh))
    lens, cut = _raw(size, np.int32)
    if len(lens):
        ends = _upto(lens)
        words = pa.Array.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(ends), pa.py_buffer(_raw(y, np.uint8)[0])])
        flat = pc.dictionary_encode(words)
        key, count = _sums(np.repeat(run, np.diff(cut)) * len(flat.dictionary) + flat.indices.to_numpy(),
                           _raw(n, np.int32)[0].astype(np.int64), least)
        yield from _out(heads, key // len(flat.dictionary), flat.dictionary.cast(pa.large_string()), key % len(flat.dictionary), count, both)
    partner, count, held = _entries(codes, more)
    if len(partner):
        key, count = _sums(np.repeat(run, held) * len(known.words) + partner, count, least)
        yield from _out(heads, key // len(known.words), known.words, key % len(known.words), count, both)


def _weights(rows) -> np.ndarray:
    """Entries of each row, long words counting for several."""
    def length(c):
        return pc.binary_length(rows.column(c)).to_numpy().astype(np.int64)
    return length("size") // 4 + length("y") // 16 + length("codes")


def merge_pairs(least: int, both: bool, known: Known = NOTHING, of: str = "all"):
    """Rows of ``EXCHANGE``, sorted by word and piece, to (x, y, n) of the pairs in ``least`` lines or more; with ``both``, (y, x, n) too.

    ``of`` "known" takes the pairs of two known words only, once, with the lines of either word: (x, y, n, n_x, n_y); "others" the rest."""
    totals = of == "known"
    assert not (both and totals)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, entries, most = None, [], 0, PAIRS // PART
        for batch in batches:
            for a, b in _pieces(_weights(batch), PAIRS // PART):
                rows = batch.slice(a, b - a)
                of_tile = rows.column("x").is_null().to_numpy(zero_copy_only=False)
                if of_tile.any():
                    own = rows.filter(pa.array(of_tile)) if of != "others" else rows.slice(0, 0)
                    number = own.column("piece").to_numpy()
                    cut = np.append(np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]])[:len(number)]), len(number))
                    for i, j in zip(cut[:-1], cut[1:]):
                        if tile is None or tile.number != number[i]:
                            if tile is not None:
                                yield from tile.pairs(least, both, totals)
                            tile = _Tile(int(number[i]), known)
                        tile.add(own.slice(i, j - i))
                    rows = rows.filter(pa.array(~of_tile))
                if not rows.num_rows or totals:
                    continue
                held.append(rows)
                entries += int(_weights(rows).sum())
                if entries < most:
                    continue
                rows = pa.Table.from_batches(held)
                x, piece = rows["x"], rows["piece"].to_numpy()
                last = rows.num_rows - 1  # the last word's piece may go on in the next batch
                differ = pc.or_(pc.not_equal(x, x[last]), pa.array(piece != piece[last])).to_numpy()
                keep = int(np.flatnonzero(differ)[-1]) + 1 if differ.any() else 0
                if keep:
                    yield from _merge(rows.slice(0, keep), least, both, known)
                    rows = rows.slice(keep)
                rows = rows.combine_chunks()
                held, entries = rows.to_batches(), int(_weights(rows).sum())
                most = max(PAIRS // PART, 2 * entries)
        if tile is not None:
            yield from tile.pairs(least, both, totals)
        if held:
            yield from _merge(pa.Table.from_batches(held), least, both, known)
    return work
