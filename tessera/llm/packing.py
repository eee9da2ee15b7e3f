"""Packing token sequences: bounded-space online best fit.

Each task keeps at most ``open_windows`` partly filled windows over its own rows. A document is
tokenised whole; full windows are cut off it as they come, and its rest goes to the open window where
it leaves the least room. When it fits none and all windows are open, the fullest is emitted. What is
still open when the rows end is merged at last: leftovers of many tasks meet in a few, and their
pieces are placed again, largest first. Memory of a task is bounded by its open windows and the longest
document.
"""

from __future__ import annotations

import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .blocks import give_back

END = 1  # the id that closes a document
_SPLIT = None
_TOKENIZERS: dict[str, "Encoder"] = {}


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Token ids of whole texts, with a memo of runs between ASCII white space.

    The tokenizer drops white space before it looks at words, so the ids of a text are those of its
    runs in order. Runs met before come from the memo (two generations of at most ``hold`` entries);
    new ones are encoded in one batch per call. A new run of Latin letters and closing marks takes the
    ids of its letters in lower case (the tokenizer folds case and parts letters from marks), so case
    and punctuation cost no second encoding.
    """

    def __init__(self, path: str, hold: int = 400_000):
        import os
        import re
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.tok, self.hold = Tokenizer.from_file(path), hold
        # The same vocabulary without folding and splitting, for runs that are folded and split already.
        self.word = Tokenizer.from_file(path)
        self.word.normalizer = normalizers.Sequence([])
        self.word.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.plain = re.compile(r"([A-Za-z\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u00FF]+)([.,!?;:%$&*#()]*)").fullmatch
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def shrink(self) -> None:
        """Keep the larger generation of the memo only; a task does so when its rows end."""
        self.young, self.old = max(self.young, self.old, key=len), {}

    def _learn(self, runs: list[str]) -> None:
        young = self.young
        if len(young) > self.hold:
            self.old, self.young = young, {}
            young = self.young
        new = []
        for r in runs:
            got = self.old.get(r)
            if got is None:
                new.append(r)
            else:
                young[r] = got
        whole, old, folded, other = [], self.old, {}, {}  # runs of two parts; parts to be folded, parts as they are
        for r in new:
            m = self.plain(r)
            if m is None:
                other[r] = None
                continue
            word, marks = m.groups()
            word = word.lower()
            if word not in young:
                got = old.get(word)
                if got is None:
                    folded[word] = None
                else:
                    young[word] = got
            if marks and marks not in young:
                got = old.get(marks)
                if got is None:
                    other[marks] = None
                else:
                    young[marks] = got
            if marks or word != r:
                whole.append((r, word, marks))
        for tok, some in ((self.word, folded), (self.tok, other)):
            some = list(some)
            for r, e in zip(some, tok.encode_batch_fast(some, add_special_tokens=False) if some else []):
                young[r] = _little(e.ids)
        for r, word, marks in whole:
            young[r] = young[word] + young[marks] if marks else young[word]

    def __call__(self, texts: list[str | None]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text, with END at the end."""
        end = np.array([END], "<u4").tobytes()
        split = [_runs(t) if t else [] for t in texts]
        for i in range(0, len(split), 64):
            group = split[i:i + 64]
            young = self.young
            missing = list(set().union(*group).difference(young))
            if missing:
                self._learn(missing)
                if self.young is not young:  # a new generation: what the group needs must be in it
                    young = self.young
                    more = list(set().union(*group).difference(young))
                    if more:
                        self._learn(more)
            for runs in group:
                yield b"".join(map(young.__getitem__, runs)) + end


def _little(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit numbers."""
    return np.array(ids, "<u4").tobytes() if sys.byteorder == "big" else array("I", ids).tobytes()


def _runs(text: str) -> list[str]:
    """Pieces between ASCII white space (``str.split`` also cuts at other characters, which the
    tokenizer may not drop, so it serves only for texts without them)."""
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    global _SPLIT
    if _SPLIT is None:
        import re
        _SPLIT = re.compile(r"[^\x20\x09-\x0D]+")
    return _SPLIT.findall(text)


def encoder(path: str) -> Encoder:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = Encoder(path)
    return _TOKENIZERS[path]


class OpenWindows:
    """At most ``limit`` open windows of ``size`` ids, kept in order of the room left."""

    def __init__(self, limit: int, size: int):
        self.limit, self.size = limit, size
        self.room: list[tuple[int, int]] = []   # (room left, window), sorted
        self.held: dict[int, list] = {}
        self.next = 0

    def place(self, length: int, piece) -> list | None:
        """Put a piece of fewer than ``size`` ids into the open window where it fits best. Returns the
        pieces of the window that this filled, or that was emitted to make place, if any."""
        out = None
        i = bisect_left(self.room, (length, -1))
        if i < len(self.room):
            room, win = self.room.pop(i)
        else:
            if len(self.room) >= self.limit:
                _, full = self.room.pop(0)
                out = self.held.pop(full)
            room, win = self.size, self.next
            self.next += 1
            self.held[win] = []
        self.held[win].append(piece)
        room -= length
        if room:
            insort(self.room, (room, win))
            return out
        return self.held.pop(win)  # full; a window opened just now never is

    def rest(self) -> list[list]:
        return [self.held[w] for _, w in sorted(self.room, key=lambda x: x[1])]


COLUMNS = ("start long, length long, ids_crc32 long, doc_tokens long, task long, seq long, "
           "offset long, open boolean")


def _pack_rows(docs: DataFrame, key: str, text: str, size: int, open_windows: int, path: str,
               with_ids: bool) -> DataFrame:
    """Pieces of the first pass; ``open`` marks those whose window was still open at the end."""
    key_type = docs.schema[key].dataType.simpleString()
    names = [key, "start", "length", "ids_crc32", "doc_tokens", "task", "seq", "offset", "open"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get().partitionId()
        enc, wins = encoder(path), OpenWindows(open_windows, size)
        rows: list[tuple] = []
        seq = 0

        def emit(pieces: list, is_open: bool = False) -> None:
            nonlocal seq
            at = 0
            for p in pieces:
                rows.append((*p[:5], task, seq, at, is_open, *p[5:]))
                at += p[2]
            seq += 1

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            kinds = [key_arrow, *[pa.int64()] * 7, pa.bool_()] + [pa.binary()] * with_ids
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)
            rows.clear()
            return out

        key_arrow = None
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(key))
            key_arrow = keys.type
            texts = batch.column(batch.schema.get_field_index(text))
            for i in range(0, batch.num_rows, 256):
                ks, ts = keys.slice(i, 256).to_pylist(), texts.slice(i, 256).to_pylist()
                for k, raw in zip(ks, enc(ts)):
                    total = len(raw) // 4
                    for s in range(0, total, size):
                        piece = raw[4 * s:4 * (s + size)]
                        n = len(piece) // 4
                        rec = (k, s, n, zlib.crc32(piece), total) + ((piece,) if with_ids else ())
                        if n == size:
                            emit([rec])
                            continue
                        done = wins.place(n, rec)
                        if done:
                            emit(done)
                if len(rows) >= 20_000 or with_ids and len(rows) >= 500:
                    yield flush()
        for pieces in wins.rest():
            emit(pieces, True)
        if rows:
            yield flush()
        enc.shrink()
        give_back()

    schema = f"`{key}` {key_type}, " + COLUMNS + (", ids binary" if with_ids else "")
    return docs.select(key, text).mapInArrow(run, schema)


def _merge_open(open_pieces: DataFrame, key: str, size: int, fan_in: int, with_ids: bool) -> DataFrame:
    """Place the pieces of leftover windows again: ``fan_in`` tasks' leftovers meet in one group
    (at most ``fan_in`` times the open windows), largest piece first into the best fit."""
    names = open_pieces.columns

    def run(table: pa.Table) -> pa.Table:
        rows = table.drop_columns(["group"]).to_pylist()
        rows.sort(key=lambda r: (-r["length"], r["task"], r["seq"], r["offset"]))
        wins, done = OpenWindows(len(rows) + 1, size), []
        for r in rows:
            full = wins.place(r["length"], r)
            if full:
                done.append(full)
        out = []
        group = table["group"][0].as_py()
        for seq, pieces in enumerate(done + wins.rest()):
            at = 0
            for r in pieces:
                out.append(r | {"task": -1 - group, "seq": seq, "offset": at, "open": False})
                at += r["length"]
        return pa.Table.from_pylist(out, schema=table.drop_columns(["group"]).schema)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in open_pieces.schema.fields)
    return (open_pieces.withColumn("group", F.floor(F.col("task") / fan_in).cast("long"))
            .groupBy("group").applyInArrow(run, schema).select(*names))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 2048, open_windows: int = 64,
         tokenizer: str | None = None, fan_in: int = 64, with_ids: bool = True) -> DataFrame:
    """Pieces of all rows of ``docs`` in sequences of at most ``size`` ids.

    Columns: the key, start (ids of the document before the piece), length, ids_crc32, doc_tokens,
    sequence_id, offset (in the sequence, gapless from 0) and, ``with_ids``, the ids as little-endian
    32-bit integers. A null or empty text is one piece that holds the closing id. Rows are packed as
    they come: repeated rows and null keys are rows like any other; other columns are not read. The
    first pass is written to the checkpoint folder, so that texts are tokenised once.
    """
    first = _pack_rows(docs, key, text, size, open_windows, tokenizer or default_tokenizer(), with_ids).checkpoint()
    merged = _merge_open(first.where("open"), key, size, fan_in, with_ids)
    every = first.where("not open").unionByName(merged)
    # Tasks of the first pass count up from 0 (even numbers), groups of the merge down from -1 (odd).
    half = F.when(F.col("task") >= 0, F.col("task") * 2).otherwise((-1 - F.col("task")) * 2 + 1)
    ident = F.shiftleft(half, 31) + F.col("seq")
    cols = [key, "start", "length", "ids_crc32", "doc_tokens", ident.alias("sequence_id"), "offset"]
    return every.select(*cols, *(["ids"] if with_ids else []))
