"""Pairs of known words are numbers cut into tiles: equal to brute force for any number of known words, few bytes a pair."""

import collections
import itertools
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tessera.functions import pairs as P
from tessera.operators import cooc as C


def lines(n, seed, words=80, longest=40):
    rng = np.random.default_rng(seed)
    vocabulary = np.array(["", "a b", "é", "日本", "x" * 3000, "the"] + [f"w{i}" for i in range(words)], object)
    chance = 1 / np.arange(1, len(vocabulary) + 1)
    return [list(dict.fromkeys(rng.choice(vocabulary, rng.integers(0, longest), p=chance / chance.sum()).tolist())) for _ in range(n)]


def brute(rows):
    return collections.Counter(p for w in rows for p in itertools.combinations(sorted(w, key=str.encode), 2))


def mirrored(pairs):
    return pairs + collections.Counter({(y, x): n for (x, y), n in pairs.items()})


def known(data, size, slots=None):
    top = collections.Counter(w for line in data for w in line).most_common(size)
    return P.Known(pa.array([w for w, _ in top], pa.string()), np.array([n for _, n in top], np.int64), slots)


def batches(data, rows):
    return [pa.record_batch([pa.array([*data[i:i + rows], None], pa.list_(pa.string()))], names=["words"]) for i in range(0, len(data), rows)]


def counted(out):
    found = collections.Counter()
    for b in out:
        for x, y, n in zip(*[c.to_pylist() for c in b.columns]):
            assert (x, y) not in found  # a pair is summed once
            found[(x, y)] = n
    return found


def test_numbers_as_bytes():
    values = np.array([0, 1, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 35, (1 << 62) + 5], np.int64)
    data, begin = P._packed(values)
    assert begin.tolist() == [0, 1, 2, 3, 5, 7, 10, 13, 19, 28] and P._unpacked(data)[0].tolist() == values.tolist()
    assert len(P._unpacked(P._packed(values[:0])[0])[0]) == 0


def test_numbers_of_pairs():
    k = P.Known(pa.array([f"w{i}" for i in range(50)]), np.arange(50, 0, -1))
    x, y = np.triu_indices(50, 1)
    number = k.shift[x] + y
    assert number.tolist() == list(range(50 * 49 // 2))
    assert [v.tolist() for v in k.pair(number)] == [x.tolist(), y.tolist()]


@pytest.mark.parametrize("size", [0, 1, 2, 20, 1000])
@pytest.mark.parametrize("run,out,rows,width,load", [(1 << 23, 1 << 25, 1 << 17, 1 << 23, 1 << 20), (500, 1 << 25, 7, 300, 900), (40, 100, 3, 2, 50)])
def test_known_words_give_the_brute_force_counts(monkeypatch, size, run, out, rows, width, load):
    for name, value in (("PAIRS", run), ("BYTES", out), ("ROWS", rows), ("WIDTH", width), ("LOAD", load)):
        monkeypatch.setattr(P, name, value)
    data = lines(200, 8)
    k = known(data, size)
    assert np.all(np.diff(k.edges[:-1]) > 0) and np.all(np.diff(k.edges) <= width)
    sent = pa.Table.from_batches([b for part in (data[:90], data[90:]) for b in P.send_pairs(iter(batches(part, 40)), k)])
    sent = sent.sort_by([("x", "ascending"), ("piece", "ascending")])
    want = brute(data)
    for i in (1, 50):  # rows a batch
        assert counted(P.merge_pairs(1, False, k)(iter(sent.to_batches(i)))) == want
    assert counted(P.merge_pairs(3, False, k)(iter(sent.to_batches(50)))) == collections.Counter({p: n for p, n in want.items() if n >= 3})
    assert counted(P.merge_pairs(1, True, k)(iter(sent.to_batches(50)))) == mirrored(want)


def test_words_without_a_bit_are_left_out():
    data = lines(300, 9)
    top = {w for w, _ in collections.Counter(w for line in data for w in line).most_common(10)}
    slots, stay = np.zeros(P.SLOTS // 8, np.uint8), {"w40", "w41", "é"}
    for w in stay:
        slots[zlib.crc32(w.encode()) % P.SLOTS // 8] |= 1 << zlib.crc32(w.encode()) % 8
    k = known(data, 10, slots)
    sent = pa.Table.from_batches(list(P.send_pairs(iter(batches(data, 50)), k)))
    assert counted(P.merge_pairs(1, False, k)(iter(sent.to_batches()))) == brute([[w for w in line if w in top | stay] for line in data])


def test_a_pair_is_a_few_bytes():
    data = lines(4000, 10, words=3000)
    sent = list(P.send_pairs(iter(batches(data, 500)), known(data, 2000)))
    assert sum(c.nbytes for b in sent for c in b.columns) < 4 * len(brute(data))


@pytest.mark.parametrize("size", [0, 7, 30, 10_000])
def test_operators_with_few_known_words(spark, monkeypatch, size):
    monkeypatch.setattr(P, "WORDS", size)
    monkeypatch.setattr(P, "WIDTH", 100)
    data = lines(300, 11)
    words = spark.createDataFrame([(i, 0, w) for i, w in enumerate(data)] + [(300, 0, None), (301, 0, ["a", None, "b"])],
                                  "doc_id long, line_no int, words array<string>").repartition(5)
    want = mirrored(brute([*data, ["a", "b"]]))
    assert collections.Counter({(r.x, r.y): r.n for r in C.pair_count(words).collect()}) == want
    for least in (2, 10):
        pmi = C.pmi_pairs(words, least).collect()
        assert {(r.x, r.y): r.n for r in pmi} == {p: n for p, n in want.items() if n >= least} and len(pmi) == len({(r.x, r.y) for r in pmi})


def test_words_below_the_threshold_are_not_paired(spark, monkeypatch):
    monkeypatch.setattr(P, "WORDS", 5)
    data = lines(300, 12, words=2000)
    lf = C.line_frequency(spark.createDataFrame([(w,) for w in data], "words array<string>"))
    k = C._known(lf, 10)
    often = {w for w, n in collections.Counter(w for line in data for w in line).items() if n >= 10}
    sent = pa.Table.from_batches(list(P.send_pairs(iter(batches(data, 50)), k)))
    assert len(k.words) == 5 and {x for x in sent["x"].to_pylist() if x is not None} <= often


def test_stripes_deal_the_pairs_once(spark):
    data = lines(300, 13)
    words = spark.createDataFrame([(w,) for w in data], "words array<string>")
    plan = C.pmi_stripes(words, 10, min_partners=2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 2 and "Join" not in plan  # sent and merged once; every word's total came with its code
    count, pairs = collections.Counter(w for line in data for w in line), mirrored(brute(data))
    often = {p: n for p, n in pairs.items() if n >= 10}
    degree = collections.Counter(x for x, _ in often)
    got = {(r.x, r.y): (r.n, round(r.pmi, 9)) for r in C.stripes_long(C.pmi_stripes(words, 10, min_partners=2)).collect()}
    assert got == {(x, y): (n, round(float(np.log10(n * len(data) / (count[x] * count[y]))), 9)) for (x, y), n in often.items() if degree[x] >= 2}


@pytest.mark.parametrize("size", [0, 20, 1000])
def test_totals_come_with_known_words(size):
    data = lines(200, 14)
    k, count, want = known(data, size), collections.Counter(w for line in data for w in line), brute(data)
    sent = pa.Table.from_batches(list(P.send_pairs(iter(batches(data, 40)), k))).sort_by([("x", "ascending"), ("piece", "ascending")])
    own = list(P.merge_pairs(3, False, k, "known")(iter(sent.to_batches(20))))
    rest = counted(P.merge_pairs(3, False, k, "others")(iter(sent.to_batches(20))))
    top, found = set(k.words.to_pylist()), {}
    for b in own:
        found |= {(r["x"], r["y"]): r["n"] for r in b.to_pylist()}
        assert all((r["n_x"], r["n_y"]) == (count[r["x"]], count[r["y"]]) for r in b.to_pylist())
    assert found == {p: n for p, n in want.items() if n >= 3 and top.issuperset(p)}
    assert rest == {p: n for p, n in want.items() if n >= 3 and not top.issuperset(p)}
