"""Word pairs counted inside tasks: equal to brute force over runs of any size, odd words, and few rows sent."""

import collections
import itertools

import numpy as np
import pyarrow as pa
import pytest

from tessera.functions import pairs as P
from tessera.operators import cooc as C


def lines(n, seed, words=60):
    rng = np.random.default_rng(seed)
    odd = ["", "a b", "é", "日本", "x" * 3000, "the"]
    vocabulary = odd + [f"w{i}" for i in range(words)]
    return [list(dict.fromkeys(rng.choice(vocabulary, rng.integers(0, 40)).tolist())) for _ in range(n)]


def brute(rows):
    return collections.Counter(p for w in rows for p in itertools.combinations(sorted(w, key=str.encode), 2))


def counted(batches):
    out = collections.Counter()
    for b in batches:
        for x, y, n in zip(*[c.to_pylist() for c in b.columns]):
            assert (x, y) not in out  # a pair is summed once
            out[(x, y)] = n
    return out


@pytest.mark.parametrize("run,size,rows", [(1 << 24, 1 << 25, 1 << 17), (500, 1 << 25, 7), (40, 100, 3)])
def test_runs_of_any_size_give_the_brute_force_counts(monkeypatch, run, size, rows):
    for name, value in (("PAIRS", run), ("BYTES", size), ("ROWS", rows)):
        monkeypatch.setattr(P, name, value)
    data = lines(300, 5)
    batches = [pa.record_batch([pa.array(data[i:i + 70] + [None], pa.list_(pa.string()))], names=["words"]) for i in range(0, 300, 70)]
    sent = [b for part in (batches[:2], batches[2:]) for b in P.send_pairs(iter(part))]
    table = pa.Table.from_batches(sent).sort_by([("x", "ascending"), ("piece", "ascending")])
    want = brute(data)
    for i in (1, 3, 1000):  # rows a batch
        assert counted(P.merge_pairs(1, False)(iter(table.to_batches(i)))) == want
    assert counted(P.merge_pairs(4, False)(iter(table.to_batches(50)))) == collections.Counter({p: n for p, n in want.items() if n >= 4})
    assert counted(P.merge_pairs(1, True)(iter(table.to_batches(50)))) == want + collections.Counter({(y, x): n for (x, y), n in want.items()})


def test_pairs_are_counted_before_they_are_rows():
    data = lines(2000, 6, words=500)
    batch = pa.record_batch([pa.array(data, pa.list_(pa.string()))], names=["words"])
    sent = sum(b.num_rows for b in P.send_pairs(iter([batch])))
    assert sent <= 506 * P.PIECES < len(brute(data)) / 20


def test_pair_count_over_tasks(spark):
    data = lines(400, 7)
    words = spark.createDataFrame([(i, 0, w) for i, w in enumerate(data)] + [(400, 0, None), (401, 0, ["a", None, "b"])],
                                  "doc_id long, line_no int, words array<string>").repartition(5)
    want = brute([*data, ["a", "b"]])
    want += collections.Counter({(y, x): n for (x, y), n in want.items()})
    assert collections.Counter({(r.x, r.y): r.n for r in C.pair_count(words).collect()}) == want
    assert C.pair_count(words.where("1 = 0")).count() == 0
