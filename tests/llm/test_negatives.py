"""Hard negatives against brute force; the Hilbert curve against its definition."""

import itertools

import numpy as np
import pytest

from tessera.llm import negatives as N

SCHEMA = "vec_id long, embedding array<double>, label int, anchor int, block string, x int, rank int"


@pytest.mark.parametrize("dims,bits", [(1, 4), (2, 3), (3, 2), (4, 2)])
def test_hilbert_neighbours_touch(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    key = N.hilbert_key(cells, bits)
    assert sorted(key.tolist()) == list(range(len(cells)))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def brute(rows, every):
    good = [(i, [int(np.floor(256 * c)) for c in v], ((k + 1) % 10 if i is not None and i % 7 == 0 else k))
            for i, v, k in rows if k is not None and v and all(c is not None and np.isfinite(c) for c in v)]
    order = lambda s, i: (-s, N.LAST if i is None else i)
    out = []
    for a, (i, x, k) in enumerate(good):
        if i is None or i % every:
            continue
        scored = [(sum(p * q for p, q in zip(x, y)), j, m) for b, (j, y, m) in enumerate(good) if b != a]
        for p, j, _ in sorted((r for r in scored if r[2] == k), key=lambda r: order(*r[:2]))[:5]:
            fits = [r for r in scored if r[2] != k and 80 * p <= 100 * r[0] <= 100 * p]
            out += [(i, j, n + 1, r[1], p, r[0]) for n, r in enumerate(sorted(fits, key=lambda r: order(*r[:2]))[:5])]
    return sorted(out, key=str)


def mined(spark, rows, every, **kw):
    df = spark.createDataFrame([(i, v, k, 1, "b", 2, 3) for i, v, k in rows], SCHEMA).repartition(3)
    return N.mine(df, every, **kw)


def cloud(n, d, groups, seed, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal((groups, d)) * 2
    return [(i, (centre[i % groups] + rng.standard_normal(d) * 0.2).tolist(), int(rng.integers(labels))) for i in range(n)]


def test_equal_to_brute_force_on_a_flat_cloud(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.standard_normal(12) * 0.3).tolist(), int(rng.integers(10))) for i in range(500)]
    got = mined(spark, rows, 10, block_rows=32).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 10)
    assert len(got) > 500


def test_zone_maps_leave_blocks_out_of_clustered_vectors(spark):
    rows = cloud(900, 8, 12, 2)
    counts = []
    got = mined(spark, rows, 15, block_rows=16, counts=counts).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows, 15)
    (near, of_near), (far, of_far) = counts
    assert 0 < near < 0.7 * of_near and 0 < far < 0.3 * of_far


def test_ties_repeats_nulls_and_clashing_names(spark):
    rows = cloud(120, 4, 3, 3, labels=2)
    hot = [1.0, 0.5, -0.25, 0.0]
    rows += [(i, hot, i % 2) for i in range(1000, 1300)] + [(1000, hot, 0), (1000, hot, 0), (None, hot, 0), (None, hot, 1), (700, [0.0] * 4, 1)]
    rows += [(2000, None, 1), (2100, [], 1), (2200, hot, None), (2300, [None, 1.0, 1.0, 1.0], 0), (2400, [float("nan")] * 4, 0),
             (2500, [float("-inf"), 0.0, 0.0, 0.0], 0)]
    got = mined(spark, rows, 20, block_rows=16, counts=[])
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, 20)


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-(1 << 20), 1 << 20, 6) + 0.5).tolist(), int(rng.integers(3))) for i in range(150)]
    assert sorted((tuple(r) for r in mined(spark, rows, 10, block_rows=16).collect()), key=str) == brute(rows, 10)


def test_few_rows_and_none(spark):
    assert mined(spark, [], 100).count() == 0
    assert mined(spark, [(100, None, 1)], 100).count() == 0
    assert mined(spark, [(100, [1.0, 1.0], 1)], 100).count() == 0
    rows = [(100, [1.0, 1.0], 1), (101, [1.0, 0.5], 1), (102, [0.5, 0.75], 2), (103, [0.1, 0.1], 3), (104, [9.0], 1)]
    assert sorted(tuple(r) for r in mined(spark, rows, 100).collect()) == brute(rows[:4], 100) == [(100, 101, 1, 102, 98304, 81920)]
