"""Chebyshev-filtered whitening against dense eigenvectors."""

import numpy as np
import pytest

from tessera.llm import whitening as W
from tessera.llm.queries import QUERIES
from table_paths import SF001

SCHEMA = "vec_id long, embedding array<float>, label int, deviation int, x string, whitened int"


def dense(vectors, k=16):
    """(n, sums, eigenvalues, components, trace) of the distinct quantised vectors."""
    x = np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1000000
    u = np.unique(x, axis=0)
    n, sums = len(u), u.sum(axis=0)
    c = (n * u - sums) / n
    values, q = np.linalg.eigh(c.T @ c / n)
    return x, n, sums, values[::-1][:k], q[:, ::-1][:, :k], float((c**2).sum() / n)


def check(spark, rows, k=16):
    """The report over ``rows`` equals dense results; up to sign, and within groups of equal eigenvalues by their projector."""
    df = spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA).repartition(3)
    got = W.whitening_report(df, k).collect()
    good = [(i, v) for i, v in rows if v and all(c is not None and np.isfinite(c) for c in v)]
    x, n, sums, values, q, trace = dense([v for _, v in good], k)
    wanted = int((values > 1e-12 * values[0]).sum())
    white = (n * x - sums) / n @ q[:, :wanted] / np.sqrt(values[:wanted])
    assert len(got) == len(good) * wanted
    assert {r["n"] for r in got} == {n} and max(r["identity_error"] for r in got) < 1e-10
    at = {i: j for j, (i, _) in enumerate(good)}
    sign = {}
    for r in got:
        j, c = at[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == sum(int(t) ** 2 for t in n * x[j] - sums)
        assert r["explained"] == pytest.approx(values[c] / trace, rel=1e-10)
        assert abs(r["whitened"]) == pytest.approx(abs(white[j, c]), abs=1e-8)
        if abs(white[j, c]) > 1e-6:
            assert sign.setdefault(c, np.sign(white[j, c] * r["whitened"])) == np.sign(white[j, c] * r["whitened"])


def test_flat_and_steep_spectra(spark):
    rng = np.random.default_rng(3)
    flat = rng.standard_normal((400, 60))
    check(spark, [(i, v.tolist()) for i, v in enumerate(flat)])
    steep = rng.standard_normal((300, 50)) * np.concatenate([[300, 40], np.linspace(3, 0.5, 48)]) + 7
    check(spark, [(i, v.tolist()) for i, v in enumerate(steep)])


def test_odd_vectors_and_repeats(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((80, 6)))]
    rows += [(100 + i, rows[3][1]) for i in range(60)] + [(3, rows[3][1])]
    odd = [(200, None), (201, []), (202, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (203, [float("nan")] * 6), (204, [float("inf")] + [0.0] * 5)]
    check(spark, rows + odd)
    got = W.whiten(W.quantised(spark.createDataFrame([(i, v, 0, 1, "x", 2) for i, v in rows], SCHEMA), name="q"),
                   W.fit_whitening(W.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).select("x").distinct()),
                   keep=["vec_id", "deviation", "whitened", "x"], x="q")
    assert got.columns == ["vec_id", "deviation", "whitened", "x", "_deviation", "_whitened"]
    assert all((r["deviation"], r["whitened"], r["x"], len(r["_whitened"])) == (1, 2, "x", 6) for r in got.collect())


def test_deficient_rank_one_vector_and_no_rows(spark):
    rng = np.random.default_rng(5)
    two = np.round(rng.standard_normal((50, 2)) * 4) @ np.round(rng.standard_normal((2, 40)) * 3)
    check(spark, [(i, v.tolist()) for i, v in enumerate(two)])
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    columns = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (None, [1.0, 2.0])]):
        got = W.whitening_report(make(rows))
        assert got.columns == columns and got.count() == 0
    # Another length than the commonest takes no part; a null id is kept.
    got = W.whitening_report(make([(1, [1.0, 2.0]), (None, [3.0, 1.0]), (3, [1.0, 2.0, 3.0]), (4, [1e30, 0.0])])).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"]) for r in got) == [(0, 1, 2), (1, 1, 2)]


def test_filter_damps_the_interval():
    values = np.linspace(1, 10, 40)
    out = W.chebyshev(lambda q: values[:, None] * q, np.eye(40), np.diag(values), 1.0, 8.0, 10.0, 12)
    size = np.abs(np.diag(out))
    assert size[-1] == pytest.approx(1) and size[values <= 8].max() < 1e-3 and (np.diff(size[values > 8]) > 0).all()


def test_certificate_is_demanded(spark):
    rows = [(v.tolist(),) for v in np.random.default_rng(6).integers(0, 99, (200, 60))]
    with pytest.raises(RuntimeError, match="residual"):
        W.fit_whitening(spark.createDataFrame(rows, "x array<long>"), max_rounds=1)


def test_query_runs(spark):
    got = QUERIES["op12_chebyshev_whitening"](spark, SF001)
    assert got.count() == 16 * 500
