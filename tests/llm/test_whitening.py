"""Whitening beside dense algebra and exact sums in plain Python."""

import math

import numpy as np
import pytest

from voxledger.llm import whitening as wh


def spectra():
    out = {"falling": 10.0 ** -np.arange(20), "equal": np.ones(20), "half": np.r_[np.ones(10), np.zeros(10)], "close": 1 + 1e-9 * np.arange(20),
           "three equal": np.r_[5.0, 5, 5, np.linspace(1, 2, 17)], "one": np.array([3.0]), "two": np.array([2.0, 1.0])}
    return [pytest.param(np.array(e, float), id=name) for name, e in out.items()]


def turned(values, seed=1):
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values),) * 2))[0]
    a = (q * values) @ q.T
    return (a + a.T) / 2


@pytest.mark.parametrize("values", spectra())
def test_leading_components(values):
    a = turned(values) * 1e4
    value, vectors = wh.leading(a, 8)
    want = np.linalg.eigvalsh(a)[::-1][:8]
    want = want[want > 1e4 * values.max() * 1e-12]
    assert len(value) == len(want) and np.abs(value - want).max() < 1e-10 * values.max() * 1e4 / 1e3
    assert np.abs(vectors.T @ vectors - np.eye(len(value))).max() < 1e-13
    assert np.abs(a @ vectors - vectors * value).max() < 1e-13 * 1e4 * values.max()


@pytest.mark.parametrize("values", spectra())
def test_inertia_counts(values):
    a = turned(values, 2)
    for shift in (-1.0, 0.3, 0.77, 1.53, 4.0, 9.0):
        assert wh.inertia(a - shift * np.eye(len(a))) == ((values > shift).sum(), (values < shift).sum())
    assert wh.inertia(np.array([[0.0, 1], [1, 0]])) == (1, 1) and wh.inertia(np.zeros((3, 3))) == (0, 0)


def test_slices_count_every_eigenvalue():
    values = np.sort(np.random.default_rng(4).random(40))[::-1]
    a = turned(values)
    cut = wh.slices(a, 12, 0.0, 1.1)
    assert sum(n for *_, n in cut) >= 12
    for (lo, hi, n), above in zip(cut, [1.1, *[s[0] for s in cut]]):
        assert hi == above and n == ((values > lo) & (values <= hi)).sum()


def test_products_are_exact():
    y = np.random.default_rng(2).integers(-2**39, 2**39, (50, 5))
    got = wh.exact_products(y)
    for i in range(5):
        for j in range(5):
            assert got[i, j] == sum(int(a) * int(b) for a, b in zip(y[:, i], y[:, j]))


def brute(rows, k=8):
    """(x, S, n, deviation, eigenvalues) of the usable rows, by dense algebra."""
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in rows]
    n, s = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[a - b / n for a, b in zip(r, s)] for r in x])
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    return [sum((n * a - b)**2 for a, b in zip(r, s)) for r in x], e[::-1][:k], u[:, ::-1][:, :k], centred, np.trace(v)


def check(got, rows, ids, k=8):
    deviation, e, u, centred, trace = brute(rows, k)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(got) == len(rows) * len(e) and {r.component for r in got} == set(range(1, len(e) + 1))
    for i, want, c in zip(ids, deviation, centred):
        for j in range(len(e)):
            r = by[i, j + 1]
            assert r.n == len(rows) and r.deviation == want == int(r.deviation_exact)
            assert abs(r.explained - e[j] / trace) < 1e-10 and r.identity_error < 1e-9
            assert abs(abs(r.whitened) - abs(c @ u[:, j]) / math.sqrt(e[j])) < 1e-6


def test_rows_dropped_and_kept(spark):
    rng = np.random.default_rng(7)
    good = [[float(np.float32(c)) for c in rng.standard_normal(6) * (k + 1 + np.arange(6))] for k in range(40)]
    bad = [None, [], [1.0, None, 2.0, 3.0, 4.0, 5.0], [float("nan")] + [0.0] * 5, [float("inf")] * 6, [1.0, 2.0], [1e30] * 6]
    rows = [(k, v, "a", "b") for k, v in enumerate(good + bad)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<float>, component string, n string").repartition(5)
    check(wh.whiten(docs).collect(), good, range(40), 6)


def test_repeated_rows_and_null_ids(spark):
    rng = np.random.default_rng(8)
    good = [[float(np.float32(c)) for c in rng.standard_normal(3)] for _ in range(9)]
    rows = [(k if k else None, v) for k, v in enumerate(good)] + [(3, good[3]), (3, good[4])]
    got = wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    assert len(got) == 33 and sum(r.vec_id == 3 for r in got) == 9 and sum(r.vec_id is None for r in got) == 3
    assert {r.n for r in got} == {11}


def test_nothing_to_whiten(spark):
    kind = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        out = wh.whiten(spark.createDataFrame(rows, kind))
        assert out.count() == 0 and out.columns[:2] == ["vec_id", "component"]
    line = wh.whiten(spark.createDataFrame([(k, [float(k), 2.0 * k, 1.0]) for k in range(5)], kind)).collect()
    assert {r.component for r in line} == {1} and len(line) == 5  # rank one


def test_deviation_beyond_long(spark):
    rows = [(k, [1e8 * (k - 2), 0.0]) for k in range(5)]
    got = {r.vec_id: r for r in wh.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got[0].deviation is None and int(got[0].deviation_exact) == (5 * 1024 * 2 * 10**8)**2
    assert got[2].deviation == 0


def test_query_equals_dense_algebra(spark, sf, table_of):
    from voxledger.llm.catalog import QUERIES

    rows = table_of("embeddings").collect()
    check(QUERIES["op12_embedding_whitening"](spark, sf).collect(), [list(r.embedding) for r in rows], [r.vec_id for r in rows])
