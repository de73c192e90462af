"""Whitening against an eigen-decomposition of the covariance of all distinct vectors."""

import math

import numpy as np
import pytest

from threadloom.llm import whitening as W

TYPES = "vec_id long, embedding array<float>"


def plain(rows, components=16):
    """Per sound row: id, deviation and whitened values; and the shares of variance. Signs as they come."""
    sound = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    xs = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in sound]
    once = np.array(sorted(set(map(tuple, xs))))
    n, sums = len(once), [int(c) for c in once.sum(axis=0)]
    far = n * np.array(xs, object) - np.array(sums, object)
    deviation = [sum(int(e) ** 2 for e in row) for row in far]
    centred = (n * once - np.array(sums)) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return [i for i, _ in sound], n, deviation, far.astype(float) / n @ axes / np.sqrt(values), values / np.trace(centred.T @ centred / n)


def check(spark, rows, components=16, types=TYPES):
    df = spark.createDataFrame(rows, types).repartition(5)
    got = {}
    for r in W.whiten(df, components=components).collect():
        got.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    ids, n, deviation, white, explained = plain(rows, components)
    assert set(got) == set(ids)
    signs = np.sign([got[ids[0]][k + 1][0].whitened * white[0][k] for k in range(white.shape[1])])
    for i, doc in enumerate(ids):
        assert sorted(got[doc]) == list(range(1, white.shape[1] + 1))
        for k in range(white.shape[1]):
            for r in got[doc][k + 1]:
                assert r.n == n and r.deviation == (deviation[i] if deviation[i] < 2**63 else None) and r.identity_error < 1e-6
                assert r.whitened == pytest.approx(signs[k] * white[i][k], rel=1e-7, abs=1e-7)
                assert r.explained == pytest.approx(explained[k], rel=1e-9)
    return got


def vectors(seed, n, d, spread):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n, d)) * spread @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    return [(i, [float(c) for c in v]) for i, v in enumerate(base + rng.normal(size=d))]


def test_against_eigenvectors(spark):
    rows = vectors(1, 400, 20, np.linspace(9, 0.5, 20))
    rows += [(400, None), (401, [float("nan")] * 20), (402, [float("inf")] + [0.0] * 19), (403, [None] + [0.0] * 19), (404, [])]
    check(spark, rows + [(i, rows[7][1]) for i in range(500, 530)])


def test_badly_conditioned(spark):
    check(spark, vectors(2, 300, 8, np.array([1e5, 3e4, 900, 400, 100, 30, 10, 4])), components=8)


def test_fewer_vectors_than_dimensions(spark):
    rows = vectors(3, 4, 10, np.linspace(5, 1, 10))
    df = spark.createDataFrame(rows + [(9, rows[0][1])], TYPES)
    got = W.whiten(df).collect()
    assert {r.component for r in got} == {1, 2, 3} and len(got) == 15 and got[0].identity_error < 1e-6


def test_tree_of_sums(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN_IN", 2)
    check(spark, vectors(4, 200, 6, np.linspace(3, 1, 6)), components=6)


def test_large_numbers_stay_exact(spark):
    got = check(spark, [(i, [1e9 * (i + 1), -2e9 * (i % 3)]) for i in range(9)], components=2, types="vec_id long, embedding array<double>")
    assert len(got) == 9
    model = W.Whitening(2**40, [2**60], np.array([[1.0]]), 1)
    assert model.deviation(np.array([[2**20]])) == [0] and model.deviation(np.array([[2**30]])) == [None]


def test_odd_rows(spark):
    rows = [(1, [0.5, 1.0], "x"), (1, [0.5, 1.0], "x"), (None, [2.0, -3.0], None), (2, [1.0], "x"), (3, [3e38, 1.0], "x"), (4, [0.0, 0.25], "x")]
    df = spark.createDataFrame(rows, TYPES + ", n string").withColumnsRenamed({"n": "x"})
    got = W.whiten(df).collect()
    assert sorted((r.vec_id or 0, r.component) for r in got) == [(0, 1), (0, 2), (1, 1), (1, 1), (1, 2), (1, 2), (4, 1), (4, 2)]
    assert {r.n for r in got} == {3}
    assert W.whiten(df.limit(0)).columns == W.whiten(df).columns and W.whiten(df.limit(0)).count() == 0
    assert W.whiten(spark.createDataFrame([(1, [1.0]), (2, [1.0])], TYPES)).count() == 0


def test_query(spark, folder):
    from threadloom.llm.queries import QUERIES

    got = QUERIES["op12_whitening"](spark, folder).collect()
    assert len(got) == 500 * 16 and got[0].identity_error < 1e-6
