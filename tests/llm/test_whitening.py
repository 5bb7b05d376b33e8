"""Whitening against the eigenvectors of the whole covariance matrix."""

import math

import numpy as np
import pytest
from tidewatch.llm import whitening
from tidewatch.llm.shared import table

SMALL = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, n string, whitened string"


def plain(vectors, components=32):
    """By hand: x, deviations, eigenvalues, axes."""
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in kept], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    exact = n * x - sums
    z = exact.astype(float) / n
    values, axes = np.linalg.eigh(z.T @ z / n)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    return [i for i, _ in kept], (exact * exact).sum(axis=1).tolist(), values, z @ axes / np.sqrt(np.maximum(values, 1e-300)), values / np.trace(z.T @ z / n)


def test_driver_table(spark):
    rows = table(spark, SMALL, "embeddings")
    vectors = [(r.vec_id, r.embedding) for r in rows.collect()]
    ids, deviations, values, places, parts = plain(vectors)
    found = whitening.op13_whitening(spark, SMALL).collect()
    assert len(found) == len(ids) * 32 and len(set(ids)) == len(ids)
    at = {i: k for k, i in enumerate(ids)}
    mine = np.zeros_like(places)
    for r in found:
        k = at[r.vec_id]
        assert r.n == len(ids) and r.deviation == deviations[k] and r.identity_error < 1e-9
        assert r.explained == pytest.approx(parts[r.component - 1], rel=1e-9)
        mine[k, r.component - 1] = r.whitened
    signs = np.sign((mine * places).sum(axis=0))
    assert np.abs(mine * signs - places).max() < 1e-9


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    base = [[float(c) for c in v] for v in rng.standard_normal((40, 3))]
    odd = [None, [], [1.0, None, 2.0], [float("nan"), 0.0, 0.0], [float("inf"), 0.0, 0.0], [1.0, 2.0]]
    vectors = [(i, v) for i, v in enumerate([*base, *odd, base[0], base[0]])] + [(None, base[1])]
    rows = spark.createDataFrame([(i, v, "a", "b") for i, v in vectors], SCHEMA).repartition(5)
    whole = [(i, v) for i, v in vectors if v != [1.0, 2.0]]
    ids, deviations, values, places, parts = plain(whole)
    found = whitening.whitened(rows).collect()
    assert sorted(map(str, ids)) == sorted(str(r.vec_id) for r in found)
    assert sorted(map(int, deviations)) == sorted(int(r.deviation) for r in found)
    assert {len(r.whitened) for r in found} == {3} and found[0].identity_error < 1e-12
    by_id = {r.vec_id: np.array(r.whitened) for r in found if r.vec_id is not None}
    mine = np.array([by_id[i] for i in ids if i is not None])
    theirs = np.array([p for i, p in zip(ids, places) if i is not None])
    assert np.abs(mine * np.sign((mine * theirs).sum(axis=0)) - theirs).max() < 1e-10


def test_flat_directions_and_repeated_eigenvalues(spark):
    """A constant entry, one that repeats another, and a square whose two eigenvalues are equal."""
    corners = [(a, b) for a in (-1.0, 1.0) for b in (-1.0, 1.0)]
    vectors = [(k, [a, b, 7.0, 0.25 * c, 0.25 * c]) for c in (-1.0, 1.0) for k, (a, b) in enumerate(corners)]
    found = whitening.whitened(spark.createDataFrame([(i, v, "", "") for i, v in vectors], SCHEMA)).collect()
    assert {len(r.whitened) for r in found} == {3}
    assert found[0].identity_error < 1e-9
    assert sum(found[0].explained) == pytest.approx(1)
    equal = whitening.whitened(spark.createDataFrame([(i, [1.0, 2.0], "", "") for i in range(4)], SCHEMA)).collect()
    assert [(r.deviation, r.whitened, r.n) for r in equal] == [(0, [], 4)] * 4


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(6)
    vectors = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.standard_normal((30, 2)) * 1e8)]
    _, deviations, *_ = plain(vectors)
    found = {r.vec_id: int(r.deviation) for r in whitening.whitened(spark.createDataFrame([(i, v, "", "") for i, v in vectors], SCHEMA)).collect()}
    assert [found[i] for i, _ in vectors] == [int(d) for d in deviations]
    beyond = spark.createDataFrame([(0, [3e38, 1.0], "", ""), (1, [-3e38, 1.0], "", ""), (2, [0.0, 5.0], "", "")], SCHEMA)
    assert whitening.whitened(beyond).count() == 3


def test_empty(spark):
    assert whitening.whitened(spark.createDataFrame([], SCHEMA)).collect() == []


def test_settled_steps_give_the_leading_components(spark):
    rng = np.random.default_rng(7)
    wide = rng.standard_normal((300, 24)) * (0.5 ** np.arange(24)) * 100
    rows = spark.createDataFrame([(i, [float(c) for c in v], "", "") for i, v in enumerate(wide)], SCHEMA)
    data = whitening.blocks(rows)
    right, band = whitening.bidiagonalised(data, tolerance=1e-13, components=2)
    assert right.shape[1] < 24 and np.allclose(np.tril(band, -1), 0) and np.allclose(np.triu(band, 2), 0)
    whole, few = whitening.fitted(data, 2), whitening.fitted(data, 2, tolerance=1e-13)
    assert np.abs(np.abs((whole.components * few.components).sum(axis=0)) - 1).max() < 1e-12
