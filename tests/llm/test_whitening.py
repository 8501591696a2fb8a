"""Whitening against plain linear algebra and whole-number arithmetic."""

import math
import random

import numpy as np
import pytest

from newsloom.llm import whitening

SCHEMA = "vec_id long, embedding array<double>, label int, component string, n string, _key int, _vector int"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", "y", 2, 3) for i, v in vectors], SCHEMA)


def whole(vector):
    return [math.floor(1024 * c) + 100_000 for c in vector]


def test_equals_plain_algebra(spark):
    rng = random.Random(1)
    mix = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(6)]
    vectors = [(i % 50, [sum(m * z for m, z in zip(row, [rng.gauss(0, 3) for _ in range(6)])) for row in mix]) for i in range(120)]
    vectors += [(None, [0.5] * 6), (7, None), (8, [1.0, None] + [0.0] * 4), (9, [float("nan")] * 6), (10, [float("inf")] + [0.0] * 5), (11, [])]
    found = whitening.whiten(table(spark, vectors).repartition(5), components=4).collect()
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v)]
    assert len(found) == 4 * len(kept) and {r["n"] for r in found} == {len(kept)}
    x = np.array([whole(v) for _, v in kept], float)
    centred = x - x.mean(0)
    values, axes = np.linalg.eigh(centred.T @ centred / len(x))
    white = centred @ axes[:, ::-1][:, :4] / np.sqrt(values[::-1][:4])
    for k in range(4):
        mine = np.array(sorted(r["whitened"] for r in found if r["component"] == k + 1))
        signs = [np.array(sorted(s * white[:, k])) for s in (1, -1)]
        assert min(abs(mine - s).max() for s in signs) < 1e-9
    shares = sorted({(r["component"], r["explained"]) for r in found})
    assert np.allclose([s for _, s in shares], values[::-1][:4] / values.sum(), rtol=1e-9)
    assert {r["identity_error"] < 1e-9 for r in found} == {True}
    sums = [sum(c) for c in zip(*[whole(v) for _, v in kept])]
    exact = sorted(sum((len(kept) * a - s) ** 2 for a, s in zip(whole(v), sums)) for _, v in kept)
    assert sorted(r["deviation"] for r in found if r["component"] == 1) == exact
    assert sorted(int(r["deviation_exact"]) for r in found if r["component"] == 1) == exact


def test_large_entries_stay_exact(spark):
    vectors = [(i, [float(v), float(-v) / 3]) for i, v in enumerate([3e9, -1e9, 2.5e9, 7.0])]
    found = whitening.whiten(table(spark, vectors)).collect()
    xs = [whole(v) for _, v in vectors]
    sums = [sum(c) for c in zip(*xs)]
    exact = {i: sum((4 * a - s) ** 2 for a, s in zip(x, sums)) for i, x in enumerate(xs)}
    for r in found:
        assert int(r["deviation_exact"]) == exact[r["vec_id"]]
        assert r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None)
    assert any(r["deviation"] is None for r in found)


def test_few_equal_or_no_vectors(spark):
    equal = whitening.whiten(table(spark, [(1, [0.25, 0.5]), (1, [0.25, 0.5])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in equal] == [(2, 0, None, 0.0, None)] * 4
    line = whitening.whiten(table(spark, [(1, [0.0, 0.0]), (2, [1.0, 1.0]), (3, [4.0, 4.0])])).collect()
    assert all((r["whitened"] is None) == (r["component"] == 2) for r in line)
    assert max(r["identity_error"] for r in line) < 1e-9
    assert whitening.whiten(table(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(table(spark, [])).columns[:3] == ["vec_id", "component", "n"]
    with pytest.raises(Exception, match="different lengths"):
        whitening.whiten(table(spark, [(1, [1.0]), (2, [1.0, 2.0])])).collect()
