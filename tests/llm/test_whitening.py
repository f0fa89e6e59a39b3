"""Whitening against numpy's eigenvectors, at several fans and with odd rows."""

from __future__ import annotations

import math

import numpy as np
import pytest

from skyloom.llm import whitening
from skyloom.llm.whitening import Whitening

SCHEMA = "vec_id long, embedding array<float>, label int, component int, n int"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    spread = np.diag(np.linspace(3, 0.3, 12)) @ np.linalg.qr(rng.normal(size=(12, 12)))[0]
    x = (rng.normal(size=(500, 12)) @ spread + 5).astype(np.float32).tolist()
    out = [(i, v, 0, 1, 2) for i, v in enumerate(x)] + [(i, x[7], 0, 1, 2) for i in range(900, 1100)]
    return [*out, (None, x[3], 0, 1, 2), (2000, None, 0, 1, 2), (2001, [None, *x[0][1:]], 0, 1, 2), (2002, [math.nan, *x[0][1:]], 0, 1, 2), (2003, [math.inf, *x[0][1:]], 0, 1, 2), (2004, x[0][1:], 0, 1, 2), (2005, [], 0, 1, 2), out[0]]


def _plain(rows, k):
    keep = [r for r in rows if r[1] is not None and len(r[1]) == 12 and all(c is not None and math.isfinite(c) for c in r[1])]
    x = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in r[1]] for r in keep]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    e = np.array([[n * a - s for a, s in zip(v, sums, strict=True)] for v in fit], float) / n
    values, vectors = np.linalg.eigh(e.T @ e / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = {}
    for r, v in zip(keep, x, strict=True):
        d = [n * a - s for a, s in zip(v, sums, strict=True)]
        out.setdefault(r[0], []).append((sum(a * a for a in d), (np.array(d, float) / n @ vectors / np.sqrt(values))[:k]))
    return n, values / values.sum(), out


@pytest.mark.parametrize(("fan", "parts"), [(2, 9), (32, 3)])
def test_rows_are_those_of_numpy(spark, rows, fan, parts):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    got = whitening.whiten(df, Whitening(components=16, fan=fan)).collect()
    n, shares, want = _plain(rows, 12)
    assert len(got) == 12 * sum(map(len, want.values()))
    sign = {}
    for r in got:
        deviation, z = want[r.vec_id][0]
        assert (r.n, r.deviation) == (n, deviation)
        assert r.explained == pytest.approx(shares[r.component - 1], rel=1e-9)
        assert r.identity_error < 1e-9
        if abs(z[r.component - 1]) > 1e-3:
            s = sign.setdefault(r.component, np.sign(r.whitened * z[r.component - 1]))
            assert r.whitened * s == pytest.approx(z[r.component - 1], rel=1e-6)
    assert len(sign) == 12


def test_jacobi_finds_small_deviations_too():
    rng = np.random.default_rng(1)
    u, v = np.linalg.qr(rng.normal(size=(30, 9)))[0], np.linalg.qr(rng.normal(size=(9, 9)))[0]
    s = 10.0 ** -np.arange(9)
    vectors, values = whitening.jacobi(np.linalg.qr(u * s @ v.T, mode="r"))
    assert values == pytest.approx(s, rel=1e-6)
    assert np.abs(vectors.T @ vectors - np.eye(9)).max() < 1e-14
    assert np.abs(np.abs((vectors * v).sum(0)) - 1).max() < 1e-9
    zero, length = whitening.jacobi(np.zeros((3, 5)))
    assert length.tolist() == [0.0] * 5 and np.array_equal(np.abs(zero), np.eye(5))


def test_agreeing_vectors_have_no_deviation(spark):
    flat = [(i, [float(i), 1.0, 2.0 * i]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(flat, "vec_id long, embedding array<double>"), Whitening(components=2)).collect()
    assert {r.component for r in got} == {1, 2} and all((r.whitened is None) == (r.component == 2) for r in got)
    assert {r.explained for r in got if r.component == 2} == {0.0} and all(r.explained == pytest.approx(1.0) for r in got if r.component == 1)
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 2.0]), (2, [0.5, 2.0])], "vec_id long, embedding array<double>")).collect()
    assert len(one) == 4 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, None, None) for r in one)


def test_empty_and_large(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(none).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, None), (2, [])], "vec_id long, embedding array<float>")).collect() == []
    far = whitening.whiten(spark.createDataFrame([(1, [1e9]), (2, [-1e9]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r.vec_id: r.deviation for r in far} == {1: None, 2: None, 3: 0}
    with pytest.raises(ValueError, match="max_dims"):
        whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], "vec_id long, embedding array<double>"), Whitening(max_dims=1))
