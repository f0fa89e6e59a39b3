"""Robust Chauvenet rejection against a plain loop over one stack, and its factors against a simulation."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import chauvenet as ch
from skyloom.operators import rejection as rj


def _fit_at(m, x, y):
    """Slope and squared error of the least-squares line through the origin that bends at x[m], by a solved system."""
    first = [x[i] if i <= m else x[m] for i in range(len(x))]
    second = [0.0 if i <= m else x[i] - x[m] for i in range(len(x))]
    a = np.array([first, second]).T
    (slope, bend), *_ = np.linalg.lstsq(a, np.array(y), rcond=None)
    return slope, sum((slope * p + bend * q - v) ** 2 for p, q, v in zip(first, second, y, strict=True))


def _line_plainly(y):
    n = len(y)
    x = ch.deviates(n).tolist()
    under = next((i for i, v in enumerate(x) if v >= 1), n)
    if under < 2:
        return _percentile_plainly(y)
    x, y = x[:under], y[:under]
    single = sum(a * b for a, b in zip(x, y, strict=True)) / sum(a * a for a in x)
    if under == 2 or n < 4:
        return single
    low, high, step = 1, under - 1, max(int(n / 6.36), 1)
    while True:
        errors = {m: _fit_at(m, x, y)[1] for m in range(low, high, step)}
        best = min(errors, key=lambda m: (errors[m], m))
        if step == 1:
            break
        low, high = max(best - step - 1, 1), min(best + step + 1, under - 1)
        step = max(int((high - low) / 6.36), 1)
    slope, error = _fit_at(best, x, y)
    plain = sum((single * a - b) ** 2 for a, b in zip(x, y, strict=True))
    return single if error == 0 or (plain - error) / error < ch.break_gain(n) else max(slope, 1e-10)


def _percentile_plainly(y):
    k, running, total = 0, ch.CORE, ch.CORE * len(y)
    while running < total - 1e-12:
        k, running = k + 1, running + 1
    return y[0] if k == 0 else y[k - 1] + (total - (running - 1)) * (y[k] - y[k - 1])


def _plainly(values):
    alive = [True] * len(values)
    for centre, kind in (("median", "line"), ("median", "percentile"), ("mean", "sd")):
        while True:
            left = [v for v, k in zip(values, alive, strict=True) if k]
            if len(set(left)) < 3:
                break
            c = float(np.median(left)) if centre == "median" else sum(left) / len(left)
            y = sorted(abs(v - c) for v in left)
            s = _line_plainly(y) if kind == "line" else _percentile_plainly(y) if kind == "percentile" else math.sqrt(sum(v * v for v in y) / (len(y) - 1))
            z = y[-1] / (s / ch.unity(len(y))) if s else math.inf
            if len(left) * (float(ch.tail(np.array(z))) if z < math.inf else 0.0) >= 0.5:
                break
            far = [abs(v - c) if k else -1 for v, k in zip(values, alive, strict=True)]
            alive[far.index(max(far))] = False
    return alive


def _stacks(count, seed):
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(count):
        v = rng.normal(10, 1, rng.integers(3, 45))
        bad = rng.random(len(v)) < rng.choice([0.0, 0.05, 0.3])
        out.append(np.where(bad, v + rng.exponential(20, len(v)) * rng.choice([-1, 1]), v).tolist())
    return out


def test_reasons_are_those_of_a_plain_loop():
    stacks = [*_stacks(5000, 3), [5.0] * 9 + [100.0], [1.0, 2.0, 2.0, 2.0, 9.0], [0.0, 0.0, 1e-9, 1.0]]
    reason, iterations, status = rj.decide("rcr", np.array([len(s) for s in stacks]), np.array([x for s in stacks for x in s]), normalization=rj.RAW)
    at, differ, gone = 0, 0, 0
    for s, k, st in zip(stacks, iterations, status, strict=True):
        got = reason[at : at + len(s)].tolist()
        at += len(s)
        want = [rj.ACCEPTED if a else rj.LOW if v < np.median(s) else rj.HIGH for v, a in zip(s, _plainly(s), strict=True)]
        differ += got != want
        gone += sum(r > 0 for r in got)
        assert (k, st) == (3, rj.OK)
    assert differ <= 1 and gone > 5000  # breaks of equal error may round apart


def test_samples_far_out_go():
    v = [10, 10.1, 9.9, 10.05, 10.2, 9.8, 50.0]
    reason, _, status = rj.decide("rcr", np.array([7]), np.array(v), normalization=rj.RAW)
    assert reason.tolist() == [0] * 6 + [rj.HIGH] and status == [rj.OK]
    rng = np.random.default_rng(20)
    v = np.concatenate([rng.normal(10, 1, 80), rng.normal(25, 2, 20)])
    reason = rj.decide("rcr", np.array([100]), v, normalization=rj.RAW)[0]
    assert (reason[80:] == rj.HIGH).all() and (reason[:80] > 0).sum() <= 4


def test_few_normal_samples_go():
    v = np.random.default_rng(8).normal(size=(2000, 25))
    gone = 25 - ch.survivors(v, np.ones(v.shape, bool)).sum(axis=1)
    assert gone.mean() < 0.1 * 25 and np.median(gone) <= 1


def test_contract():
    n = np.array([5, 3, 2, 0, 4])
    v = np.array([1.0, 2, 3, 4, 99, 1, np.nan, 2, 1, 100, 1, 2, 3, 4])
    reason, iterations, status = rj.decide("rcr", n, v, normalization=rj.RAW)
    assert status == [rj.OK, rj.INVALID_INPUT, rj.SHALLOW, rj.MIN_SAMPLES, rj.OK] and iterations.tolist() == [3, 0, 0, 0, 3]
    assert set(reason[5:10].tolist()) == {rj.UNDERDETERMINED}
    for normalization in (rj.CENTRE, rj.SCALE):
        reason, _, status = rj.decide("rcr", n, v, normalization=normalization)
        assert status == [rj.INVALID_CONFIGURATION, rj.INVALID_INPUT, rj.INVALID_CONFIGURATION, rj.MIN_SAMPLES, rj.INVALID_CONFIGURATION]
        assert set(reason.tolist()) == {rj.UNDERDETERMINED}


def test_order_and_level_are_nothing():
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(0, 1, 30), [9.0, -12.0, 14.0]])
    p = rng.permutation(33)
    first, other = (rj.decide("rcr", np.array([33]), x, normalization=rj.RAW)[0] for x in (v, v[p] + 512))
    assert first[p].tolist() == other.tolist()


def test_factors_are_those_of_a_simulation():
    for n, (scale, gain) in ch.simulated([4, 5, 7, 8, 10, 16, 30, 60], seed=7, draws=20_000).items():
        assert ch.unity(n) == pytest.approx(scale, rel=0.07)
        assert ch.break_gain(n) == pytest.approx(gain, rel=0.12)


def test_column(spark):
    stacks = _stacks(60, 9)
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stacks)] + [(99, None)], "id long, v array<double>").repartition(3)
    got = {r.id: r.d for r in df.select("id", rj.rejection("rcr", F.col("v")).alias("d")).collect()}
    for i, s in enumerate(stacks):
        assert list(got[i].reasons) == rj.decide("rcr", np.array([len(s)]), np.array(s), normalization=rj.RAW)[0].tolist()
        assert got[i].accepted + got[i].rejected_low + got[i].rejected_high == len(s)
    assert got[99].status == rj.MIN_SAMPLES
