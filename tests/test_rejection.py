from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import rejection as rj

# The 54 numbers of Rosner's example, of which three are outliers.
ROSNER = [-0.25, 0.68, 0.94, 1.15, 1.20, 1.26, 1.26, 1.34, 1.38, 1.43, 1.49, 1.49, 1.55, 1.56, 1.58, 1.65, 1.69, 1.70, 1.76, 1.77, 1.81, 1.91, 1.94, 1.96, 1.99, 2.06, 2.09, 2.10, 2.14, 2.15, 2.23, 2.24, 2.26, 2.35, 2.37, 2.40, 2.47, 2.54, 2.62, 2.64, 2.90, 2.92, 2.92, 2.93, 3.21, 3.26, 3.30, 3.59, 3.68, 4.30, 4.64, 5.34, 5.42, 6.01]
ITERATIVE = ["sigma", "averaged", "winsorized", "median_sigma", "linear", "esd"]


def one(method, values):
    reason, iterations, status = rj.decide(method, np.array([len(values)]), np.array(values, float))
    return reason.tolist(), int(iterations[0]), status[0]


def test_esd_finds_three_of_rosners_outliers():
    reason, k, _ = one("esd", ROSNER)
    assert k == 3 and [i for i, r in enumerate(reason) if r] == [51, 52, 53]


def test_esd_bound_is_the_published_one():
    assert rj.esd_critical(54, 1) == pytest.approx(3.158, abs=1e-3)
    assert rj.esd_critical(54, 10) == pytest.approx(3.085, abs=1e-3)


@pytest.mark.parametrize("method", ITERATIVE)
def test_two_samples_are_underdetermined(method):
    assert one(method, [1.0, 100.0])[0::2] == ([rj.UNDERDETERMINED] * 2, rj.SHALLOW)


@pytest.mark.parametrize("method", ITERATIVE)
def test_non_finite_stacks_are_invalid_and_keep_all(method):
    assert one(method, [1.0, float("nan"), 2.0, 3.0])[0::2] == ([rj.UNDERDETERMINED] * 4, rj.INVALID_INPUT)


@pytest.mark.parametrize("method", ITERATIVE)
def test_a_bright_trail_goes(method):
    values = [10 + 0.1 * np.sin(i) for i in range(19)] + [60.0]
    reason, _, status = one(method, values)
    assert reason[-1] == rj.HIGH and status == rj.OK and sum(r > 0 for r in reason) <= 3


@pytest.mark.parametrize("method", ITERATIVE)
def test_decisions_do_not_move_with_the_level(method):
    rng = np.random.default_rng(4)
    v = np.concatenate([rng.normal(0, 1, 20), [15.0, -18.0]])
    assert one(method, v)[0] == one(method, v - 1000)[0]


@pytest.mark.parametrize("method", ITERATIVE)
def test_a_batch_decides_as_single_stacks_do(method):
    rng = np.random.default_rng(8)
    stacks = [np.round(rng.standard_t(2, rng.integers(0, 30)), 3) for _ in range(200)]
    together, _, status = rj.decide(method, np.array([len(s) for s in stacks]), np.concatenate(stacks))
    at = 0
    for s, st in zip(stacks, status, strict=True):
        reason, _, own = one(method, s)
        assert reason == together[at : at + len(s)].tolist() and own == st
        at += len(s)


def _sigma_plainly(v):
    keep = list(range(len(v)))
    for _ in range(8):
        x = np.array([v[i] for i in keep])
        if len(x) < 2:
            break
        m = np.median(x)
        s = 1.4826 * np.median(np.abs(x - m))
        if s <= 1e-12:
            break
        left = [i for i in keep if -4 <= (v[i] - m) / s <= 3]
        if left == keep:
            break
        keep = left
    return keep


def test_sigma_against_a_plain_loop():
    rng = np.random.default_rng(2)
    for _ in range(100):
        v = rng.standard_t(2, rng.integers(3, 40))
        assert [i for i, r in enumerate(one("sigma", v)[0]) if r == 0] == _sigma_plainly(v - np.median(v))


def test_minmax_keeps_four(spark):
    df = spark.createDataFrame([(1, [5.0, 1.0, 9.0, 4.0, 3.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0, 5.0])], "id long, v array<double>")
    stack = F.transform("v", lambda x, i: F.struct((i + 1).alias("ord"), x.alias("v")))
    got = {r.id: r.r for r in df.select("id", rj.minmax_reasons(stack).alias("r")).collect()}
    assert got == {1: [0, 1, 2, 0, 0, 0], 2: [3] * 5}


@pytest.mark.parametrize(("weights", "status", "used"), [([1.0, float("nan")], 4, 0), ([1.0, float("inf")], 4, 0), ([1.0, -2.0], 4, 0), ([1.0, 0.0], 0, 1), ([0.0, 0.0], 3, 0), ([], 1, 0)])
def test_integration_statuses(spark, weights, status, used):
    df = spark.createDataFrame([([10.0, 11.0][: len(weights)], weights)], "v array<double>, w array<double>")
    stack = F.transform("v", lambda x, i: F.struct(x.alias("v"), F.get("w", i).alias("w"), F.lit(1.0).alias("sup")))
    reasons = F.transform("v", lambda x: F.lit(0).cast("tinyint"))
    r = df.select(rj.integrate(stack, reasons).alias("r")).first().r
    assert (r.status, r.n_used) == (status, used)
