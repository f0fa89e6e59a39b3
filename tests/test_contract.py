"""The contract of a stack around every rule, against a plain loop over samples."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import rejection as rj

CLIPPING = ["sigma", "averaged", "median_sigma", "winsorized"]
METHODS = [*CLIPPING, "linear", "percentile", "minmax", "none"]


def _sample_sd(x, c):
    return math.sqrt(sum((v - c) ** 2 for v in x) / (len(x) - 1))


def _spread(method, x):
    """(centre, spread, whether to go on) of the samples that are left."""
    c = sum(x) / len(x) if method == "averaged" else float(np.median(x))
    if method == "sigma":
        s = 1.4826 * float(np.median([abs(v - c) for v in x]))
    elif method == "averaged":
        s = sum(abs(v - c) for v in x) / len(x) * math.sqrt(math.pi / 2)
    else:
        s = _sample_sd(x, c)
    usable = s > 1e-12
    if method == "winsorized" and usable:
        for _ in range(64):
            new = 1.134 * _sample_sd([min(max(v, c - 1.5 * s), c + 1.5 * s) for v in x], c)
            near = abs(new - s) <= 5e-4 * s
            s = new
            if near:
                break
    return c, s, usable


def _clip_plainly(method, v):
    alive, centre, gone = [True] * len(v), 0.0, 0
    for _ in range(8):
        x = [a for a, k in zip(v, alive, strict=True) if k]
        if len(x) < 2:
            break
        centre, s, usable = _spread(method, x)
        if not usable:
            break
        changed = False
        for i, a in enumerate(v):
            if not alive[i]:
                continue
            if method in ("winsorized", "median_sigma") and len(x) - gone <= 4:
                break
            d = a - centre
            z = d / s if s else math.copysign(math.inf, d) if d else math.nan
            if z < -4 or z > 3:
                alive[i], changed, gone = False, True, gone + 1
        if not changed:
            break
    return [rj.ACCEPTED if k else rj.LOW if a < centre else rj.HIGH for a, k in zip(v, alive, strict=True)]


def _linear_plainly(v):
    n = len(v)
    order = sorted(range(n), key=lambda i: v[i])
    out, left, gone = [rj.ACCEPTED] * n, list(order), 0
    mx, dx2 = (n - 1) / 2, (n * n - 1) / 12
    for _ in range(8):
        k = len(left)
        if k < 4:
            break
        my = sum(v[i] for i in left) / k
        slope = sum((r - mx) * (v[i] - my) for r, i in enumerate(left)) / k / dx2
        rest = [v[i] - (slope * r + my - mx * slope) for r, i in enumerate(left)]
        s = sum(abs(x) for x in rest) / k
        stay, allowed = [], max(0, k - gone - 4)
        for i, x in zip(left, rest, strict=True):
            side = rj.LOW if -x > 5 * s else rj.HIGH if x > 3.5 * s else 0
            if side and allowed:
                out[i], allowed, gone = side, allowed - 1, gone + 1
            else:
                stay.append(i)
        if len(stay) == k:
            break
        left = stay
    return out


def plainly(method, values):
    n = len(values)
    if n == 0:
        return [], rj.MIN_SAMPLES
    if not all(math.isfinite(x) for x in values):
        return [rj.UNDERDETERMINED] * n, rj.INVALID_INPUT
    if n <= 2 or n < rj.MINIMUM[method]:
        return [rj.UNDERDETERMINED] * n, rj.SHALLOW
    m = float(np.median(values))
    v = [x - m for x in values]
    if method in CLIPPING:
        out = _clip_plainly(method, v)
    elif method == "linear":
        out = _linear_plainly(v)
    elif method == "percentile":
        out = [rj.LOW if x < -abs(m) * 0.2 else rj.HIGH if x > abs(m) * 0.1 else rj.ACCEPTED for x in v]
    elif method == "minmax":
        order = sorted(range(n), key=lambda i: (values[i], i))
        out = [rj.LOW if i == order[0] else rj.HIGH if i == order[-1] else rj.ACCEPTED for i in range(n)] if n >= 6 else [rj.UNDERDETERMINED] * n
    else:
        out = [rj.ACCEPTED] * n
    if all(r in (rj.LOW, rj.HIGH) for r in out):
        return ([rj.UNDERDETERMINED] * n, rj.SHALLOW) if n <= 4 else (out, rj.ALL_REJECTED)
    return out, rj.SHALLOW if rj.UNDERDETERMINED in out else rj.OK


def _stacks():
    rng = np.random.default_rng(11)
    out = [np.round(rng.standard_t(2, rng.integers(0, 30)) + 3, 3).tolist() for _ in range(150)]
    out += [[5.0] * 9 + [100.0], [5.0] * 9 + [-100.0], [7.0] * 6, [1.0, 2.0], [0.0, 10.0, 20.0, 30.0], [1.0, 5.0, 9.0, 13.0, 20.0, 31.0], [1.0, float("nan"), 3.0], [1.0, float("inf"), 3.0, 4.0], [], [4.0], [-5.0, -1.0, -9.0]]
    return out


@pytest.mark.parametrize("method", METHODS)
def test_decisions_are_those_of_a_plain_loop(method):
    stacks = _stacks()
    reason, _, status = rj.decide(method, np.array([len(s) for s in stacks]), np.array([x for s in stacks for x in s]))
    at = 0
    for s, st in zip(stacks, status, strict=True):
        assert (reason[at : at + len(s)].tolist(), st) == plainly(method, s), s
        at += len(s)


def test_auto_takes_the_method_of_the_depth():
    stacks = _stacks()
    reason, _, status = rj.decide("auto", np.array([len(s) for s in stacks]), np.array([x for s in stacks for x in s]))
    at = 0
    for s, st in zip(stacks, status, strict=True):
        assert (reason[at : at + len(s)].tolist(), st) == plainly("percentile" if len(s) < 6 else "winsorized" if len(s) <= 15 else "linear", s), s
        at += len(s)


def test_a_collapsed_winsorised_spread_still_rejects():
    assert rj.decide("winsorized", np.array([10]), np.array([5.0] * 9 + [100.0]))[0].tolist() == [0] * 9 + [rj.HIGH]


def test_wrong_plans_reject_nothing():
    n, v = np.array([5, 3]), np.array([1.0, 2, 3, 4, 99, 1, np.nan, 2])
    assert rj.decide("clever", n, v)[2] == [rj.INVALID_METHOD] * 2
    reason, _, status = rj.decide("percentile", n, v, normalization=rj.SCALE)
    assert status == [rj.INVALID_CONFIGURATION, rj.INVALID_INPUT] and set(reason.tolist()) == {rj.UNDERDETERMINED}


@pytest.mark.parametrize("normalization", [rj.CENTRE, rj.SCALE, rj.RAW])
def test_normalisation_leaves_scale_free_decisions(normalization):
    v = np.concatenate([np.random.default_rng(4).normal(50, 1, 20), [90.0, 10.0]])
    assert rj.decide("sigma", np.array([22]), v, normalization=normalization)[0].tolist() == rj.decide("sigma", np.array([22]), v)[0].tolist()


def test_expressions_follow_the_contract(spark):
    stacks = _stacks()
    df = spark.createDataFrame([(i, s) for i, s in enumerate(stacks)], "id long, v array<double>")
    stack = F.transform("v", lambda x, i: F.struct((i + 1).alias("ord"), x.alias("v")))
    for r in df.select("id", rj.percentile_reasons(stack).alias("p"), rj.minmax_reasons(stack).alias("m")).collect():
        assert r.p == plainly("percentile", stacks[r.id])[0]
        assert r.m == plainly("minmax", stacks[r.id])[0]
