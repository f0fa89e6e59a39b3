"""Dark scales against a plain loop over every pixel."""

from __future__ import annotations

import numpy as np
import pytest

from skyloom.operators import darks


def _plain(light, dark, bias, per_cell, total):
    """The samples' places (y, x), by loops."""
    h, w = light.shape
    m = np.median(light)
    d = np.median(abs(light - m))
    good = abs(light - m) <= 3 * 1.4826 * d if d > 0 else np.ones_like(light, bool)
    out = []
    for gy in range(8):
        for gx in range(8):
            if len(out) >= total:
                continue
            y0, x0 = gy * max(1, h // 8), gx * max(1, w // 8)
            y1, x1 = h if gy == 7 else y0 + max(1, h // 8), w if gx == 7 else x0 + max(1, w // 8)
            at = [(y, x) for y in range(y0, min(y1, h)) for x in range(x0, min(x1, w)) if good[y, x]]
            out += at[:: max(1, len(at) // per_cell)][:per_cell]
    return out


@pytest.fixture(scope="module")
def exposures(spark):
    rng = np.random.default_rng(4)
    shots = {}
    for f, (h, w, k) in enumerate([(40, 53, 1.7), (64, 64, 0.4), (30, 30, 12.0), (7, 9, 1.0), (33, 47, 0.0), (24, 40, 2.5)]):
        bias = rng.normal(10, 0.1, (h, w))
        dark = bias + (rng.gamma(2, 5, (h, w)) if f != 5 else 3.0)
        light = bias + k * (dark - bias) + rng.normal(20, 0.5, (h, w))
        light[rng.random((h, w)) < 0.03] += 500
        shots[f] = (light, dark, bias)
    rows = [(f, x, y, *[float(v[y, x]) for v in s]) for f, s in shots.items() for y in range(s[0].shape[0]) for x in range(s[0].shape[1])]
    frames = [(f, s[0].shape[1], s[0].shape[0], 0.9) for f, s in shots.items()]
    px = "frame long, x long, y long, light double, dark double, bias double"
    return shots, spark.createDataFrame(rows, px).repartition(5), spark.createDataFrame(frames, "frame long, width long, height long, ratio double")


@pytest.mark.parametrize(("per_cell", "total"), [(1000, 50_000), (7, 50_000), (10, 300)])
def test_samples_are_those_of_a_plain_loop(exposures, per_cell, total):
    shots, pixels, frames = exposures
    got = {(r.frame, r.y, r.x) for r in darks.strided(darks.background(pixels), frames, per_cell=per_cell, total=total).collect()}
    assert got == {(f, y, x) for f, s in shots.items() for y, x in _plain(*s, per_cell, total)}


def test_scales_and_reasons(spark, exposures):
    shots, pixels, frames = exposures
    more = spark.createDataFrame([(50, 9, 9, 0.7), (51, 9, 9, -1.0), (52, 9, 9, None)], frames.schema)
    odd = spark.createDataFrame([(50, 0, 0, None, 1.0, 1.0), (50, 1, 0, float("nan"), 1.0, 1.0), (None, 1, 0, 1.0, 1.0, 1.0)], pixels.schema)
    got = {r.frame: r for r in darks.dark_scales(pixels.unionByName(odd), frames.unionByName(more)).collect()}
    for f, (light, dark, bias) in shots.items():
        at = tuple(np.array(_plain(light, dark, bias, 1000, 50_000)).T)
        k, code = darks.slope((dark - bias)[at], (light - bias)[at])
        assert (got[f].code, got[f].samples, got[f].fell_back) == (code, len(at[0]), code != "OK")
        assert got[f].k == pytest.approx(0.9 if k is None else k, abs=1e-9)
    assert got[0].k == pytest.approx(1.7, abs=0.05) and got[1].k == pytest.approx(0.4, abs=0.05)
    assert [got[f].code for f in (2, 3, 5)] == ["K_OUT_OF_RANGE", "INSUFFICIENT_SAMPLES", "ZERO_VARIANCE"] and got[4].fell_back
    assert [(got[f].code, got[f].k, got[f].samples) for f in (50, 51, 52)] == [("INSUFFICIENT_SAMPLES", 0.7, 0), ("BAD_RATIO", -1.0, 0), ("BAD_RATIO", None, 0)]
    assert darks.dark_scales(pixels, frames.where("false")).isEmpty()


def test_outliers_do_not_move_the_slope():
    rng = np.random.default_rng(6)
    x = rng.uniform(0, 10, 2000)
    y = 3 + 1.25 * x + rng.normal(0, 0.1, 2000)
    y[::10] += 40
    assert darks.slope(x, y)[0] == pytest.approx(1.25, abs=0.01)
    assert darks.slope(x, -y)[1] == "K_OUT_OF_RANGE"
    assert darks.slope(x[:99], y[:99]) == (None, "INSUFFICIENT_SAMPLES")


def test_the_query_masks_samples_clips_and_falls_back(spark):
    """a_dark_k's pixels: stars are masked, cells give 1000 samples at most, and the frames whose line is no scale take the exposures' ratio."""
    from skyloom import catalog
    from skyloom.plans import sampler

    sf = "/root/testdata/sf0.001"
    pixels, _ = sampler._darks(spark, sf)
    at = pixels.toPandas()
    got = {r.frame: r for r in catalog.queries()["a_dark_k"](spark, sf).collect()}
    assert {f for f, r in got.items() if r.fell_back} == {5, 6} and (got[5].k, got[6].k) == (1.4, 1.5)
    unclipped = []
    for f, p in at.groupby("frame"):
        off = (p.light - p.light.median()).abs()
        assert got[f].n == (off <= 3 * 1.4826 * off.median()).sum() < len(p)
        if f not in (5, 6):
            assert got[f].k == pytest.approx(1.37, abs=0.01)
            unclipped.append(abs(np.polyfit(p.dark, p.light, 1)[0] - 1.37))
    assert max(unclipped) > 0.05
