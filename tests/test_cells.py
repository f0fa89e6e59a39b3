"""Neighbours of cells against distances on the sphere, and the smoothing solver against a dense solution."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from skyloom.functions import healpix as hp
from skyloom.operators import upm


@pytest.mark.parametrize("order", [1, 3])
def test_neighbours_are_the_pixels_around(spark, order):
    n = 12 * 4**order
    pixels = spark.range(n).withColumnRenamed("id", "pix")
    found = collections.defaultdict(set)
    for r in hp.neighbours(pixels, order).collect():
        assert r.neighbor not in found[r.pix]
        found[r.pix].add(r.neighbor)
    assert all(p in found[q] for p in found for q in found[p])
    assert collections.Counter(len(x) for x in found.values()) == {8: n - 24, 7: 24}
    at = {r.pix: np.radians([r.ra, r.dec]) for r in hp.with_centre(pixels, order).collect()}
    v = np.array([[np.cos(at[p][1]) * np.cos(at[p][0]), np.cos(at[p][1]) * np.sin(at[p][0]), np.sin(at[p][1])] for p in range(n)])
    for p, near in found.items():
        gap = np.degrees(np.arccos(np.clip(v @ v[p], -1, 1)))
        gap[p] = np.inf
        assert max(gap[list(near)]) < 2.6 * hp.resolution_arcsec(order) / 3600
        assert set(np.argsort(gap)[:3].tolist()) <= near  # the closest share an edge


def test_smoothed_fields_solve_the_system(spark):
    rng = np.random.default_rng(3)
    links = [(i, i + 1) for i in range(11)] + [(i, i + 4) for i in range(8)] + [(20, 21)]
    nodes = [(f, k, float(rng.uniform(0, 2)), float(rng.normal())) for f in range(3) for k in [*range(12), 20] if rng.random() < 0.6] + [(7, 99, 2.0, 4.0)]
    got = {(r.frame, r.control): r.c for r in upm.smoothed(spark.createDataFrame(nodes, "frame long, control long, weight double, rhs double"), spark.createDataFrame(links, "a long, b long"), 3.0, 0.01).collect()}
    for f in range(3):
        names = sorted({k for pair in links for k in pair})
        at = {k: i for i, k in enumerate(names)}
        m, rhs = 0.01 * np.eye(len(names)), np.zeros(len(names))
        for a, b in links:
            i, j = at[a], at[b]
            m[i, i] += 3
            m[j, j] += 3
            m[i, j] -= 3
            m[j, i] -= 3
        for g, k, w, r in nodes:
            if g == f:
                m[at[k], at[k]] += w
                rhs[at[k]] = r
        x = np.linalg.solve(m, rhs)
        assert all(got.get((f, k), 0.0) == pytest.approx(x[at[k]], abs=1e-8) for k in names)
    assert got[7, 99] == pytest.approx(4 / 2.01)


def test_a_changed_model_does_not_open(spark, tmp_path):
    c = spark.createDataFrame([(1, 1, 0.5), (1, 2, 0.0), (2, 1, -0.25)], "frame long, control long, c double")
    upm.save(c, f"{tmp_path}/m")
    assert upm.open_model(spark, f"{tmp_path}/m").count() == 2
    spark.createDataFrame([(3, 1, 0.5)], "frame long, control long, c double").write.mode("append").parquet(f"{tmp_path}/m/c")
    with pytest.raises(ValueError, match="manifest"):
        upm.open_model(spark, f"{tmp_path}/m")


def test_unknown_frames_and_missing_variances_are_errors(spark):
    from pyspark.sql import functions as F

    from skyloom.functions import frames as fr

    nodes = spark.createDataFrame([(1, 0, 0, 0, 2.0)], "frame long, tile long, gx long, gy long, c double")
    pixels = lambda f: spark.createDataFrame([(f, 0, 5, 5)], "frame long, tile long, x long, y long")
    assert upm.evaluate(pixels(1), nodes).first().c == 2.0
    with pytest.raises(Exception, match="no frame 4"):
        upm.evaluate(pixels(4), nodes).collect()
    for ivar in (None, 0.0, float("nan"), float("inf")):
        with pytest.raises(Exception, match="no inverse variance"):
            spark.createDataFrame([(0, ivar)], "f int, v double").select(fr.control_weight(F.col("f"), F.col("v"))).collect()


def _model(rng, tiles, frames):
    controls = [(t * 64 + gx * 8 + gy, t, gx, gy) for t in tiles for gx in range(8) for gy in range(8) if (gx + gy + t) % 3]
    obs = []
    for f in range(frames):
        for k, _, gx, gy in controls:
            if rng.random() < 0.5:
                obs.append((f, k, float(2 + 0.1 * gx + (f and 0.3 * f + 0.05 * gy) + rng.normal(0, 0.02)), 0.02, float(rng.uniform(0.2, 1))))
    return controls, obs


def _dense_fit(obs, links, smoothing, rounds, anchor=1e-3, delta=1.345):
    """The alternation with a dense solve of each frame's system."""
    names = sorted({o[1] for o in obs} | {x for pair in links for x in pair})
    at = {k: i for i, k in enumerate(names)}
    lap = np.zeros((len(names), len(names)))
    for a, b in links:
        i, j = at[a], at[b]
        lap[i, i] += 1
        lap[j, j] += 1
        lap[i, j] -= 1
        lap[j, i] -= 1
    f, k = np.array([o[0] for o in obs]), np.array([at[o[1]] for o in obs])
    v, u, w = (np.array([o[i] for o in obs]) for i in (2, 3, 4))
    m = np.bincount(k, w * v, len(names)) / np.maximum(np.bincount(k, w, len(names)), 1e-300)
    c = np.zeros((f.max() + 1, len(names)))
    for _ in range(rounds):
        z = np.abs((v - m[k] - c[f, k]) / u)
        h = w * np.where(z <= delta, 1, delta / np.maximum(z, delta))
        before = m.copy(), c.copy()
        for i in range(len(names)):
            for rows in ((k == i) & (f == 0), k == i):
                if h[rows].sum() > 1e-12:
                    m[i] = (h[rows] * (v[rows] - c[f[rows], i])).sum() / h[rows].sum()
                    break
        for g in range(1, len(c)):
            own = f == g
            a = np.diag(np.bincount(k[own], h[own], len(names)) + anchor) + smoothing * lap
            c[g] = np.linalg.solve(a, np.bincount(k[own], h[own] * (v[own] - m[k[own]]), len(names)))
        if max(np.abs(m - before[0]).max(), np.abs(c - before[1]).max()) < 1e-6:
            break
    return {x: m[at[x]] for x in names}, {(g, x): c[g, at[x]] for g in range(len(c)) for x in names}


def test_the_smoothed_fit_is_that_of_dense_solves(spark):
    controls, obs = _model(np.random.default_rng(2), [4, 5], 3)
    links = [(r.a, r.b) for r in upm.linked(spark.createDataFrame(controls, "control long, tile long, gx long, gy long"), 1).collect()]
    assert any(a // 64 != b // 64 for a, b in links)
    o = spark.createDataFrame(obs, "frame long, control long, v double, unc double, w double").repartition(3)
    m, c = upm.fit_smoothed(o, spark.createDataFrame(links, "a long, b long"), 0.3, rounds=6)
    want_m, want_c = _dense_fit(obs, links, 0.3, 6)
    got_c = {(r.frame, r.control): r.c for r in c.collect()}
    for r in m.collect():
        assert r.m == pytest.approx(want_m[r.control], abs=1e-6)
    assert all(got_c.get(key, 0.0) == pytest.approx(x, abs=1e-6) for key, x in want_c.items())
    assert len(got_c) > len({(x[0], x[1]) for x in obs})  # controls without observations too


def test_without_smoothing_the_fits_agree(spark):
    _, obs = _model(np.random.default_rng(7), [3], 3)
    o = spark.createDataFrame(obs + [(1, 9999, None, 0.02, 1.0)], "frame long, control long, v double, unc double, w double")
    m, c = upm.fit(o, rounds=4, tolerance=0.0)
    m2, c2 = upm.fit_smoothed(o, spark.createDataFrame([(1, 2)], "a long, b long"), 0.0, rounds=4, tolerance=0.0)
    one, two = {r.control: r.m for r in m.collect()}, {r.control: r.m for r in m2.collect()}
    assert one.keys() == two.keys() and all(two[k] == pytest.approx(one[k], abs=1e-9) for k in one)
    got = {(r.frame, r.control): r.c for r in c2.collect()}
    assert all(got.get((r.frame, r.control), 0.0) == pytest.approx(r.c, abs=1e-9) for r in c.collect())


def test_links_are_those_of_distances(spark):
    tiles = [0, 1, 2, 3, 17, 40]
    controls = [(t * 64 + gx * 8 + gy, t, gx, gy) for t in tiles for gx in range(8) for gy in range(8)]
    df = spark.createDataFrame(controls, "control long, tile long, gx long, gy long")
    got = {(r.a, r.b) for r in upm.linked(df, 1).collect()}
    cells = hp.with_centre(df.withColumn("pix", df.tile * 64 + hp.morton(df.gx, df.gy)), 4).collect()
    v = {r.control: np.array([np.cos(np.radians(r.dec)) * np.cos(np.radians(r.ra)), np.cos(np.radians(r.dec)) * np.sin(np.radians(r.ra)), np.sin(np.radians(r.dec))]) for r in cells}
    limit = 1.6 * hp.resolution_arcsec(4) / 3600
    for a, t, gx, gy in controls:
        for b, u, hx, hy in controls:
            if a < b:
                gap = np.degrees(np.arccos(min(1.0, v[a] @ v[b])))
                if t == u:
                    assert ((a, b) in got) == (abs(gx - hx) + abs(gy - hy) == 1)
                elif (a, b) in got:
                    assert gap < limit
                else:
                    assert gap > 0.8 * limit / 1.6


def test_dense_fields_are_those_of_single_pixels(spark):
    rng = np.random.default_rng(4)
    nodes = spark.createDataFrame([(f, t, gx, gy, float(rng.normal())) for f in range(2) for t, xs, ys in ((1, range(8), range(8)), (2, range(2, 6), range(3, 4)), (3, range(5, 6), range(1, 3))) for gx in xs for gy in ys if rng.random() < 0.9], "frame long, tile long, gx long, gy long, c double")
    field = {(r.frame, r.tile): np.array(r.field).reshape(32, 32) for r in upm.dense(nodes, 4).collect()}
    pixels = spark.createDataFrame([(f, t, x, y) for f, t in field for x in range(32) for y in range(32)], "frame long, tile long, x long, y long").repartition(4)
    rows = upm.evaluate(pixels, nodes, 4).collect()
    assert len(rows) == 1024 * len(field)
    for r in rows:
        assert field[r.frame, r.tile][r.x, r.y] == pytest.approx(r.c, abs=1e-12)
