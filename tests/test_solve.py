"""Pattern matching on a planted field, transforms against numpy, fits of planted distortion."""

from __future__ import annotations

import math

import numpy as np
import pytest

from skyloom.operators import solve


def _field(seed, n=18, false=0.3):
    rng = np.random.default_rng(seed)
    xy = rng.uniform(0, 1000, (n, 2))
    s, t = rng.uniform(0.5, 2), rng.uniform(-3, 3)
    moved = s * xy @ np.array([[math.cos(t), math.sin(t)], [-math.sin(t), math.cos(t)]]) + [30, -70]
    wrong = rng.random(n) < false
    moved = np.where(wrong[:, None], rng.uniform(0, 1000, (n, 2)), moved)
    return xy, moved, wrong, s, t


@pytest.fixture(scope="module")
def lists(spark):
    fields = {k: _field(k) for k in range(4)}
    left = spark.createDataFrame([(k, i, *map(float, p)) for k, f in fields.items() for i, p in enumerate(f[0])], "frame long, id long, x double, y double").repartition(3)
    right = spark.createDataFrame([(k, 100 + i, *map(float, p)) for k, f in fields.items() for i, p in enumerate(f[1])], "frame long, id long, x double, y double").repartition(5)
    return fields, left, right


def test_true_pairs_are_found_among_false_stars(lists):
    fields, left, right = lists
    voted = solve.votes(solve.triangles(left, ["frame"]), solve.triangles(right, ["frame"]), ["frame"])
    got = {(r.frame, r.u): r.w for r in solve.consensus(voted, ["frame"]).collect()}
    true = [(k, i) for k, f in fields.items() for i in range(18) if not f[2][i]]
    assert sum(got.get((k, i)) == 100 + i for k, i in true) >= 0.95 * len(true)
    pairs = solve.consensus(voted, ["frame"]).join(left.withColumnRenamed("id", "u"), ["frame", "u"]).join(right.selectExpr("frame", "id as w", "x as x2", "y as y2"), ["frame", "w"])
    fit, kept = solve.consistent(pairs, ["frame"], 0.01)
    again, _ = solve.consistent(pairs.repartition(7), ["frame"], 0.01)
    one, two = ({r.frame: r for r in x.collect()} for x in (fit, again))
    for k, (_, _, wrong, s, t) in fields.items():
        assert one[k].scale == pytest.approx(s, abs=1e-9) and math.remainder(one[k].theta - t, 2 * math.pi) == pytest.approx(0, abs=1e-9)
        assert (one[k].tx, one[k].ty) == (pytest.approx(30, abs=1e-6), pytest.approx(-70, abs=1e-6)) and one[k].rms < 1e-9
        assert one[k].n >= 0.95 * (~wrong).sum() and one[k].n == two[k].n
    assert all(r.w == 100 + r.u for r in kept.collect())


def test_triangles_are_those_of_plain_triples(lists):
    fields, left, _ = lists
    got = {(r.frame, frozenset((r.a, r.b, r.c))): r for r in solve.triangles(left, ["frame"]).collect()}
    for k, f in fields.items():
        for i in range(18):
            for j in range(i + 1, 18):
                for m in range(j + 1, 18):
                    sides = sorted([(math.dist(f[0][i], f[0][j]), m), (math.dist(f[0][i], f[0][m]), j), (math.dist(f[0][j], f[0][m]), i)])
                    r = got.get((k, frozenset((i, j, m))))
                    if sides[1][0] / sides[2][0] > 0.9:
                        assert r is None
                    else:
                        assert (r.c, r.b, r.a) == tuple(v for _, v in sides) and r.ca == pytest.approx(sides[0][0] / sides[2][0])


def test_scale_limits_votes(lists):
    fields, left, right = lists
    a, b = solve.triangles(left, ["frame"]), solve.triangles(right, ["frame"])
    s = 1 / fields[2][3]
    some = {(r.u, r.w): r.votes for r in solve.votes(a, b, ["frame"], scale=(0.99 * s, 1.01 * s)).where("frame = 2").collect()}
    every = {(r.u, r.w): r.votes for r in solve.votes(a, b, ["frame"]).where("frame = 2").collect()}
    assert sum(some.values()) < sum(every.values()) and all(every[k] >= n for k, n in some.items())
    assert all(some[i, 100 + i] == max(n for (u, _), n in some.items() if u == i) for i in range(18) if not fields[2][2][i])


def test_similarity_is_least_squares(spark):
    rng = np.random.default_rng(1)
    u = rng.normal(size=(30, 2)) * 50
    w = u @ np.array([[1.2, 0.5], [-0.5, 1.2]]) + [3, 4] + rng.normal(0, 0.3, (30, 2))
    df = spark.createDataFrame([(1, *map(float, [*a, *b])) for a, b in zip(u, w, strict=True)] + [(2, 1.0, 1.0, 2.0, 2.0), (3, 1.0, 1.0, 5.0, 5.0), (3, 1.0, 1.0, 6.0, 5.0)], "f int, x double, y double, x2 double, y2 double")
    got = {r.f: r for r in solve.similarity(df, ["f"]).collect()}
    a = np.concatenate([np.stack([u[:, 0], -u[:, 1], np.ones(30), np.zeros(30)], 1), np.stack([u[:, 1], u[:, 0], np.zeros(30), np.ones(30)], 1)])
    p, q, tx, ty = np.linalg.lstsq(a, np.concatenate([w[:, 0], w[:, 1]]), rcond=None)[0]
    assert (got[1].scale, got[1].theta, got[1].tx, got[1].ty) == (pytest.approx(math.hypot(p, q)), pytest.approx(math.atan2(q, p)), pytest.approx(tx), pytest.approx(ty))
    assert got[2].scale is None and got[3].scale is None


def test_polynomials_come_back_and_irls_is_numpys(spark):
    rng = np.random.default_rng(3)
    terms = solve.polynomial_terms(3)
    x, y = rng.uniform(-2000, 2000, (2, 400))
    c = np.array([0.5, 1e-3, -2e-3, 3e-6, -1e-6, 2e-6, 1e-9, 0, -2e-9, 5e-10])
    m = np.stack([x**p * y**q for p, q in terms], 1)
    clean, dirty = m @ c, m @ c + rng.normal(0, 0.1, 400) + np.where(rng.random(400) < 0.1, 20, 0)
    df = spark.createDataFrame([(0, *map(float, r)) for r in zip(x, y, clean, dirty, strict=True)] + [(1, 1.0, 2.0, 3.0, 4.0), (0, None, 1.0, 1.0, 1.0)], "f int, x double, y double, clean double, dirty double").repartition(4)
    got = {(r.f, r.target): r for r in solve.polynomial_fit(df, ["f"], ["clean", "dirty"], 3, rounds=4).collect()}
    assert set(got) == {(0, "clean"), (0, "dirty")} and got[0, "clean"].n == 400
    assert np.abs(m @ np.array(got[0, "clean"].coefficients) - clean).max() < 1e-9
    u = np.abs(np.concatenate([x, y])).max()
    scaled, w = m / u ** np.array([p + q for p, q in terms]), np.ones(400)
    for k in range(5):
        sol = np.linalg.solve((scaled * w[:, None]).T @ scaled, (scaled * w[:, None]).T @ dirty)
        e = np.abs(dirty - scaled @ sol)
        sigma = 1.4826 * np.median(e)
        w = np.where(e <= 1.345 * sigma, 1, 1.345 * sigma / e)
    assert m @ np.array(got[0, "dirty"].coefficients) == pytest.approx(scaled @ sol, abs=1e-6)
    assert got[0, "dirty"].sigma == pytest.approx(sigma, rel=1e-6)


def test_a_mirrored_list_keeps_both_ways_and_takes_the_least_turn(spark):
    voted = spark.createDataFrame([(0, 1, 1, 26), (0, 1, 4, 27), (0, 4, 4, 27), (0, 4, 1, 28), (0, 1, 9, 8)], "frame int, u int, w int, votes int")
    assert sorted((r.u, r.w) for r in solve.likely(voted, ["frame"]).collect()) == [(1, 1), (1, 4), (4, 1), (4, 4)]
    xy = [(0.0, 0.0), (7.0, 1.0), (3.0, 5.0), (4.0, -4.0)]  # the last two and the first two change places at half a turn
    pairs = [(0, i, j, *xy[i], *xy[j]) for i, j in [(k, k) for k in range(4)] + [(0, 1), (1, 0), (2, 3), (3, 2)]]
    fit, _ = solve.consistent(spark.createDataFrame(pairs, "frame int, u int, w int, x double, y double, x2 double, y2 double"), ["frame"], 0.01)
    (one,) = fit.collect()
    assert one.theta == pytest.approx(0.0, abs=1e-9) and one.scale == pytest.approx(1.0)


def test_true_pairs_that_a_hundred_draws_can_miss_are_found():
    """Nine true pairs of 40 beside six of the list turned about: two true ones are drawn once in 22 times."""
    rng = np.random.default_rng(8)
    for k in range(60):
        xy = rng.uniform(0, 1000, (40, 2))
        moved = rng.uniform(0, 1000, (40, 2))
        at = rng.permutation(40)
        turned = lambda t, p: 0.8 * p @ np.array([[math.cos(t), math.sin(t)], [-math.sin(t), math.cos(t)]])
        moved[at[:9]], moved[at[9:15]] = turned(-0.6, xy[at[:9]]) + [3, 4], turned(2.5, xy[at[9:15]]) + [900, 700]
        a, b, tx, ty = solve._best(*xy.T, *moved.T, 0.01, 100, 1e-6, 1e-9)
        assert (math.hypot(a, b), math.atan2(b, a), tx, ty) == tuple(pytest.approx(v, abs=1e-6) for v in (0.8, -0.6, 3, 4)), k


def test_transforms_of_many_frames_with_few_true_pairs(spark):
    rng = np.random.default_rng(9)
    rows = []
    for f in range(150):
        xy, moved = rng.uniform(0, 1000, (40, 2)), rng.uniform(0, 1000, (40, 2))
        moved[:7] = xy[:7] * 1.5 + [10, 20]
        rows += [(f, i, i, *map(float, (*p, *q))) for i, (p, q) in enumerate(zip(xy, moved, strict=True))]
    rows += [(900, 1, 1, 0.0, 0.0, 1.0, 1.0), (901, 1, 1, 0.0, 0.0, 1.0, 1.0), (901, 2, 2, None, 0.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "frame int, u int, w int, x double, y double, x2 double, y2 double").repartition(5)
    fit, kept = solve.consistent(df, ["frame"], 0.01)
    got = fit.collect()
    assert sorted(r.frame for r in got) == list(range(150)) and all(r.scale == pytest.approx(1.5) and r.theta == pytest.approx(0, abs=1e-9) and r.n == 7 for r in got)
    assert kept.count() == 7 * 150
