from __future__ import annotations

import numpy as np
import pytest

from skyloom.operators import overlap, photometry, structures, upm


def _area(poly):
    x, y = np.array(poly).T
    return abs((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2


def test_overlaps_of_random_quads_add_up():
    rng = np.random.default_rng(1)
    a = np.sort(rng.uniform(0, 2 * np.pi, (300, 4)), axis=1)
    x, y = 2 + 1.4 * np.cos(a), 2 + 1.4 * np.sin(a)
    total = sum(overlap.cell_overlap(x, y, np.full(300, i), np.full(300, j)) for i in range(4) for j in range(4))
    assert total == pytest.approx([_area(list(zip(*p, strict=True))) for p in zip(x, y, strict=True)], abs=1e-9)


def test_overlap_of_cells_inside_and_outside():
    x, y = np.array([[0.0, 4.0, 4.0, 0.0]] * 3), np.array([[0.0, 0.0, 4.0, 4.0]] * 3)
    assert overlap.cell_overlap(x, y, np.array([1, 9, 3]), np.array([2, 1, -1])).tolist() == [1.0, 0.0, 0.0]


def test_akima_keeps_nodes_and_lines():
    x = np.array([0.0, 1.0, 2.5, 4.0, 7.0])
    y = np.array([1.0, 3.0, -2.0, 0.5, 9.0])
    assert photometry.akima(x, y, x) == pytest.approx(y)
    at = np.linspace(0, 7, 29)
    assert photometry.akima(x, 2 * x - 3, at) == pytest.approx(2 * at - 3)
    assert photometry.akima(x, y, np.array([-1.0, 8.0])).tolist() == [0.0, 0.0]
    assert photometry.akima(x[:2], y[:2], np.array([0.5])) == pytest.approx([2.0])


def _plain_akima(x, y, at):
    """One place, by the textbook: slopes weighted by the differences of their neighbours, then Hermite's cubic."""
    if not x[0] <= at <= x[-1]:
        return 0.0
    m = [(y[i + 1] - y[i]) / (x[i + 1] - x[i]) for i in range(len(x) - 1)]
    m = [3 * m[0] - 2 * m[1], 2 * m[0] - m[1], *m, 2 * m[-1] - m[-2], 3 * m[-1] - 2 * m[-2]] if len(m) > 1 else m * 5
    t = []
    for i in range(len(x)):
        a, b = abs(m[i + 3] - m[i + 2]), abs(m[i + 1] - m[i])
        t.append((m[i + 1] + m[i + 2]) / 2 if a + b == 0 else (a * m[i + 1] + b * m[i + 2]) / (a + b))
    i = max(k for k in range(len(x) - 1) if x[k] <= at)
    h = x[i + 1] - x[i]
    s = (at - x[i]) / h
    return (1 + 2 * s) * (1 - s) ** 2 * y[i] + s * (1 - s) ** 2 * h * t[i] + s * s * (3 - 2 * s) * y[i + 1] + s * s * (s - 1) * h * t[i + 1]


def _plain_flux(wl, spectrum, mag, curves):
    sets = [sorted({a: b for a, b in reversed(list(zip(*c, strict=True)))}.items()) for c in [(wl, [v * 10 ** (-0.4 * mag) for v in spectrum]), *curves]]
    low, high = max(c[0][0] for c in sets), min(c[-1][0] for c in sets)
    if high <= low:
        return 0.0
    grid = [low + i for i in range(int(high - low + 0.5) + 1)]
    y = [np.prod([_plain_akima(*zip(*c, strict=True), g) for c in sets]) * g for g in grid]
    n = len(y) - 1
    if n == 1:
        return (y[0] + y[1]) / 2
    even = n if n % 2 == 0 else n - 3
    total = sum((y[i] + 4 * y[i + 1] + y[i + 2]) / 3 for i in range(0, even, 2))
    return total if even == n else total + (y[-4] + 3 * y[-3] + 3 * y[-2] + y[-1]) * 3 / 8


@pytest.mark.parametrize("ends", [(350.0, 372.0), (351.0, 372.0), (350.2, 371.9), (350.0, 351.0), (350.0, 352.0), (350.0, 353.0), (500.0, 520.0)])
def test_catalog_fluxes_are_those_of_a_plain_loop(spark, ends):
    rng = np.random.default_rng(5)
    wl = [340.0, 343.0, 343.0, 350.0, 347.0, 360.0, 372.0, 381.5, 390.0]
    middle = sorted(rng.uniform(*ends, 4))
    band, detector = ([ends[0], *middle, ends[1]], [0.0, 0.5, 0.9, 0.7, 0.3, 0.1]), ([300.0, 355.0, 420.0], [0.3, 0.8, 0.6])
    rows = [(k, [int(v) for v in rng.integers(0, 256, 9)], float(rng.uniform(2, 8))) for k in range(40)] + [(40, [7] * 9, 3.0)]
    odd = [(41, [1, 2], 3.0), (42, None, 3.0), (43, [1] * 9, None), (44, [], 3.0), (45, [1] * 8 + [None], 3.0)]
    df = spark.createDataFrame(rows + odd, "id long, s array<int>, mag double")
    for curves in ([band, detector], [band]):
        flux = photometry.catalog_flux(df.s, df.mag, wl, *curves, rows=16)
        got = {r.id: r.flux for r in df.select("id", flux.alias("flux")).collect()}
        for k, s, mag in rows:
            assert got[k] == pytest.approx(_plain_flux(wl, s, mag, curves), rel=1e-9, abs=1e-12)
        assert (got[41], got[42], got[43], got[44], got[45]) == (0.0, None, None, 0.0, None)


def test_zero_points_pass_over_outliers(spark):
    rng = np.random.default_rng(3)
    rows = [(1, float(r)) for r in rng.normal(0.5, 0.01, 200)] + [(1, 3.0)] * 10 + [(2, 0.25)] * 4 + [(3, 1.0)]
    fits, told = photometry.zero_points(spark.createDataFrame(rows, "frame long, r double"), ["frame"], "r")
    got = {r.frame: r for r in fits.collect()}
    assert got[1].location == pytest.approx(0.5, abs=0.005) and got[1].n <= 200 and got[1].scale == pytest.approx(10 ** -got[1].location)
    assert (got[2].location, got[2].n, got[3].sigma) == (0.25, 4, 0.0)
    assert told.where("frame = 1 AND r = 3.0 AND reason <> 2").isEmpty()


def _plain_zero_point(stars, kept=1.0, rounds=50):
    reasons = []
    for f, s, mag in stars:
        sound = f is not None and s is not None and mag is not None and f > 0 and s > 0 and np.isfinite([f, s, mag]).all()
        reasons.append(5 if s is None and mag is None else None if sound else 3)
    use = [i for i, x in enumerate(reasons) if x is None]
    delta = {i: -2.5 * np.log10(stars[i][0]) - stars[i][2] for i in use}
    mid = np.median(list(delta.values())) if use else 0.0
    for i in use:
        reasons[i] = 1 if abs(delta[i] - mid) > kept else None
    use = [i for i in use if reasons[i] is None]
    if not use:
        return 0.0, 0.0, reasons
    r = np.array([np.log10(stars[i][0] / stars[i][1]) for i in use])
    loc = np.median(r)
    spread = np.median(abs(r - loc)) / 0.6745
    for _ in range(rounds if spread > 0 else 0):
        u = (r - loc) / (4.685 * spread)
        w = np.where(abs(u) < 1, (1 - u * u) ** 2, 0)
        before, loc = loc, (w * r).sum() / w.sum()
        if abs(loc - before) < 1e-10:
            break
    inside = (abs(r - loc) < 4.685 * spread) | (spread <= 0)
    for i, x in zip(use, inside, strict=True):
        reasons[i] = 0 if x else 2
    return loc, np.median(abs(r[inside] - loc)) / 0.6745, reasons


def test_calibration_tells_every_star_why(spark):
    rng = np.random.default_rng(8)
    rows = []
    for frame, n in enumerate([400, 61, 7, 2, 1]):
        for i in range(n):
            s = float(rng.uniform(1, 50))
            f = s * 10 ** float(rng.normal(0.2 * frame, 0.02)) * (1.6 if i % 9 == 4 else 1)
            mag = -2.5 * np.log10(s) + float(rng.normal(0, 0.02)) + (3 if i % 11 == 5 else 0)
            odd = {2: (None, s, mag), 3: (f, None, None), 4: (-f, s, mag), 5: (float("nan"), s, mag), 6: (f, s, float("inf")), 7: (f, s, None)}.get(i % 13, (f, s, mag))
            rows.append((frame, len(rows), *[None if x is None else float(x) for x in odd]))
    rows += [(5, len(rows), 0.0, 1.0, 2.0), (5, len(rows) + 1, 1.0, None, None), (6, len(rows) + 2, 2.0, 1.0, 0.0), (6, len(rows) + 3, 2.0, 1.0, 0.0), (None, len(rows) + 4, 2.0, 1.0, 0.0)]
    df = spark.createDataFrame(rows, "frame long, star long, f double, s double, mag double")
    fits, told = photometry.calibrated(df, ["frame"], "f", "s", "mag")
    reasons = {r.star: r.reason for r in told.collect()}
    got = {r.frame: r for r in fits.collect()}
    for frame in range(7):
        mine = [r for r in rows if r[0] == frame]
        loc, sigma, want = _plain_zero_point([r[2:] for r in mine])
        assert [reasons[r[1]] for r in mine] == want, frame
        assert (got[frame].location, got[frame].sigma) == pytest.approx((loc, sigma), abs=1e-9)
        assert [got[frame][k] for k in photometry.REASONS] == [want.count(v) for v in photometry.REASONS.values()]
    assert reasons[rows[-1][1]] == 3 and {0, 1, 2, 3, 5} == set(reasons.values())
    assert 1 < got[0].rounds <= 50 and (got[5].scale, got[5].n, got[6].rounds) == (1.0, 0, 0)
    assert told.columns == [*df.columns, "reason"] and photometry.calibrated(df.where("false"), ["frame"], "f", "s", "mag")[0].isEmpty()


def test_only_lines_long_enough_grow(spark):
    line = [(0, x, 20) for x in range(10, 22)]
    block = [(0, x, y) for x in (40, 41) for y in (5, 6)]
    corner = [(1, i, i) for i in range(8)]
    got = {(r.frame, r.x, r.y) for r in structures.grown(spark.createDataFrame(line + block + corner, "frame long, x long, y long"), 64, 64).collect()}
    want = {(0, x + i, 20 + j) for _, x, _ in line for i in range(-2, 3) for j in range(-2, 3)} | set(block)
    want |= {(1, x + i, y + j) for _, x, y in corner for i in range(-2, 3) for j in range(-2, 3) if x + i >= 0 and y + j >= 0}
    assert got == want


def test_fields_of_frames_are_found(spark):
    obs = [(f, k, 10.0 + k + 0.3 * f * k, 0.05, 1.0 / 3) for f in range(3) for k in range(6)]
    m, c = upm.fit(spark.createDataFrame(obs, "frame long, control long, v double, unc double, w double"), rounds=20, anchor=0.0)
    assert all(r.m == pytest.approx(10 + r.control) for r in m.collect())
    assert all(r.c == pytest.approx(0.3 * r.frame * r.control, abs=1e-6) for r in c.collect())


def _plain_fit(obs, rounds, tolerance, anchor):
    """The joint model of one component whose reference is its least frame, row by row."""
    ref = min(o[0] for o in obs)
    controls, pairs = {o[1] for o in obs}, {o[:2] for o in obs}
    m = {k: sum(o[4] * o[2] for o in obs if o[1] == k) / sum(o[4] for o in obs if o[1] == k) for k in controls}
    c = dict.fromkeys(pairs, 0.0)
    for n in range(1, rounds + 1):
        h = {}
        for o in obs:
            e = abs(o[2] - m[o[1]] - c[o[:2]]) / max(abs(o[3]), 1e-3)
            h[o] = o[4] * (1 if e <= 1.345 else 1.345 / e)
        new_m, new_c = {}, {}
        for k in controls:
            of_ref = [o for o in obs if o[1] == k and o[0] == ref]
            use = of_ref if sum(h[o] for o in of_ref) > 1e-12 else [o for o in obs if o[1] == k]
            new_m[k] = sum(h[o] * (o[2] - c[o[:2]]) for o in use) / sum(h[o] for o in use)
        for f, k in pairs:
            use = [o for o in obs if o[:2] == (f, k)]
            new_c[f, k] = 0.0 if f == ref else sum(h[o] * (o[2] - new_m[k]) for o in use) / (sum(h[o] for o in use) + anchor)
        moved = max([abs(new_m[k] - m[k]) for k in m] + [abs(new_c[p] - c[p]) for p in c])
        m, c = new_m, new_c
        if moved < tolerance:
            break
    return n, m, c


def test_the_joint_model_is_a_plain_loop_run_to_its_tolerance(spark):
    rng = np.random.default_rng(5)
    obs = [(f, k, float(rng.normal(10 + k + 0.2 * f, 0.05 if rng.random() < 0.8 else 2.0)), float(rng.uniform(0, 0.1)), float(rng.uniform(0.1, 1))) for f in range(4) for k in range(5) for _ in range(3) if (f, k) != (0, 2)]
    frame = spark.createDataFrame(obs, "frame long, control long, v double, unc double, w double")
    n, m, c = _plain_fit(obs, 100, 1e-6, 1e-3)
    assert n > 3
    got_m, got_c = upm.fit(frame)
    assert {r.control: r.m for r in got_m.collect()} == pytest.approx(m, abs=1e-10)
    assert {(r.frame, r.control): r.c for r in got_c.collect()} == pytest.approx(c, abs=1e-10)


def test_observations_with_nulls_weigh_nothing(spark):
    rows = [(0, 1, 5.0, 0.1, 1.0), (1, 1, 7.0, 0.1, 1.0), (1, 1, None, 0.1, 1.0), (1, 1, 9.0, 0.1, None), (2, 1, None, 0.1, 1.0)]
    m, c = upm.fit(spark.createDataFrame(rows, "frame long, control long, v double, unc double, w double"), anchor=0.0)
    assert [r.m for r in m.collect()] == [5.0]
    assert {r.frame: r.c for r in c.collect()} == {0: 0.0, 1: pytest.approx(2.0), 2: 0.0}
    empty = upm.fit(spark.createDataFrame([], "frame long, control long, v double, unc double, w double"))
    assert [x.count() for x in empty] == [0, 0]


def test_fields_go_on_beyond_their_nodes(spark):
    nodes = spark.createDataFrame([(0, 7, x, y, 2.0 * (x * 64 + 32) + 3.0 * (y * 64 + 32)) for x in (2, 3, 4) for y in (1, 2)], "frame long, tile long, gx long, gy long, c double")
    pixels = spark.createDataFrame([(0, 7, 0, 0), (0, 7, 511, 300), (0, 7, 160, 96), (0, 8, 1, 1)], "frame long, tile long, x long, y long")
    got = {(r.tile, r.x, r.y): r.c for r in upm.evaluate(pixels, nodes).collect()}
    assert got == {(7, 0, 0): 0.0, (7, 511, 300): pytest.approx(2 * 511 + 900), (7, 160, 96): pytest.approx(320 + 288), (8, 1, 1): 0.0}
