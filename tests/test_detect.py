"""Star detection on injected stars, whatever the tiles; profiles against a plain fit; repeats against a plain loop."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.operators import detect, psf
from skyloom.operators.detect import Detection


def _moffat(q, x, y):
    b, a, x0, y0, sx, sy, t = q
    u, v = x - x0, y - y0
    p, r = math.cos(t) * u + math.sin(t) * v, math.cos(t) * v - math.sin(t) * u
    return b + a * (1 + p * p / (2 * sx * sx) + r * r / (2 * sy * sy)) ** -4.0


@pytest.fixture(scope="module")
def sky():
    """A frame of 230 by 190 pixels with 40 stars of at least ten noises apart from one another, one saturated, and a gap."""
    rng = np.random.default_rng(12)
    y, x = np.mgrid[0:190, 0:230]
    image, stars = np.full(x.shape, 500.0), []
    for gx in range(8):
        for gy in range(5):
            q = (0.0, rng.uniform(80, 4000), 15 + gx * 28 + rng.uniform(-4, 4), 18 + gy * 37 + rng.uniform(-4, 4), rng.uniform(2, 3), rng.uniform(2, 3), rng.uniform(0, 3))
            image += _moffat(q, x, y)
            stars.append(q)
    image += rng.normal(0, 5, x.shape)
    return image, stars


def _rows(frame, image):
    return [(frame, int(i), int(j), float(image[j, i])) for j in range(image.shape[0]) for i in range(image.shape[1])]


@pytest.fixture(scope="module")
def pixels(spark, sky):
    image = sky[0].copy()
    image[100, 3] = np.nan
    return spark.createDataFrame(_rows(1, image) + _rows(2, np.round(image[:60, :80] / 2)), "frame int, x int, y int, value double").repartition(4).cache()


def test_stars_are_found_whatever_the_tiles(pixels, sky):
    got = {}
    for side in (64, 100, 256):
        rows = detect.stars(pixels, ["frame"], side=side).collect()
        got[side] = sorted((r.frame, r.y, r.x, r.cx, r.cy, r.sx, r.sy, r.amplitude, r.radius, r.saturated, tuple(r.cutout)) for r in rows)
    assert got[64] == got[100] == got[256]
    one = [r for r in got[64] if r[0] == 1]
    for q in sky[1]:
        near = [r for r in one if math.hypot(r[3] - q[2], r[4] - q[3]) < 1.0]
        assert len(near) == 1, q
        assert abs(near[0][5] - near[0][6]) < 1.5 and near[0][8] >= 5
    assert len(one) <= 41
    assert [r[0] for r in got[64]].count(2) >= 4


def test_levels(pixels, sky):
    r = {r.frame: r for r in detect.levels(pixels, ["frame"]).collect()}[1]
    flat = np.sort(sky[0].ravel())
    assert r.level == pytest.approx(flat[len(flat) // 2], abs=0.2) and r.noise == pytest.approx(5, rel=0.1) and r.brightest == flat[-1]


def test_a_plateau_is_saturated(spark):
    y, x = np.mgrid[0:80, 0:90]
    image = np.minimum(_moffat((100.0, 60000.0, 41.0, 39.0, 4.0, 4.0, 0.0), x, y), 8000.0) + np.random.default_rng(1).normal(0, 2, x.shape)
    (r,) = detect.stars(spark.createDataFrame(_rows(7, image), "frame int, x int, y int, value double"), ["frame"]).collect()
    assert r.saturated and math.hypot(r.cx - 41, r.cy - 39) <= 1.5


def test_filters_are_plain_ones():
    rng = np.random.default_rng(3)
    a = rng.normal(size=(12, 15))
    a[4, 5] = np.nan
    for y, x in ((0, 0), (5, 6), (11, 14), (4, 4)):
        part = a[max(0, y - 2) : y + 3, max(0, x - 2) : x + 3]
        assert detect.median_filtered(a, 2)[y, x] == pytest.approx(np.nanmedian(part))
        assert detect.extreme(a, 2, True)[y, x] == np.nanmax(part) and detect.extreme(a, 2, False)[y, x] == np.nanmin(part)
        disc = [a[j, i] for j in range(12) for i in range(15) if (j - y) ** 2 + (i - x) ** 2 <= 4 and np.isfinite(a[j, i])]
        assert detect.extreme(a, 2, True, circle=True)[y, x] == max(disc)
        w = np.exp(-0.5 * ((np.mgrid[0:12, 0:15][0] - y) ** 2 + (np.mgrid[0:12, 0:15][1] - x) ** 2) / 1.44)
        w[(np.abs(np.mgrid[0:12, 0:15][0] - y) > 5) | (np.abs(np.mgrid[0:12, 0:15][1] - x) > 5)] = 0
        w[~np.isfinite(a)] = 0
        assert detect.smoothed(a, 1.2)[y, x] == pytest.approx((np.nan_to_num(a) * w).sum() / w.sum())
    b = rng.normal(size=(20, 20))
    planes = detect.wavelet(b, 3)
    assert np.abs(planes.sum(axis=0) - b).max() < 1e-12
    k = np.array([1, 4, 6, 4, 1]) / 16
    assert planes[0][10, 10] == pytest.approx(b[10, 10] - (b[8:13, 8:13] * np.outer(k, k)).sum())


def _images(count, noise, seed):
    rng = np.random.default_rng(seed)
    y, x = np.mgrid[-10:11, -10:11]
    truth, out = [], []
    for _ in range(count):
        q = (rng.uniform(100, 900), rng.uniform(500, 5000), rng.uniform(-0.7, 0.7), rng.uniform(-0.7, 0.7), rng.uniform(1.2, 2.2), rng.uniform(2.6, 4.0), rng.uniform(0.1, 1.4))
        truth.append(q)
        out.append((_moffat(q, x, y) + rng.normal(0, noise, x.shape)).ravel())
    return np.array(truth), np.array(out)


def test_profiles_come_back():
    truth, images = _images(200, 0.0, 2)
    got = psf.fits(images, 21)
    assert (got["status"] == psf.DONE).all() and got["iterations"].max() < 100
    for k, c in enumerate(("background", "amplitude", "cx", "cy", "sx", "sy")):
        other = {"sx": "sy", "sy": "sx"}.get(c, c)
        off = np.minimum(np.abs(got[c] - truth[:, k]), np.abs(got[other] - truth[:, k]))
        assert (off <= 1e-5 * np.abs(truth[:, k]) + 1e-6).all(), c
    assert got["flux"] == pytest.approx(2 * np.pi * truth[:, 1] * truth[:, 4] * truth[:, 5] / 3, rel=1e-6)
    assert got["eccentricity"] == pytest.approx(np.sqrt(1 - (truth[:, 4] / truth[:, 5]) ** 2), rel=1e-5)
    assert got["residual"].max() < 1e-4
    truth, images = _images(100, 10.0, 3)
    got = psf.fits(images, 21)
    assert (got["status"] == psf.DONE).all()
    assert np.abs(got["cx"] - truth[:, 2]).max() < 0.25 and np.abs(got["flux"] / (2 * np.pi * truth[:, 1] * truth[:, 4] * truth[:, 5] / 3) - 1).max() < 0.2


def _plain_fit(v, width):
    """One image: the same steps with a numeric slope."""
    size = len(v) // width
    x, y = np.tile(np.arange(width) - width // 2, size), np.repeat(np.arange(size) - size // 2, width)
    base = psf.background(v[None], np.ones((1, len(v)), bool))[0]
    q, damp = np.array([base, v.max() - base, 0, 0, 0.15 * width, 0.15 * width, 0.0]), 1e-3
    for _ in range(200):
        e = v - _moffat(q, x, y)
        j = np.stack([(_moffat(q + h * np.eye(7)[k], x, y) - _moffat(q - h * np.eye(7)[k], x, y)) / (2 * h) for k in range(7) for h in [max(abs(q[k]) * 1e-6, 1e-8)]], axis=1)
        step = np.linalg.solve(j.T @ j + damp * np.eye(7), j.T @ e)
        if np.linalg.norm(step) < 1e-8 * np.linalg.norm(q):
            break
        if ((v - _moffat(q + step, x, y)) ** 2).sum() < (e * e).sum():
            q, damp = q + step, damp * 0.1
        else:
            damp *= 10
    return q


def test_batches_fit_as_single_images_do():
    _, images = _images(12, 20.0, 9)
    got = psf.fits(images, 21)
    for i, v in enumerate(images):
        q = _plain_fit(v, 21)
        assert [got[c][i] for c in ("background", "amplitude", "cx", "cy")] == pytest.approx(q[:4].tolist(), rel=1e-4, abs=1e-4)
        alone = psf.fits(images[i : i + 1], 21)
        assert all(alone[c][0] == pytest.approx(got[c][i], rel=1e-12, nan_ok=True) for c in got)


def test_failures_are_flagged(spark):
    truth, images = _images(3, 1.0, 5)
    images[1, 200:205] = np.nan
    rows = [(0, images[0].tolist()), (1, images[1].tolist()), (2, [5.0] * 441), (3, [math.nan] * 441), (4, [1.0, 2.0, 3.0] * 7), (5, None), (6, []), (7, [1.0] * 10), (8, (np.arange(441) * 100.0).tolist())]
    df = spark.createDataFrame(rows, "i int, c array<double>").repartition(2)
    got = {r.i: r.f for r in df.select("i", psf.fitted(F.col("c"), 21).alias("f")).collect()}
    assert got[0].status == got[1].status == psf.DONE
    assert got[1].amplitude == pytest.approx(truth[1][1], rel=0.05)
    assert got[2].status == got[3].status == psf.INVALID and math.isnan(got[2].flux)
    assert got[5] is None and got[6] is None and got[7] is None
    assert got[8].status in (psf.NO_CONVERGENCE, psf.LIMIT)


def test_repeats_go(spark):
    rng = np.random.default_rng(6)
    rows = [(int(rng.integers(0, 2)), i, float(np.round(rng.uniform(0, 30), 2)), float(np.round(rng.uniform(0, 30), 2)), int(rng.integers(5, 9)), bool(rng.random() < 0.2)) for i in range(500)]
    df = spark.createDataFrame([(f, int(cx), int(cy), cx, cy, r, s, i) for f, i, cx, cy, r, s in rows], "frame int, x int, y int, cx double, cy double, radius int, saturated boolean, i int").repartition(4)

    def greedy(stars, radius, open_end):
        kept = []
        for s in stars:
            if not any(t[0] == s[0] and (math.hypot(t[2] - s[2], t[3] - s[3]) < radius or not open_end and math.hypot(t[2] - s[2], t[3] - s[3]) == radius) for t in kept):
                kept.append(s)
        return kept

    lit = [r for r in rows if r[5]]
    plain = [r for r in rows if not r[5] and not any(t[0] == r[0] and math.hypot(t[2] - r[2], t[3] - r[3]) < 2 for t in lit)]
    got = [r.i for r in detect.deduplicated(df, ["frame"]).collect()]
    assert len(got) == len(set(got))
    sat = [r for r in rows if r[1] in got and r[5]]
    want = greedy(sorted(lit, key=lambda r: (-r[4], int(r[3]), int(r[2]))), 2.0, True)
    assert abs(len(sat) - len(want)) <= 2 and not [1 for a in sat for b in sat if a[1] < b[1] and a[0] == b[0] and math.hypot(a[2] - b[2], a[3] - b[3]) < 2]
    kept = [r for r in rows if r[1] in got and not r[5]]
    assert not [1 for a in kept for b in kept if a[1] < b[1] and a[0] == b[0] and math.hypot(a[2] - b[2], a[3] - b[3]) <= 1]
    assert all(any(t[0] == r[0] and math.hypot(t[2] - r[2], t[3] - r[3]) <= 1 for t in kept) for r in plain if r[1] not in got)
    line = spark.createDataFrame([(0, i, 0, i * 0.9, 0.0, 5, False) for i in range(12)], "frame int, x int, y int, cx double, cy double, radius int, saturated boolean")
    assert sorted(r.x for r in detect.deduplicated(line, ["frame"]).collect()) == [0, 2, 4, 6, 8, 10]


def test_copies_at_one_place_are_not_compared_with_one_another(spark, monkeypatch):
    met = []

    def counted(*args, **named):
        out = plane_join(*args, **named)
        met.append(out.count())
        return out

    from skyloom.operators.spatial import plane_join

    monkeypatch.setattr(detect, "plane_join", counted)
    rows = [(f, i, 10.0 * (i % 3) + 0.5 * (i % 2), 5.0, 10 * (i % 3), 5, 5, i % 10 == 0) for f in range(2) for i in range(300)]
    found = spark.createDataFrame(rows, "frame int, id int, cx double, cy double, x int, y int, radius int, saturated boolean")
    kept = detect.deduplicated(found, ["frame"]).select("frame", "x", "saturated").collect()
    assert sorted(map(tuple, kept)) == [(f, x, True) for f in range(2) for x in (0, 10, 20)]
    assert sum(met) < 100  # 2 frames of a few places each


def test_stars_of_patches_are_those_of_pixels(spark, sky):
    image = sky[0].copy()
    image[100, 3] = image[20:30, 40:60] = np.nan
    frames = {1: image, 2: np.round(image[:60, :80] / 2), 3: np.full((5, 7), np.nan)}
    cuts = lambda a, k: [(j, i, a[j : j + k, i : i + k]) for j in range(0, a.shape[0], k) for i in range(0, a.shape[1], k)]
    rows = [(f, i - 9, j - 70, v.shape[1], v.shape[0], v.ravel().tolist()) for f, a in frames.items() for j, i, v in cuts(a, 37)] + [(None, 0, 0, 1, 1, [1.0])]
    patches = spark.createDataFrame(rows, "frame int, left int, top int, wide int, high int, values array<double>").repartition(3)
    plain = lambda df: sorted((r.frame, r.y, r.x, r.cx, r.cy, r.sx, r.sy, r.amplitude, r.radius, r.saturated, str(r.cutout)) for r in df.collect())
    want = plain(detect.stars(detect.patch_pixels(patches, ["frame"]), ["frame"], side=64))
    assert len(want) > 40
    for whole in (1 << 20, 10_000, 10):  # each frame in one row, only the small ones, none
        assert plain(detect.stars_in_patches(patches, ["frame"], side=64, whole=whole)) == want


def test_rows_of_an_image_have_their_noises_at_once():
    import pyarrow as pa

    rng = np.random.default_rng(8)
    image = rng.normal(0, 3, (40, 50)) + 500 * (rng.random((40, 50)) > 0.9)
    image[rng.random(image.shape) > 0.8] = np.nan
    image[3], image[4, 1:], image[5, 2:] = np.nan, np.nan, np.nan
    image[4, 0] = image[5, 0] = image[5, 1] = 1.0
    rows = [r[~np.isnan(r)].tolist() for r in image if (~np.isnan(r)).any()]
    assert detect.row_noises(image).tolist() == detect._row_noise.func(pa.array(rows, pa.list_(pa.float64()))).to_pylist()
    assert detect.row_noises(np.full((3, 4), np.nan)).tolist() == []


def test_frames_of_stars_are_drawn_and_read_once(spark, tmp_path):
    from skyloom.plans import detect as plans

    spark.range(27).select(F.col("id").alias("c_custkey"), (F.col("id") * 300.0).alias("c_acctbal")).write.parquet(f"{tmp_path}/customer.parquet")
    got = plans.img_psf_width(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1
    assert sorted((r.frame, r.spot, r.width) for r in got.collect()) == [(k // 9, k % 9, round(1.5 + k % 7 / 10, 1)) for k in range(27)]


def test_repeats_are_sought_among_stars_that_are_there(spark, tmp_path, monkeypatch):
    from skyloom.plans import detect as plans

    spark.range(9).select(F.col("id").alias("c_custkey"), (F.col("id") * 300.0 + 50).alias("c_acctbal")).write.parquet(f"{tmp_path}/customer.parquet")
    seen = []
    monkeypatch.setattr(detect, "deduplicated", lambda found, by: seen.append(found) or found)
    assert plans.img_detect(spark, str(tmp_path)).count() == 9
    assert "MapInArrow" not in seen[0]._jdf.queryExecution().executedPlan().toString()  # else each step that follows finds them anew


def test_each_stage_of_the_orders_as_stars_drops_some(spark):
    import duckdb

    from skyloom import catalog

    sf = "/root/testdata/sf0.001"
    got = catalog.queries()["j_dedup_stars"](spark, sf).collect()
    rows = duckdb.sql(f"SELECT o_orderkey, o_totalprice FROM '{sf}/orders.parquet'").fetchall()
    stars = [(k // 1024, k, (k * k * 31 + k * 7919) % 16381 / 128, (k * k * 17 + k * 104729) % 16369 / 128, k * 37 % 11 + 5, v > 400000) for k, v in rows]

    def greedy(those, near):
        kept = []
        for s in those:
            if not any(t[0] == s[0] and near(math.hypot(t[2] - s[2], t[3] - s[3])) for t in kept):
                kept.append(s)
        return kept

    lit, plain = [s for s in stars if s[5]], [s for s in stars if not s[5]]
    lone = [s for s in plain if not any(t[0] == s[0] and math.hypot(t[2] - s[2], t[3] - s[3]) < 2 for t in lit)]
    bright = greedy(sorted(lit, key=lambda s: (-s[4], int(s[3]), int(s[2]), s[3], s[2])), lambda d: d < 2)
    by_place = greedy(sorted(lit, key=lambda s: (int(s[3]), int(s[2]), s[3], s[2])), lambda d: d < 2)
    first = greedy(sorted(lone, key=lambda s: (int(s[3]), int(s[2]), s[3], s[2])), lambda d: d <= 1)
    assert len(first) < len(lone) < len(plain) and len(bright) < len(lit) and {s[1] for s in bright} != {s[1] for s in by_place}
    assert sorted((r.frame, r.id, r.saturated) for r in got) == sorted((s[0], s[1], s[5]) for s in bright + first)
