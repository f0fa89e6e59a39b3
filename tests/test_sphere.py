"""Polygons on the sphere against sums that must close, dense samples, and the join the other way round."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.operators import sphere
from skyloom.operators import sphere as sp

PLACES = [(0.0, 0.0), (359.9999, 10.0), (45.0, 41.8103), (123.4, -41.8103), (90.0, 89.9), (10.0, 90.0), (200.0, -90.0), (271.3, -88.0), (180.0, 1e-9), (315.0, 0.0), (33.3, 66.6)]


def _pixels(scale, sip=False, turn=0.3):
    out = []
    for k, (ra, dec) in enumerate(PLACES):
        c, s = scale * math.cos(turn + k), scale * math.sin(turn + k)
        for x, y in ((10.0, 12.0), (9.0, 12.0), (31.5, -4.25)):
            row = [k, x, y, ra, dec, 10.0, 12.0, -c, s, s, c]
            if sip:
                a, b = [0.0] * 36, [0.0] * 36
                a[12], a[7], b[2], b[18] = 2e-5, -3e-5, 1e-5, 1e-7
                row += [a, b]
            out.append(tuple(row))
    return out


SCHEMA = "frame int, x double, y double, ra0 double, dec0 double, px0 double, py0 double, cd11 double, cd12 double, cd21 double, cd22 double"


@pytest.mark.parametrize("order", [0, 1, 2, 4])
def test_cells_fill_the_sphere(order):
    pix = np.arange(12 * 4**order)
    poly, n = sp.cell_outlines(pix, order)
    own = sp.area(poly, n)
    assert (own > 0).all()
    assert own.sum() == pytest.approx(4 * math.pi, rel=1e-12)
    assert own == pytest.approx(np.full(len(pix), 4 * math.pi / len(pix)), rel=2e-5)
    four, m = sp.cell_outlines(pix, order, depth=0)
    assert set(m.tolist()) == {4} and sp.area(four, m).sum() == pytest.approx(4 * math.pi, rel=1e-12)


def test_centres_lie_in_their_cells(spark):
    for order in (0, 3, 5):
        v = sp.cell_centres(np.arange(12 * 4**order), order)
        rows = [(i, float(np.degrees(np.arctan2(p[1], p[0]))) % 360, float(np.degrees(np.arcsin(p[2])))) for i, p in enumerate(v)]
        df = spark.createDataFrame(rows, "i long, ra double, dec double")
        assert df.where(hp.ang2pix(order, F.col("ra"), F.col("dec")) != F.col("i")).count() == 0


def test_no_cell_reaches_beyond_its_radius():
    for order in (0, 1, 2, 3, 4):
        pix = np.arange(12 * 4**order)
        poly, n = sp.cell_outlines(pix, order)
        gap = np.linalg.norm(poly - sp.cell_centres(pix, order)[:, None], axis=-1)[np.arange(poly.shape[1])[None, :] < n[:, None]]
        assert 2 * np.arcsin(gap.max() / 2) <= sp.cell_radius(order)


@pytest.mark.parametrize(("scale", "order", "sip"), [(0.3, 6, False), (0.3, 8, True), (4.0, 3, False), (6e-4, 16, False), (0.02, 4, True), (1.0, 9, False)])
def test_shares_of_a_drop_add_up(spark, scale, order, sip):
    df = spark.createDataFrame(_pixels(scale, sip), SCHEMA + (", sip_a array<double>, sip_b array<double>" if sip else "")).repartition(4)
    got = sp.pixel_overlaps(df, order).groupBy("frame", "x", "y").agg(F.sum("weight").alias("w"), F.min("weight").alias("least"), F.first("drop_area").alias("a")).collect()
    assert len(got) == 3 * len(PLACES)
    for r in got:
        assert r.w == pytest.approx(1.0, abs=1e-10), r
        assert r.least > 0 and r.a > 0


def test_shares_are_those_of_dense_samples(spark):
    df = spark.createDataFrame(_pixels(0.7, True), SCHEMA + ", sip_a array<double>, sip_b array<double>")
    got = {}
    for r in sp.pixel_overlaps(df, 6).collect():
        got.setdefault((r.frame, r.x, r.y), {})[r.pix] = r.weight
    side = 150
    rows = []
    for r in _pixels(0.7, True):
        g = (np.arange(side) + 0.5) / side - 0.5
        x, y = (a.ravel() for a in np.meshgrid(r[1] + g, r[2] + g))
        f = sp.Frames({c: np.full(len(x), v) for c, v in zip(sp.WCS, r[3:11], strict=True)}, np.tile(r[11], (len(x), 1)), np.tile(r[12], (len(x), 1)))
        v = f.sky(x, y)
        back = f.pixel(v)
        assert np.abs(back[0] - x).max() < 1e-6 and np.abs(back[1] - y).max() < 1e-6
        rows.append((r[0], r[1], r[2], (np.degrees(np.arctan2(v[:, 1], v[:, 0])) % 360).tolist(), np.degrees(np.arcsin(np.clip(v[:, 2], -1, 1))).tolist()))
    dense = spark.createDataFrame(rows, "frame int, x double, y double, ra array<double>, dec array<double>").repartition(4)
    flat = dense.select("frame", "x", "y", F.explode(F.arrays_zip("ra", "dec")).alias("p")).select("frame", "x", "y", hp.ang2pix(6, F.col("p.ra"), F.col("p.dec")).alias("pix"))
    for r in flat.groupBy("frame", "x", "y", "pix").count().collect():
        assert got[r.frame, r.x, r.y].get(r.pix, 0.0) == pytest.approx(r["count"] / side**2, abs=0.01)


def test_a_drop_within_a_cell_and_around_cells(spark):
    df = spark.createDataFrame([(0, 0.0, 0.0, 30.0, 20.0, 0.0, 0.0, 1e-5, 0.0, 0.0, 1e-5)], SCHEMA)
    (one,) = sp.pixel_overlaps(df, 3).collect()
    assert one.weight == pytest.approx(1.0, abs=1e-10)
    wide = spark.createDataFrame([(0, 0.0, 0.0, 30.0, 20.0, 0.0, 0.0, 20.0, 0.0, 0.0, 20.0)], SCHEMA)
    whole = 4 * math.pi / (12 * 4**5)
    inside = [r for r in sp.pixel_overlaps(wide, 5).collect() if r.weight * r.drop_area > 0.9999 * whole]
    assert len(inside) > 20 and all(r.weight * r.drop_area == pytest.approx(whole, rel=1e-4) for r in inside)
    assert sp.pixel_overlaps(spark.createDataFrame([(0, 0.0, 0.0, None, 20.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0), (0, 0.0, 0.0, 3.0, 20.0, 0.0, 0.0, 0.0, 0.0, 0.0, 1.0)], SCHEMA), 3).count() == 0


@pytest.mark.parametrize("sip", [False, True])
def test_the_reverse_join_finds_the_same_areas(spark, sip):
    extra = ", sip_a array<double>, sip_b array<double>" if sip else ""
    for k in (2,) if sip else (0, 4, 10):
        frame = next(r for r in _pixels(0.5, sip) if r[0] == k)
        pixels = spark.createDataFrame([(k, float(x), float(y), *frame[3:]) for x in range(5, 16) for y in range(7, 17)], SCHEMA + extra).repartition(4)
        forward = {(r.x, r.y, r.pix): r.weight * r.drop_area for r in sp.pixel_overlaps(pixels, 6, least=1e-12).collect()}
        cells = spark.createDataFrame([(p, *frame[3:]) for p in {key[2] for key in forward}], "pix long, " + SCHEMA.split(", ", 3)[3] + extra).repartition(4)
        back = sp.cell_overlaps(cells, 6, 24, 24, least=1e-12).cache()
        reverse = {(r.x, r.y, r.pix): r.weight * r.drop_area for r in back.collect()}
        assert len(forward) > 100 and forward.keys() <= reverse.keys()
        for key, shared in forward.items():
            assert reverse[key] == pytest.approx(shared, rel=1e-7, abs=1e-11)
        made = sp.reverse_drizzled(back.withColumns({"s": F.lit(2.0), "one": F.lit(1.0)}), ["ra0"], "s", "one").collect()
        whole = [r for r in made if 5 <= r.x < 16 and 7 <= r.y < 17]
        assert len(whole) == 110 and all(r.coverage == pytest.approx(1.0, abs=1e-7) for r in whole)
        back.unpersist()


def test_shrunk_cells_keep_their_signal(spark):
    cells = spark.createDataFrame([(p, *_pixels(0.5)[0][3:]) for p in range(12 * 4**5)], "pix long, " + SCHEMA.split(", ", 3)[3])
    met = sp.cell_overlaps(cells, 5, 24, 24, shrink=0.6)
    inner = met.groupBy("pix").agg(F.sum("weight").alias("w"), F.first("drop_area").alias("a"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1")).where("x0 > 0 and y0 > 0 and x1 < 23 and y1 < 23").collect()
    assert len(inner) > 5
    for r in inner:
        assert r.w == pytest.approx(1.0, abs=1e-8)
        assert r.a == pytest.approx(0.36 * 4 * math.pi / (12 * 4**5), rel=1e-3)


@pytest.mark.parametrize("radius", [0.5, 7.0, 60.0, 179.9])
def test_discs(spark, radius):
    points = spark.createDataFrame([(i, ra, dec) for i, (ra, dec) in enumerate(PLACES)] + [(99, None, 1.0)], "i int, ra0 double, dec0 double").repartition(3)
    inside, touched = ({}, {})
    for out, touching in ((inside, False), (touched, True)):
        for r in sp.cells_in_disc(points, radius, 4, touching=touching).collect():
            out.setdefault(r.i, set()).add(r.pix)
    v = sp.cell_centres(np.arange(12 * 4**4), 4)
    for i, (ra, dec) in enumerate(PLACES):
        gap = np.degrees(2 * np.arcsin(np.linalg.norm(v - sp.unit(np.array(ra), np.array(dec)), axis=-1) / 2))
        edge = set(np.flatnonzero(np.abs(gap - radius) < 1e-9).tolist())
        assert inside.get(i, set()) | edge == set(np.flatnonzero(gap <= radius).tolist()) | edge
        assert inside.get(i, set()) <= touched[i]
    assert 99 not in touched


def _images(bends, width=300, height=220, scale=0.1):
    out = []
    for k, bend in enumerate(bends):
        a, b = [0.0] * 36, [0.0] * 36
        a[12], b[2], a[18] = bend, -bend / 2, bend / 300
        ra, dec = PLACES[k % len(PLACES)]
        out.append((k, ra, dec, 100.0, 90.0, -scale, scale / 9, scale / 7, scale, a, b, width, height))
    return out


IMAGES = "id long, ra0 double, dec0 double, px0 double, py0 double, cd11 double, cd12 double, cd21 double, cd22 double, sip_a array<double>, sip_b array<double>, width long, height long"


def test_adaptive_scales_find_the_finest_pixel(spark):
    """Dense samples at the places of the finest cells find nothing finer by more than the ratio, and mostly the same."""
    rows = _images([0.0, 1e-4, -2e-4, 5e-4, 3e-4, 0.0, -4e-4])
    got = {r.id: r for r in sp.finest_scales(spark.createDataFrame(rows, IMAGES)).collect()}
    for row in rows:
        x, y = (v.ravel() for v in np.meshgrid(np.linspace(0.5, 299.5, 300), np.linspace(0.5, 219.5, 220)))
        wcs = dict(zip(sp.WCS, (np.full(len(x), v) for v in row[1:9]), strict=True))
        dense = sp.local_scale(sp.Frames(wcs, np.tile(row[9], (len(x), 1)), np.tile(row[10], (len(x), 1))), x, y)
        r = got[row[0]]
        assert np.nanmin(dense) / 1.25 <= r.finest <= np.nanmin(dense) * 1.25
        assert r.samples % 9 == 0 and (r.samples > 9) == (r.coarsest > 1.25 * r.finest)
        assert r.nside / 2 < math.degrees(math.sqrt(math.pi / 3)) * 3600 / r.finest <= r.nside
    assert {r.samples > 9 for r in got.values()} == {True, False}


def test_a_plain_image_keeps_its_scale_at_the_pole(spark):
    row = [7, 12.0, 90.0, 5.0, 5.0, -1e-4, 0.0, 0.0, 2e-4, None, None, 10, 10]
    r = sp.finest_scales(spark.createDataFrame([tuple(row)], IMAGES)).first()
    assert (r.finest, r.coarsest, r.samples, r.nside) == (pytest.approx(0.36, rel=1e-6), pytest.approx(0.36, rel=1e-6), 9, 1 << 20)


def test_images_without_geometry_have_no_scale(spark):
    good = _images([0.0])[0]
    odd = [(1, None, *good[2:]), (2, *good[1:5], 0.0, 0.0, 0.0, 0.0, *good[9:]), (3, *good[1:11], 0, 220), (4, *good[1:11], None, None), (5, *good[1:11], 1, 1)]
    got = {r.id: (r.finest, r.samples, r.nside) for r in sp.finest_scales(spark.createDataFrame([good, *odd], IMAGES)).collect()}
    assert got[1] == got[2] == got[3] == got[4] == (None, 0, None)
    assert got[0][1] == got[5][1] == 9 and got[0][2] >= 512
    assert sp.finest_scales(spark.createDataFrame([], IMAGES)).count() == 0


def test_scales_do_not_depend_on_batches(spark):
    df = spark.createDataFrame(_images([1e-4 * k for k in range(-6, 7)]), IMAGES)
    one = {r.id: (r.finest, r.samples) for r in sp.finest_scales(df.coalesce(1), batch=1).collect()}
    assert one == {r.id: (r.finest, r.samples) for r in sp.finest_scales(df.repartition(3), batch=5).collect()}


def test_few_images_are_dealt_over_tasks(spark):
    df = spark.createDataFrame([(0, 10.0, 20.0), (1, 50.0, -20.0)], "k int, ra0 double, dec0 double").coalesce(1)
    assert sp.cells_in_disc(df, 1.0, 4).rdd.getNumPartitions() >= 16


def test_shared_areas_are_those_of_clipping():
    """Cells and bent pixels by the walk along edges, and by clipping; far pairs, shapes within one another and polygons that turn right among them."""
    k = np.arange(1, 60, 12)
    n = len(k) * 4
    turn, sip = np.radians(np.repeat(k, 4) * 37 % 360), np.array([0.0] * 7 + [3e-8] + [0.0] * 4 + [2e-8] + [0.0] * 23)
    wcs = {"ra0": np.repeat(k * 211 % 360 + 0.03, 4), "dec0": np.repeat(k * 97 % 178 - 89 + 0.02, 4), "px0": np.full(n, 2.0), "py0": np.full(n, 2.0), "cd11": np.cos(turn) * -0.3, "cd12": np.sin(turn) * 0.3, "cd21": np.sin(turn) * 0.3, "cd22": np.cos(turn) * 0.3}
    f = sphere.Frames(wcs, np.tile(sip, (n, 1)), np.tile(sip[::-1], (n, 1)))
    for order, size in ((7, 0.8), (8, 0.5), (5, 0.4)):
        poly, m = f.outlines(np.tile([0.0, 4.0, 1.0, 2.0], len(k)), np.tile([0.0, 1.0, 3.0, 4.0], len(k)), size)
        row, pix = sphere.disc_cells(*sphere._bounds(poly, m), order, touching=True)
        each, at = np.unique(pix, return_inverse=True)
        cell, nc = sphere.cell_outlines(each, order)
        back = np.where(np.arange(cell.shape[1])[None, :] < nc[:, None], nc[:, None] - 1 - np.arange(cell.shape[1]), np.arange(cell.shape[1]))
        flipped = np.take_along_axis(cell, back[:, :, None], axis=1)
        want = sphere.shared_area(cell[at], nc[at], poly[row], m[row])
        for subject in (cell, flipped):
            got = sphere.shared_areas(subject, nc, at, poly, m, row)
            assert got == pytest.approx(want, abs=1e-12 * float(np.abs(sphere.area(poly, m)).max())) and ((got > 1e-20) == (want > 1e-20)).all()
        assert (want > 1e-20).any() and (want <= 1e-20).any() and sphere.shared_areas(poly, m, row, cell, nc, at) == pytest.approx(want, rel=1e-9, abs=1e-18)


def test_discs_of_cells_on_images_in_one_step(spark):
    rows = [(i, 40.0 * i + 3, 30.0 * i - 80, 2.0, 2.0, -0.3, 0.01 * i, 0.01 * i, 0.3) for i in range(6)]
    images = spark.createDataFrame(rows, "i int, ra0 double, dec0 double, px0 double, py0 double, cd11 double, cd12 double, cd21 double, cd22 double")
    one = sphere.disc_overlaps(images, 1.2, 7, 5, 5, shrink=0.9, keep=["i"])
    two = sphere.cell_overlaps(sphere.cells_in_disc(images, 1.2, 7, touching=True), 7, 5, 5, shrink=0.9)
    assert one.columns == ["i", "pix", "x", "y", "weight", "drop_area", "pixel_area"]
    tell = lambda df: sorted((r.i, r.pix, r.x, r.y, round(r.weight, 12)) for r in df.collect())
    assert tell(one) == tell(two) != []
