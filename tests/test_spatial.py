from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from skyloom.functions import frames as fr
from skyloom.functions import healpix as hp
from skyloom.operators import robust as rb
from skyloom.operators import spatial as sp
from skyloom.sources import fits


def _distance(a, b):
    (ra1, d1), (ra2, d2) = [[math.radians(x) for x in p] for p in (a, b)]
    c = math.sin(d1) * math.sin(d2) + math.cos(d1) * math.cos(d2) * math.cos(ra2 - ra1)
    return math.degrees(math.acos(max(-1, min(1, c))))


def test_pixels_and_centres_are_inverse(spark):
    for order in (0, 1, 3, 5):
        p = hp.with_centre(spark.range(hp.npix(order)).withColumnRenamed("id", "pix"), order)
        assert p.where(hp.ang2pix(order, F.col("ra"), F.col("dec")) != F.col("pix")).isEmpty()


def test_tile_places_are_a_bijection(spark):
    p = spark.range(1 << 14).select("id", hp.fits_index(F.col("id"), 7).alias("i"))
    assert p.select("i").distinct().count() == 1 << 14
    assert p.where(hp.fits_local(F.col("i"), 7) != F.col("id")).isEmpty()


@pytest.mark.parametrize("radius", [0.5, 3.0, 20.0])
def test_cones_find_all_at_poles_and_seams(spark, radius):
    rng = np.random.default_rng(int(radius * 10))
    stars = [(i, float(rng.uniform(0, 360)), float(np.degrees(np.arcsin(rng.uniform(-1, 1))))) for i in range(600)]
    stars += [(1000 + i, (i * 0.1 - 1) % 360, 0.05 * i) for i in range(20)] + [(2000, 0.0, 90.0), (2001, 123.0, -90.0), (2002, 45.0, 89.9)]
    points = [(0, 0.0, 0.0), (1, 359.99, 0.3), (2, 10.0, 90.0), (3, 200.0, -89.7), (4, 77.0, 41.8), (5, 180.0, 88.0)]
    s = spark.createDataFrame(stars, "source_id long, ra double, dec double")
    p = spark.createDataFrame(points, "point_id long, ra0 double, dec0 double")
    got = sorted((r.point_id, r.source_id) for r in sp.cone_join(p, s, radius).select("point_id", "source_id").collect())
    assert got == sorted((i, j) for i, *a in points for j, *b in stars if _distance(a, b) <= radius)


def test_null_positions_meet_nothing(spark):
    s = spark.createDataFrame([(1, None, 2.0), (2, 5.0, None), (3, 5.0, 5.0)], "source_id long, ra double, dec double")
    p = spark.createDataFrame([(0, 5.0, 5.0), (1, None, 1.0)], "point_id long, ra0 double, dec0 double")
    assert [(r.point_id, r.source_id) for r in sp.cone_join(p, s, 1.0).collect()] == [(0, 3)]


def test_plane_points_come_back(spark):
    df = spark.createDataFrame([(10.0, 89.0, 15.0, 88.5), (0.2, -1.0, 359.8, -1.2)], "ra double, dec double, ra0 double, dec0 double")
    xi, eta, _ = fr.tangent_forward(*[F.col(c) for c in ("ra", "dec", "ra0", "dec0")])
    back = df.select("ra", "dec", "ra0", "dec0", xi.alias("xi"), eta.alias("eta"))
    ra, dec = fr.tangent_inverse(*[F.col(c) for c in ("xi", "eta", "ra0", "dec0")])
    for r in back.select("ra", "dec", ra.alias("a"), dec.alias("d")).collect():
        assert r.a == pytest.approx(r.ra) and r.d == pytest.approx(r.dec)


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 101), (103, 102)]
    got = {r.id: r.root for r in rb.components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert all(got[i] == 0 for i in range(61)) and got[101] == 100 and got[103] == 102


def test_fits_images_come_back(spark, tmp_path):
    v = np.arange(12.0).reshape(3, 4)
    v[1, 2] = np.nan
    (tmp_path / "a.fits").write_bytes(fits.encode(v, {"FILTER": "O'III", "EXPTIME": 300.5}))
    h = fits.read_headers(spark, str(tmp_path)).first().header
    assert h["EXPTIME"] == "300.5" and h["NAXIS1"] == "4"
    got = {(r.y, r.x): r.value for r in fits.read_pixels(spark, str(tmp_path)).collect()}
    assert len(got) == 12 and math.isnan(got[1, 2]) and got[2, 3] == 11.0


def test_scaled_integers_and_blanks():
    stored = np.array([[1, -32768], [3, 4]], ">i2")
    cards = [("SIMPLE", True), ("BITPIX", 16), ("NAXIS", 2), ("NAXIS1", 2), ("NAXIS2", 2), ("BSCALE", 2.0), ("BZERO", 10.0), ("BLANK", -32768)]
    got = fits.image(fits._cards(cards) + stored.tobytes().ljust(2880, b"\0"))
    assert got[0, 0] == 12 and math.isnan(got[0, 1]) and got[1, 1] == 18


@pytest.mark.parametrize("find", [rb.upper_medians, rb.stack_upper_medians])
def test_upper_medians_of_small_large_tied_and_odd_groups(spark, find):
    rng = np.random.default_rng(11)
    groups = [rng.normal(0, 1, 20_001), rng.normal(5, 1, 20_000), rng.integers(0, 3, 5000).astype(float), np.array([1.0]), np.array([2.0, 1.0]), np.full(3000, 7.0), np.append(rng.uniform(0, 1e-9, 999), [1e300] * 1000), np.array([1.0, math.inf, -math.inf, 2.0])]
    rows = [(g, float(v)) for g, vs in enumerate(groups) for v in vs] + [(0, None), (9, None)]
    rows += [(8, math.nan), (8, math.nan), (8, 1.0)]
    got = {r.g: r.med for r in find(spark.createDataFrame(rows, "g long, v double").repartition(5), ["g"], "v").collect()}
    assert math.isnan(got.pop(8))
    assert got == {g: float(np.sort(vs)[len(vs) // 2]) for g, vs in enumerate(groups)}


def test_first_match_takes_the_highest_bound_that_holds_the_point(spark):
    rng = np.random.default_rng(12)
    bounds = [(float(rng.uniform(0, 24)), float(rng.uniform(0, 24)), float(rng.uniform(-95, 90)), f"B{i:02}") for i in range(30)] + [(22.0, 3.0, -20.0, "W1"), (0.0, 24.0, 88.5, "CAP")]
    points = [(i, float(rng.uniform(0, 24)), float(rng.uniform(-90, 90))) for i in range(400)] + [(900, 0.0, 90.0), (901, 23.999, -90.0), (902, 3.0, -20.0)]

    def plain(ra, dec):
        held = [(lo, n) for a, b, lo, n in bounds if dec >= lo and (a <= ra < b if a <= b else ra >= a or ra < b)]
        return max(held)[1] if held else ""

    frame = spark.createDataFrame(points + [(903, 1.0, None), (904, 1.0, math.nan)], "id long, ra_h double, dec double")
    got = dict(map(tuple, sp.first_match(frame, spark.createDataFrame(bounds, "ra_low double, ra_up double, de_low double, const string"), "id").select("id", "const").collect()))
    assert got == {i: plain(ra, dec) for i, ra, dec in points} | {903: "", 904: ""}


def test_order_statistics_of_several_shares(spark):
    rng = np.random.default_rng(13)
    groups = [rng.normal(0, 1, 30_000), np.append(np.zeros(9000), rng.uniform(0, 5, 50)), np.arange(3.0), np.array([4.0])]
    shares = {"first": 0.0, "low": 0.005, "mid": 0.5, "high": 0.995, "last": 1.0}
    frame = spark.createDataFrame([(g, float(v)) for g, vs in enumerate(groups) for v in vs], "g long, v double").repartition(4)
    got = {r.g: r.asDict() for r in rb.order_statistics(frame, ["g"], "v", shares).collect()}
    assert got == {g: {"g": g} | {name: float(np.sort(vs)[min(len(vs) - 1, int(len(vs) * s))]) for name, s in shares.items()} for g, vs in enumerate(groups)}


def test_dense_copies_keep_their_nearest_and_ties(spark):
    rng = np.random.default_rng(5)
    spots = [(float(a), float(d)) for a, d in zip(rng.uniform(0, 360, 40), rng.uniform(-80, 80, 40))]
    stars = [(i, *spots[i % 40], float(i)) for i in range(4000)]
    points = [(k, a + 0.2, d) for k, (a, d) in enumerate(spots[:10])] + [(99, 0.0, 89.0)]
    s, p = spark.createDataFrame(stars, "source_id long, ra double, dec double, mag double"), spark.createDataFrame(points, "point_id long, ra0 double, dec0 double")
    got = {(r.point_id, r["rank"]): r.source_id for r in sp.nearest(p, s, 20.0, "point_id", "source_id", 5).collect()}
    w = Window.partitionBy("point_id").orderBy(F.round("dist", 12), "source_id")
    want = {(r.point_id, r.r): r.source_id for r in sp.cone_join(p, s, 20.0).withColumn("r", F.row_number().over(w)).where("r <= 5").collect()}
    assert got == want
    held = sp.places(s, "ra", "dec", F.col("source_id"), "ids", ["source_id"], most=30)
    assert sorted(i for r in held.collect() for i in r.ids) == list(range(4000)) and max(len(r.ids) for r in held.collect()) <= 30


def test_rows_alone_and_mutual_ones_among_copies(spark):
    rng = np.random.default_rng(6)
    a = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.integers(0, 120, (600, 2)) / 2)]
    b = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.integers(0, 40, (900, 2)) / 2 + 0.1)]
    left, right = spark.createDataFrame(a, "lid long, x double, y double"), spark.createDataFrame(b, "rid long, x2 double, y2 double")
    d = {i: [round(math.dist((x, y), q[1:]), 12) for q in b] for i, x, y in a}
    assert {r.lid for r in sp.plane_alone(left, right, 5.0).collect()} == {i for i in d if min(d[i]) > 5}
    back = [min(d[i][j] for i in d) for j in range(len(b))]
    want = {(i, j) for i, row in d.items() if (m := min(row)) <= 6 and row.count(m) == 1 for j in [row.index(m)] if m == back[j] and sum(d[k][j] == m for k in d) == 1}
    assert {(r.lid, r.rid) for r in sp.mutual_nearest(left, right, 6.0, "lid", "rid").collect()} == want
