"""Queries of polygons on the sphere: discs of cells, cell outlines, and drizzling both ways."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.operators import sphere
from skyloom.plans.geometry import compact_sql
from skyloom.plans.registry import query
from skyloom.plans.roles import CATALOG, POINTINGS, catalog, pointings, table
from skyloom.session import dealt

C = F.col
_CENTRES = f"""f AS (SELECT i AS pix, i // 256 AS face, {compact_sql('i % 256')} AS x, {compact_sql('i % 256', 1)} AS y FROM range(0, 3072) t(i)),
g AS (SELECT *, [2,2,2,2,3,3,3,3,4,4,4,4][face + 1] * 16 - x - y - 1 AS jr, [1,3,5,7,0,2,4,6,1,3,5,7][face + 1] AS base FROM f),
h AS (SELECT *, CASE WHEN jr < 16 THEN jr WHEN jr > 48 THEN 64 - jr ELSE 16 END AS nr FROM g),
ctr AS (SELECT pix, CASE WHEN jr < 16 THEN 1 - nr * nr / 768.0::DOUBLE WHEN jr > 48 THEN nr * nr / 768.0::DOUBLE - 1 ELSE (32 - jr) / 24.0::DOUBLE END AS z, (base * nr + x - y) * pi() / (4 * nr) AS phi FROM h)"""


@query("j_disc_cells", f"WITH {POINTINGS}, {_CENTRES} SELECT point_id, pix FROM pt JOIN ctr ON sin(radians(dec0)) * z + cos(radians(dec0)) * sqrt(1 - z * z) * cos(radians(ra0) - phi) >= cos(radians(7.5::DOUBLE))")
def disc_cells(spark, sf):
    """The cells of order 4 whose centres are within 7.5 degrees of a pointing."""
    return sphere.cells_in_disc(pointings(spark, sf), 7.5, 4).select("point_id", "pix")


def _images(spark, sf):
    """A turned image of 0.3 degrees a pixel about each pointing, with some distortion."""
    turn = F.radians(C("point_id") * 37 % 360)
    sip = F.array(*[F.lit(v) for v in [0.0] * 7 + [3e-8] + [0.0] * 4 + [2e-8] + [0.0] * 23])
    wcs = {"px0": F.lit(2.0), "py0": F.lit(2.0), "cd11": F.cos(turn) * -0.3, "cd12": F.sin(turn) * 0.3, "cd21": F.sin(turn) * 0.3, "cd22": F.cos(turn) * 0.3, "sip_a": sip, "sip_b": F.reverse(sip)}
    return pointings(spark, sf).withColumns(wcs)


def _pixels(spark, sf):
    at = F.explode(F.sequence(F.lit(0), F.lit(4)))
    return _images(spark, sf).withColumn("x", at).withColumn("y", at).withColumn("value", (C("point_id") * 31 + C("x") * 7 + C("y") * 3) % 101 + 1.0)


@query("j_overlap_sky")
def overlap_sky(spark, sf):
    """Drops of 0.8 pixels on the cells of order 8."""
    met = sphere.pixel_overlaps(_pixels(spark, sf), 8, size=0.8, keep=["point_id", "x", "y"])
    return met.select("point_id", "x", "y", "pix", F.round("weight", 9).alias("weight"))


@query("a_drizzle_sky", f"WITH {POINTINGS}, v AS (SELECT point_id, (point_id * 31 + x * 7 + y * 3) % 101 + 1 AS value FROM pt, range(0, 5) a(x), range(0, 5) b(y)) SELECT point_id, round(sum(value), 6)::DOUBLE AS flux, 25::BIGINT AS drops FROM v GROUP BY point_id")
def drizzle_sky(spark, sf):
    """Drizzling on the sphere loses no flux: the sums over all cells are those of the pixels."""
    met = sphere.pixel_overlaps(_pixels(spark, sf), 8, size=0.8, keep=["point_id", "value"])
    cells = met.groupBy("point_id", "pix").agg(F.sum(C("value") * C("weight")).alias("flux"), F.sum("weight").alias("w"))
    return cells.groupBy("point_id").agg(F.round(F.sum("flux"), 6).alias("flux"), F.round(F.sum("w")).cast("long").alias("drops"))


@query("x_cell_outline", f"WITH {CATALOG} SELECT source_id, 1.0::DOUBLE AS share FROM cat")
def cell_outline(spark, sf):
    """The solid angle within each star's cell as drawn by its outline, over that of a cell: all are of one size."""
    star = catalog(spark, sf).withColumn("pix", hp.ang2pix(5, C("ra"), C("dec")))
    drawn = sphere.outlined(dealt(star.select("pix").distinct()), 5).select("pix", "outline_area")  # once a cell, however many its stars
    return star.join(drawn, "pix").select("source_id", F.round(C("outline_area") * (12 * 4**5) / (4 * F.pi()), 5).alias("share"))


@query("j_overlap_rev")
def overlap_reverse(spark, sf):
    """The stars' cells of order 8, drawn to 0.9, on the pixels of the pointing images that they lie in."""
    met = sphere.disc_overlaps(_images(spark, sf), 1.2, 8, 5, 5, shrink=0.9, keep=["point_id"])
    return met.select("point_id", "pix", "x", "y", F.round("weight", 9).alias("weight"))


@query("a_drizzle_rev", f"WITH {POINTINGS} SELECT point_id, x::BIGINT AS x, y::BIGINT AS y, 1.0::DOUBLE AS coverage FROM pt, range(0, 5) a(x), range(0, 5) b(y)")
def drizzle_reverse(spark, sf):
    """Whole cells cover every pixel of an image fully."""
    met = sphere.disc_overlaps(_images(spark, sf), 1.6, 8, 5, 5, keep=["point_id"]).withColumns({"signal": C("pix") % 7 + 1.0, "support": F.lit(1.0)})
    made = sphere.reverse_drizzled(met, ["point_id"], "signal", "support")
    return made.select("point_id", "x", "y", F.round("coverage", 6).alias("coverage"))


_PLACED = "list_transform([{'u': xx - f.px0, 'v': yy - f.py0}], lambda d: list_transform([{'u': d.u + f.bend * d.u * d.u, 'v': d.v + f.bend * d.u * d.v}], lambda e: {'xi': radians(f.cd11 * e.u + f.cd12 * e.v), 'eta': radians(f.cd21 * e.u + f.cd22 * e.v)})[1])[1]".replace("xx", "(p.x + o.x)").replace("yy", "(p.y + o.y)")
_NINE = "[" + ", ".join(f"{{'x': c.x0 + (c.x1 - c.x0) * {i}::DOUBLE, 'y': c.y0 + (c.y1 - c.y0) * {j}::DOUBLE}}" for i in (0, 0.5, 1) for j in (0, 0.5, 1)) + "]"
_FIVE = "[" + ", ".join(f"{{'x': {x}::DOUBLE, 'y': {y}::DOUBLE}}" for x, y in ((0, 0), (0.5, 0), (-0.5, 0), (0, 0.5), (0, -0.5))) + "]"
# each neighbour in the tangent plane of the place, as (1, xi, eta) over the cosine; then the smaller singular value of the differences
_PLANE = "list_transform(q, lambda k: list_transform([sqrt(1 + q[1].xi * q[1].xi + q[1].eta * q[1].eta) / (1 + k.xi * q[1].xi + k.eta * q[1].eta)], lambda g: {'x': g, 'y': g * k.xi, 'z': g * k.eta})[1])"
_DOT = lambda a, b: " + ".join(f"(w[{a}].{k} - w[{a + 1}].{k}) * (w[{b}].{k} - w[{b + 1}].{k})" for k in "xyz")
_SINGULAR = f"list_transform([{{'a': {_DOT(2, 2)}, 'b': {_DOT(2, 4)}, 'd': {_DOT(4, 4)}}}], lambda m: degrees(sqrt((m.a * m.d - m.b * m.b) * 2 / (m.a + m.d + sqrt((m.a - m.d) * (m.a - m.d) + 4 * m.b * m.b)))) * 3600)[1]"
_SCALES = f"list_transform(list_transform(list_transform({_NINE}, lambda p: list_transform({_FIVE}, lambda o: {_PLACED})), lambda q: {_PLANE}), lambda w: {_SINGULAR})"


@query("x_auto_nside", f"""WITH RECURSIVE f AS (SELECT s_suppkey AS id, 0.01::DOUBLE * (1 + s_suppkey % 4) AS cd11, 0.001::DOUBLE * (s_suppkey % 3) AS cd12, -0.002::DOUBLE * (s_suppkey % 5) AS cd21, 0.011::DOUBLE * (1 + s_suppkey % 4) AS cd22, 1e-5::DOUBLE * (s_suppkey % 7) AS bend, 600.0::DOUBLE AS px0, 500.0::DOUBLE AS py0 FROM supplier),
c(id, depth, x0, y0, x1, y1) AS (SELECT id, 0, 0.5::DOUBLE, 0.5::DOUBLE, 1499.5::DOUBLE, 1099.5::DOUBLE FROM f UNION ALL
SELECT id, depth + 1, x0 + (x1 - x0) / 2 * i, y0 + (y1 - y0) / 2 * j, x0 + (x1 - x0) / 2 * (i + 1), y0 + (y1 - y0) / 2 * (j + 1) FROM (SELECT c.*, {_SCALES} AS s FROM c JOIN f ON c.id = f.id WHERE depth < 5) t, range(0, 2) a(i), range(0, 2) b(j) WHERE list_max(s) > 1.25::DOUBLE * list_min(s)),
z AS (SELECT c.id, {_SCALES} AS s FROM c JOIN f ON c.id = f.id)
SELECT id, round(min(list_min(s)), 6) AS finest, count(*) * 9 AS samples, least(4194304, greatest(16, 2 ** ceil(log2(degrees(sqrt(pi() / 3)) * 3600 / min(list_min(s))))))::BIGINT AS nside FROM z GROUP BY id""")
def auto_nside(spark, sf):
    """The grid for wide images, some of them bent: the finest pixel scale that adaptive samples find."""
    k = C("s_suppkey")
    zero = [F.lit(0.0)] * 36
    a, b = list(zero), list(zero)
    a[12] = b[7] = F.lit(1e-5) * (k % 7)
    number = lambda v, m: F.lit(v) * m
    images = table(spark, sf, "supplier").select(
        k.alias("id"), F.lit(10.0).alias("ra0"), F.lit(20.0).alias("dec0"), F.lit(600.0).alias("px0"), F.lit(500.0).alias("py0"), number(0.01, 1 + k % 4).alias("cd11"), number(0.001, k % 3).alias("cd12"),
        number(-0.002, k % 5).alias("cd21"), number(0.011, 1 + k % 4).alias("cd22"), F.array(*a).alias("sip_a"), F.array(*b).alias("sip_b"), F.lit(1500).alias("width"), F.lit(1100).alias("height"))
    return sphere.finest_scales(images).select("id", F.round("finest", 6).alias("finest"), "samples", "nside")
