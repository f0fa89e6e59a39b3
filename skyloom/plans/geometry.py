"""Queries of sky geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions import frames as fr
from skyloom.functions import healpix as hp
from skyloom.plans.registry import query
from skyloom.plans.roles import CATALOG, PAIR, POINTINGS, catalog, paired, table


def morton_sql(x: str, y: str) -> str:
    bit = lambda v, s: f"list_sum(list_transform(range(0, 24), lambda b: (({v})::BIGINT >> b & 1) << (2 * b{s})))"
    return f"({bit(x, '')} + {bit(y, ' + 1')})::BIGINT"


def ang2pix_sql(order: int, source: str, keep: str, ra: str = "ra", dec: str = "dec", out: str = "px") -> str:
    """CTEs; the last, `out`, has keep and pix."""
    n = 1 << order
    return f"""{out}_a AS (SELECT {keep}, sin(radians({dec})) AS z, ({ra} / 90.0::DOUBLE) % 4 AS t FROM {source}),
{out}_b AS (SELECT *, floor({n} * (0.5::DOUBLE + t) - {n * 0.75}::DOUBLE * z)::BIGINT AS jp, floor({n} * (0.5::DOUBLE + t) + {n * 0.75}::DOUBLE * z)::BIGINT AS jm, least(floor(t), 3)::BIGINT AS q, {n} * sqrt(3.0::DOUBLE * greatest(0, 1 - abs(z))) AS r FROM {out}_a),
{out}_c AS (SELECT *, jp >> {order} AS fp, jm >> {order} AS fm, least(floor((t - q) * r), {n - 1})::BIGINT AS kp, least(floor((1 - (t - q)) * r), {n - 1})::BIGINT AS km FROM {out}_b),
{out}_d AS (SELECT {keep}, CASE WHEN abs(z) <= 2.0::DOUBLE / 3 THEN CASE WHEN fp = fm THEN (fp & 3) + 4 WHEN fp < fm THEN fp & 3 ELSE (fm & 3) + 8 END WHEN z >= 0 THEN q ELSE q + 8 END AS face,
  CASE WHEN abs(z) <= 2.0::DOUBLE / 3 THEN jm & {n - 1} WHEN z >= 0 THEN {n - 1} - km ELSE kp END AS x, CASE WHEN abs(z) <= 2.0::DOUBLE / 3 THEN {n - 1} - (jp & {n - 1}) WHEN z >= 0 THEN {n - 1} - kp ELSE km END AS y FROM {out}_c),
{out} AS (SELECT {keep}, (face * {n * n} + {morton_sql('x', 'y')})::BIGINT AS pix FROM {out}_d)"""


def compact_sql(m: str, shift: int = 0) -> str:
    return f"list_sum(list_transform(range(0, 24), lambda b: (({m})::BIGINT >> (2 * b + {shift}) & 1) << b))::BIGINT"


@query("x_ang2pix", f"WITH {CATALOG}, {ang2pix_sql(6, 'cat', 'source_id')} SELECT source_id, pix FROM px")
def ang2pix(spark, sf):
    return catalog(spark, sf).select("source_id", hp.ang2pix(6, F.col("ra"), F.col("dec")).alias("pix"))


@query("x_pix2ang", f"""WITH p AS (SELECT c_custkey AS id, (c_custkey * 7919) % 49152 AS pix FROM customer),
f AS (SELECT *, pix // 4096 AS face, {compact_sql('pix % 4096')} AS x, {compact_sql('pix % 4096', 1)} AS y FROM p),
g AS (SELECT *, [2,2,2,2,3,3,3,3,4,4,4,4][face + 1] * 64 - x - y - 1 AS jr, [1,3,5,7,0,2,4,6,1,3,5,7][face + 1] AS base FROM f),
h AS (SELECT *, CASE WHEN jr < 64 THEN jr WHEN jr > 192 THEN 256 - jr ELSE 64 END AS nr, CASE WHEN jr < 64 OR jr > 192 THEN 0 ELSE (jr - 64) & 1 END AS ks FROM g),
i AS (SELECT *, CASE WHEN jr < 64 THEN 1 - nr * nr / 12288.0::DOUBLE WHEN jr > 192 THEN nr * nr / 12288.0::DOUBLE - 1 ELSE (128 - jr) * 2 / 192.0::DOUBLE END AS z, (base * nr + x - y + 1 + ks) // 2 AS jp FROM h)
SELECT id, pix, round((CASE WHEN jp > 4 * nr THEN jp - 4 * nr WHEN jp < 1 THEN jp + 4 * nr ELSE jp END - (ks + 1) * 0.5::DOUBLE) * 90.0::DOUBLE / nr, 7) AS ra, round(degrees(asin(z)), 7) AS dec FROM i""")
def pix2ang(spark, sf):
    p = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 7919 % 49152).alias("pix"))
    return hp.with_centre(p, 6).select("id", "pix", F.round("ra", 7).alias("ra"), F.round("dec", 7).alias("dec"))


@query("x_morton", f"WITH c AS (SELECT c_custkey AS id, c_custkey % 4096 AS x, (c_custkey * 31) % 4096 AS y FROM customer), m AS (SELECT *, {morton_sql('x', 'y')} AS m FROM c) SELECT id, m, {compact_sql('m')} AS x, {compact_sql('m', 1)} AS y FROM m")
def morton(spark, sf):
    k = F.col("c_custkey")
    c = table(spark, sf, "customer").select(k.alias("id"), hp.morton(k % 4096, k * 31 % 4096).alias("m"))
    x, y = hp.unmorton(F.col("m"))
    return c.select("id", "m", x.alias("x"), y.alias("y"))


@query("x_fits_index", f"WITH c AS (SELECT c_custkey AS id, (c_custkey * 977) % 262144 AS loc FROM customer), p AS (SELECT *, (511 - {compact_sql('loc')}) * 512 + {compact_sql('loc', 1)} AS idx FROM c) SELECT id, loc, idx, loc AS back FROM p")
def fits_index(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 977 % 262144).alias("loc")).withColumn("idx", hp.fits_index(F.col("loc"), 9))
    return c.withColumn("back", hp.fits_local(F.col("idx"), 9))


@query("x_parent_uniq", "WITH c AS (SELECT c_custkey AS id, (c_custkey * 7919) % 49152 AS pix FROM customer) SELECT id, pix, pix // 16 AS parent, pix * 16 AS child, 16384 + pix AS uniq, 6 AS uniq_order, pix AS uniq_pix FROM c")
def parent_uniq(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 7919 % 49152).alias("pix"))
    p = F.col("pix")
    return c.select("id", "pix", hp.parent(p, 2).alias("parent"), hp.first_child(p, 2).alias("child"), hp.uniq(6, p).alias("uniq")).withColumn("uniq_order", hp.uniq_order(F.col("uniq"))).withColumn("uniq_pix", hp.uniq_pix(F.col("uniq")))


_DIST = "degrees(acos(greatest(-1, least(1, sin(radians({1})) * sin(radians({3})) + cos(radians({1})) * cos(radians({3})) * cos(radians({2} - {0}))))))"


def distance_sql(ra1: str, dec1: str, ra2: str, dec2: str) -> str:
    return _DIST.format(ra1, dec1, ra2, dec2)


@query("x_angdist", f"WITH {CATALOG}, {POINTINGS} SELECT source_id, point_id, round({distance_sql('ra', 'dec', 'ra0', 'dec0')}, 6) AS dist FROM cat {PAIR}")
def angdist(spark, sf):
    both = paired(spark, sf)
    return both.select("source_id", "point_id", F.round(hp.angular_distance(F.col("ra"), F.col("dec"), F.col("ra0"), F.col("dec0")), 6).alias("dist"))


@query("x_pixel_size", "SELECT o::INTEGER AS tile_order, 12 * (4 ** o)::BIGINT AS npix, round(sqrt(4 * pi() / (12 * 4.0::DOUBLE ** o)) * 648000 / pi(), 6) AS arcsec FROM range(0, 13) t(o)")
def pixel_size(spark, sf):
    rows = [(o, hp.npix(o), round(hp.resolution_arcsec(o), 6)) for o in range(13)]
    return spark.createDataFrame(rows, "tile_order int, npix long, arcsec double")


@query("x_neighbors")
def neighbors(spark, sf):
    p = catalog(spark, sf).select("source_id", hp.ang2pix(5, F.col("ra"), F.col("dec")).alias("pix"))
    return hp.neighbours(p, 5)


_TAN = f"""WITH {CATALOG}, {POINTINGS}, j AS (SELECT source_id, ra, dec, ra0, dec0, radians(ra - ra0) AS a, radians(dec) AS d, radians(dec0) AS d0 FROM cat {PAIR}),
c AS (SELECT *, sin(d0) * sin(d) + cos(d0) * cos(d) * cos(a) AS c FROM j),
t AS (SELECT *, degrees(cos(d) * sin(a) / c) AS xi, degrees((cos(d0) * sin(d) - sin(d0) * cos(d) * cos(a)) / c) AS eta FROM c WHERE c > 0.2)"""


@query("x_tan_forward", f"{_TAN} SELECT source_id, round(xi, 6) AS xi, round(eta, 6) AS eta FROM t")
def tan_forward(spark, sf):
    both = paired(spark, sf)
    xi, eta, c = fr.tangent_forward(F.col("ra"), F.col("dec"), F.col("ra0"), F.col("dec0"))
    return both.where(c > 0.2).select("source_id", F.round(xi, 6).alias("xi"), F.round(eta, 6).alias("eta"))


@query("x_tan_inverse", f"{_TAN} SELECT source_id, round(abs(((ra - ra0 + 540) % 360) - 180), 5) AS dra, round(dec, 5) AS dec FROM t")
def tan_inverse(spark, sf):
    both = paired(spark, sf)
    xi, eta, c = fr.tangent_forward(F.col("ra"), F.col("dec"), F.col("ra0"), F.col("dec0"))
    plane = both.where(c > 0.2).select("source_id", "ra0", "dec0", xi.alias("xi"), eta.alias("eta"))
    ra, dec = fr.tangent_inverse(F.col("xi"), F.col("eta"), F.col("ra0"), F.col("dec0"))
    return plane.select("source_id", F.round(F.abs(F.pmod(ra - F.col("ra0") + 180, F.lit(360.0)) - 180), 5).alias("dra"), F.round(dec, 5).alias("dec"))


_SIP = {(2, 0): 1.5e-6, (1, 1): -2.5e-6, (0, 2): 0.5e-6, (3, 0): 1e-10, (0, 3): -3e-10}


@query("x_sip", "WITH i AS (SELECT event_id AS id, (event_id % 4096 - 2048)::DOUBLE AS x, ((event_id * 7) % 4096 - 2048)::DOUBLE AS y FROM events) SELECT id, round(x + 1.5e-6 * x * x - 2.5e-6 * x * y + 0.5e-6 * y * y + 1e-10 * x ** 3 - 3e-10 * y ** 3, 6) AS u FROM i")
def sip(spark, sf):
    e = F.col("event_id")
    i = table(spark, sf, "events").select(e.alias("id"), (e % 4096 - 2048).cast("double").alias("x"), (e * 7 % 4096 - 2048).cast("double").alias("y"))
    return i.select("id", F.round(F.col("x") + fr.polynomial(F.col("x"), F.col("y"), _SIP), 6).alias("u"))


@query("x_sky_to_pixel", f"{_TAN}, p AS (SELECT source_id, (xi * 0.9 + eta * 0.1) * 10 AS dx, (eta * 0.9 - xi * 0.1) * 10 AS dy FROM t) SELECT source_id, round(2048 + dx + 1e-5 * dx * dx - 2e-5 * dx * dy, 5) AS px, round(2048 + dy + 3e-5 * dy * dy, 5) AS py FROM p")
def sky_to_pixel(spark, sf):
    both = paired(spark, sf)
    xi, eta, c = fr.tangent_forward(F.col("ra"), F.col("dec"), F.col("ra0"), F.col("dec0"))
    p = both.where(c > 0.2).select("source_id", xi.alias("xi"), eta.alias("eta"))
    p = p.select("source_id", ((F.col("xi") * 0.9 + F.col("eta") * 0.1) * 10).alias("dx"), ((F.col("eta") * 0.9 - F.col("xi") * 0.1) * 10).alias("dy"))
    dx, dy = F.col("dx"), F.col("dy")
    return p.select("source_id", F.round(dx + 2048 + fr.polynomial(dx, dy, {(2, 0): 1e-5, (1, 1): -2e-5}), 5).alias("px"), F.round(dy + 2048 + fr.polynomial(dx, dy, {(0, 2): 3e-5}), 5).alias("py"))


@query("x_polygon_area", "SELECT p_partkey AS id, round(abs(p_size * 2.0::DOUBLE + 3 * p_size * 0.5::DOUBLE), 6) AS area FROM part")
def polygon_area(spark, sf):
    s = F.col("p_size").cast("double")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    # a rectangle of height 2 with a triangle of height 3 on top
    shape = F.array(corner(F.lit(0.0), F.lit(0.0)), corner(s, F.lit(0.0)), corner(s, F.lit(2.0)), corner(s / 2, F.lit(5.0)), corner(F.lit(0.0), F.lit(2.0)))
    return table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.round(fr.polygon_area(shape), 6).alias("area"))


@query("x_slerp", f"""WITH {CATALOG}, {POINTINGS}, j AS (SELECT source_id, cos(radians(dec)) * cos(radians(ra)) AS ax, cos(radians(dec)) * sin(radians(ra)) AS ay, sin(radians(dec)) AS az,
 cos(radians(dec0)) * cos(radians(ra0)) AS bx, cos(radians(dec0)) * sin(radians(ra0)) AS by_, sin(radians(dec0)) AS bz FROM cat {PAIR}),
w AS (SELECT *, acos(greatest(-1, least(1, ax * bx + ay * by_ + az * bz))) AS w FROM j)
SELECT source_id, round((ax * sin(0.75 * w) + bx * sin(0.25 * w)) / sin(w), 6) AS x, round((ay * sin(0.75 * w) + by_ * sin(0.25 * w)) / sin(w), 6) AS y, round((az * sin(0.75 * w) + bz * sin(0.25 * w)) / sin(w), 6) AS z FROM w""")
def slerp(spark, sf):
    both = paired(spark, sf)
    v = fr.slerp(fr.direction(F.col("ra"), F.col("dec")), fr.direction(F.col("ra0"), F.col("dec0")), F.lit(0.25))
    return both.select("source_id", v.alias("v")).select("source_id", *[F.round(F.col("v")[c], 6).alias(c) for c in "xyz"])


@query("x_view_grid", f"""WITH g AS (SELECT (i % 64)::BIGINT AS px, (i // 64)::BIGINT AS py, radians((i % 64 - 31.5::DOUBLE) * 0.05::DOUBLE) AS x, radians((31.5::DOUBLE - i // 64) * 0.05::DOUBLE) AS y FROM range(0, 4096) t(i)),
s AS (SELECT px, py, (120.0::DOUBLE + degrees(atan2(x, cos(radians(35.0::DOUBLE)) - y * sin(radians(35.0::DOUBLE)))) + 360) % 360 AS ra,
 degrees(atan2(sin(radians(35.0::DOUBLE)) + y * cos(radians(35.0::DOUBLE)), sqrt(x * x + (cos(radians(35.0::DOUBLE)) - y * sin(radians(35.0::DOUBLE))) ** 2))) AS dec FROM g),
{ang2pix_sql(8, 's', 'px, py')} SELECT px, py, pix FROM px""")
def view_grid(spark, sf):
    i = F.col("id")
    grid = spark.range(4096).select((i % 64).alias("px"), F.floor(i / 64).alias("py"))
    ra, dec = fr.tangent_inverse((F.col("px") - 31.5) * 0.05, (F.lit(31.5) - F.col("py")) * 0.05, F.lit(120.0), F.lit(35.0))
    return grid.select("px", "py", hp.ang2pix(8, ra, dec).alias("pix"))
