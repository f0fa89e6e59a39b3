"""Queries of photometric fits, curves, drizzling and structures."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions.frames import simpson
from skyloom.operators import overlap, photometry, structures
from skyloom.plans.registry import query
from skyloom.plans.roles import IMAGE, SAMPLES, image, samples, table

C = F.col
_IRLS = "".join(f", w{i} AS (SELECT frame, r, loc, s, CASE WHEN abs((r - loc) / (4.685 * s)) >= 1 THEN 0 ELSE (1 - ((r - loc) / (4.685 * s)) ** 2) ** 2 END AS w FROM l{i}), l{i + 1} AS (SELECT frame, r, sum(w * r) OVER (PARTITION BY frame) / sum(w) OVER (PARTITION BY frame) AS loc, s FROM w{i})" for i in range(20))


@query("a_zero_point", f"WITH {SAMPLES}, r AS (SELECT frame, log10(v / (w + 10)) AS r FROM sm), m AS (SELECT *, median(r) OVER (PARTITION BY frame) AS loc FROM r), l0 AS (SELECT *, median(abs(r - loc)) OVER (PARTITION BY frame) / 0.6745 AS s FROM m){_IRLS} SELECT frame, round(max(loc), 6) AS location, round(10 ** -max(loc), 6) AS scale, count(*) FILTER (WHERE abs(r - loc) < 4.685 * s) AS n FROM l20 GROUP BY frame")
def zero_point(spark, sf):
    r = samples(spark, sf).select("frame", F.log10(C("v") / (C("w") + 10)).alias("r"))
    fits, _ = photometry.zero_points(r, ["frame"], "r")
    return fits.select("frame", F.round("location", 6).alias("location"), F.round("scale", 6).alias("scale"), "n")


_STARS = f"""WITH {SAMPLES}, st AS (SELECT frame, CASE WHEN flags = 7 AND t < 0.03 THEN -v ELSE v END AS f, CASE WHEN flags <> 6 THEN w + 10 END AS s, CASE WHEN flags <> 6 THEN 20 * d - 2.5 * log10(w + 10) END AS mag FROM sm),
ok AS (SELECT frame, log10(f / s) AS r, -2.5 * log10(f) - mag AS delta FROM st WHERE f > 0 AND s > 0), md AS (SELECT *, median(delta) OVER (PARTITION BY frame) AS mid FROM ok), r AS (SELECT * FROM md WHERE abs(delta - mid) <= 1),
m AS (SELECT frame, r, median(r) OVER (PARTITION BY frame) AS loc FROM r), l0 AS (SELECT *, median(abs(r - loc)) OVER (PARTITION BY frame) / 0.6745 AS s FROM m){_IRLS},
n AS (SELECT frame, max(loc) AS loc, count(*) FILTER (WHERE abs(r - loc) < 4.685 * s) AS n, count(*) FILTER (WHERE abs(r - loc) >= 4.685 * s) AS outliers, median(abs(r - loc)) FILTER (WHERE abs(r - loc) < 4.685 * s) / 0.6745 AS sigma FROM l20 GROUP BY frame),
i AS (SELECT frame, count(*) FILTER (WHERE abs(delta - mid) > 1) AS inconsistent FROM md GROUP BY frame), c AS (SELECT frame, count(*) FILTER (WHERE f <= 0 AND s IS NOT NULL) AS invalid, count(*) FILTER (WHERE s IS NULL) AS unmatched FROM st GROUP BY frame)
SELECT frame, round(loc, 6) AS location, round(sigma, 6) AS sigma, n, inconsistent, outliers, invalid, unmatched FROM n JOIN i USING (frame) JOIN c USING (frame)"""


@query("a_zero_point_reasons", _STARS)
def zero_point_reasons(spark, sf):
    """Frames calibrated by their stars, some of which have no partner, no flux or an odd magnitude, with the count of each reason."""
    known = C("flags") != 6
    stars = samples(spark, sf).select("frame", F.when((C("flags") == 7) & (C("t") < 0.03), -C("v")).otherwise(C("v")).alias("f"), F.when(known, C("w") + 10).alias("s"), F.when(known, C("d") * 20 - F.log10(C("w") + 10) * 2.5).alias("mag"))
    fits, _ = photometry.calibrated(stars, ["frame"], "f", "s", "mag")
    return fits.select("frame", F.round("location", 6).alias("location"), F.round("sigma", 6).alias("sigma"), *photometry.REASONS)


@query("x_akima")
def akima(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", C("embedding").cast("array<double>").alias("y"))
    wl = F.transform(F.sequence(F.lit(0), F.size("y") - 1), lambda i: i.cast("double"))
    got = e.select("vec_id", photometry.interpolated(wl, C("y"), [0.0, 0.5, 1.25, 31.5, 62.75, 63.0, 70.0]).alias("at"))
    return got.select("vec_id", F.posexplode("at").alias("place", "value"))


@query("x_fsyn", """WITH v AS (SELECT vec_id AS id, embedding AS y FROM embeddings)
SELECT id, round(list_sum(list_transform(range(0, 61), lambda i: y[i + 1]::DOUBLE * y[64 - i]::DOUBLE * 0.8 * (400 + i) * CASE WHEN i = 0 OR i = 60 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)) / 3 + (y[61]::DOUBLE * y[4]::DOUBLE * 460 + 3 * y[62]::DOUBLE * y[3]::DOUBLE * 461 + 3 * y[63]::DOUBLE * y[2]::DOUBLE * 462 + y[64]::DOUBLE * y[1]::DOUBLE * 463) * 0.8 * 3 / 8, 6) AS flux FROM v""")
def fsyn(spark, sf):
    y = C("embedding").cast("array<double>")
    index = F.sequence(F.lit(0), F.size("embedding") - 1)
    flux = photometry.synthetic_flux(y, F.reverse(y), F.transform(index, lambda i: F.lit(0.8)), F.transform(index, lambda i: (i + 400).cast("double")))
    return table(spark, sf, "embeddings").select(C("vec_id").alias("id"), F.round(flux, 6).alias("flux"))


@query("x_fsyn_catalog")
def fsyn_catalog(spark, sf):
    """Fluxes of spectra of bytes, 2 nm apart, through a filter and a detector given at other wavelengths."""
    wl = [336.0 + 2 * i for i in range(64)]
    band = ([350.0, 372.5, 401.0, 433.3, 447.9, 455.0], [0.0, 0.6, 0.95, 0.9, 0.4, 0.0])
    detector = ([330.0, 380.0, 420.0, 480.0], [0.35, 0.6, 0.8, 0.9])
    spectrum = F.transform("embedding", lambda v: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(v * 100 + 128))).cast("int"))
    flux = photometry.catalog_flux(spectrum, C("vec_id") % 13 + 5.0, wl, band, detector)
    return table(spark, sf, "embeddings").select(C("vec_id").alias("id"), F.round(flux, 6).alias("flux"))


_HOT = f"WITH RECURSIVE {IMAGE}, hot AS (SELECT frame, x, y, frame * 1000000 + y * 1000 + x AS id FROM im WHERE value > 90), lk AS (SELECT a.id AS a, b.id AS b FROM hot a JOIN hot b ON a.frame = b.frame AND abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1), r AS (SELECT a AS id, a AS root FROM lk UNION SELECT lk.b, r.root FROM r JOIN lk ON r.id = lk.a), c AS (SELECT id, min(root) AS root FROM r GROUP BY id), z AS (SELECT root, count(*) AS size FROM c GROUP BY root), q AS (SELECT hot.*, size FROM hot JOIN c ON hot.id = c.id JOIN z ON c.root = z.root)"


def _hot(spark, sf):
    return image(spark, sf).where("value > 90").select("frame", "x", "y")


@query("f_structure_size", f"{_HOT} SELECT frame, x, y, size FROM q WHERE size < 8")
def structure_size(spark, sf):
    return structures.labelled(_hot(spark, sf)).where("size < 8").select("frame", "x", "y", "size")


@query("rej_large_scale", f"{_HOT} SELECT DISTINCT frame, x + dx AS x, y + dy AS y FROM q, (SELECT unnest(range(-2, 3)) AS dx), (SELECT unnest(range(-2, 3)) AS dy) WHERE size >= 8 AND x + dx BETWEEN 0 AND 63 AND y + dy BETWEEN 0 AND 63 UNION SELECT frame, x, y FROM hot")
def large_scale(spark, sf):
    return structures.grown(_hot(spark, sf), 64, 64)


def _drops(spark, sf):
    """Each pixel's drop of 0.8 pixels, turned a little and shrunk onto a coarser grid."""
    i = image(spark, sf)
    out = i.select("frame", "x", "y", "value")
    for k, (a, b) in enumerate(((-0.4, -0.4), (0.4, -0.4), (0.4, 0.4), (-0.4, 0.4))):
        px, py = C("x") + 0.5 + a, C("y") + 0.5 + b
        out = out.withColumn(f"u{k}", px * 0.59 - py * 0.11 + 20).withColumn(f"v{k}", px * 0.11 + py * 0.59 + 3)
    return out


@query("j_overlap")
def overlaps(spark, sf):
    return overlap.with_overlaps(_drops(spark, sf)).select("frame", "x", "y", "gx", "gy", F.round("weight", 9).alias("weight"))


@query("a_drizzle_total", f"WITH {IMAGE} SELECT frame, round(sum(value), 4) AS flux, round(count(*) * 0.230528, 2) AS area FROM im GROUP BY frame")
def drizzle_total(spark, sf):
    """Drizzling loses no flux and no area: the sums over all cells are those of the pixels."""
    o = overlap.with_overlaps(_drops(spark, sf))
    cells = overlap.drizzled(o, ["frame", "gx", "gy"], "value", "value", F.lit(0.64 * (0.59 * 0.59 + 0.11 * 0.11)))
    return cells.groupBy("frame").agg(F.round(F.sum("flux"), 4).alias("flux"), F.round(F.sum("area"), 2).alias("area"))


@query("x_simpson_short")
def simpson_short(spark, sf):
    """The rule on curves of one to five samples."""
    y = C("embedding").cast("array<double>")
    return table(spark, sf, "embeddings").select("vec_id", *[F.round(simpson(F.slice(y, 1, n), 1.0), 9).alias(f"s{n}") for n in range(1, 6)])
