"""Queries of aggregates: robust statistics, masters, noise, roll-ups."""

from __future__ import annotations

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyloom.functions import frames as fr
from skyloom.functions import healpix as hp
from skyloom.operators import robust as rb
from skyloom.plans.geometry import ang2pix_sql
from skyloom.plans.registry import query
from skyloom.plans.roles import CATALOG, IMAGE, SAMPLES, catalog, image, samples

C = F.col


def _r(c, n=6):
    return F.round(c, n)


@query("a_median", f"WITH {SAMPLES} SELECT pix, round(median(v), 6) AS med FROM sm GROUP BY pix")
def median(spark, sf):
    return samples(spark, sf).groupBy("pix").agg(_r(rb.median(C("v"))).alias("med"))


@query("a_median_upper", f"WITH {SAMPLES}, r AS (SELECT pix, v, row_number() OVER (PARTITION BY pix ORDER BY v) AS k, count(*) OVER (PARTITION BY pix) AS n FROM sm) SELECT pix, round(v, 6) AS med FROM r WHERE k = n // 2 + 1")
def median_upper(spark, sf):
    return rb.stack_upper_medians(samples(spark, sf), ["pix"], "v").select("pix", _r(C("med")).alias("med"))


@query("a_mad", f"WITH {SAMPLES}, m AS (SELECT pix, v, median(v) OVER (PARTITION BY pix) AS m FROM sm), d AS (SELECT pix, median(abs(v - m)) AS d FROM m GROUP BY pix) SELECT pix, round(d * 1.4826, 6) AS sigma, round(d * 1.482602218505602, 6) AS noise, round(d / 0.6745, 6) AS phot FROM d")
def mad(spark, sf):
    s = rb.spreads(samples(spark, sf), ["pix"], "v")
    return s.select("pix", _r(C("dev") * fr.MAD_TO_SIGMA).alias("sigma"), _r(C("dev") * fr.NOISE_MAD_TO_SIGMA).alias("noise"), _r(C("dev") / fr.PHOTOMETRY_MAD).alias("phot"))


@query("a_percentile", f"WITH {SAMPLES} SELECT pix, round(quantile_cont(v, 0.01), 8) AS p1, round(quantile_cont(v, 0.25), 8) AS p25, round(quantile_cont(v, 0.99), 8) AS p99 FROM sm GROUP BY pix")
def percentile(spark, sf):
    p = lambda q: _r(F.percentile("v", F.lit(q)), 8)
    return samples(spark, sf).groupBy("pix").agg(p(0.01).alias("p1"), p(0.25).alias("p25"), p(0.99).alias("p99"))


@query("a_wmedian", f"WITH {SAMPLES}, c AS (SELECT pix, v, sum(w) OVER (PARTITION BY pix ORDER BY v, l_orderkey, l_linenumber, l_suppkey ROWS UNBOUNDED PRECEDING) AS c, sum(w) OVER (PARTITION BY pix) AS t FROM sm) SELECT pix, round(min(v), 6) AS med FROM c WHERE c >= t / 2 GROUP BY pix")
def wmedian(spark, sf):
    return rb.weighted_medians(samples(spark, sf), ["pix"], "v", "w", ["l_orderkey", "l_linenumber", "l_suppkey"]).select("pix", _r(C("med")).alias("med"))


@query("a_support_max", f"WITH {SAMPLES} SELECT pix, max(sup) AS support FROM sm GROUP BY pix")
def support_max(spark, sf):
    return samples(spark, sf).groupBy("pix").agg(F.max("sup").alias("support"))


@query("a_drizzle", f"WITH {SAMPLES} SELECT pix % 1000 AS leaf, round(sum(v * d), 4) AS flux, round(sum(d), 6) AS area, round(sum(CASE WHEN t > 0 THEN t * d * d ELSE 0 END), 8) AS var_num, count(*) AS n FROM sm WHERE d > 1e-20 GROUP BY ALL")
def drizzle(spark, sf):
    s = samples(spark, sf).where("d > 1e-20")
    return s.groupBy((C("pix") % 1000).alias("leaf")).agg(_r(F.sum(C("v") * C("d")), 4).alias("flux"), _r(F.sum("d")).alias("area"), _r(F.sum(F.when(C("t") > 0, C("t") * C("d") * C("d")).otherwise(0.0)), 8).alias("var_num"), F.count("*").alias("n"))


_TILES = f"WITH {CATALOG}, {ang2pix_sql(6, 'cat', 'source_id, mag')}, t AS (SELECT pix AS tile, avg(mag) AS signal, least(1, count(*) / 3.0::DOUBLE) AS support FROM px GROUP BY pix)"


def _tiles(spark, sf):
    p = catalog(spark, sf).withColumn("tile", hp.ang2pix(6, C("ra"), C("dec")))
    return p.groupBy("tile").agg(F.avg("mag").alias("signal"), F.least(F.lit(1.0), F.count("*") / 3).alias("support"))


@query("a_hierarchy", f"""{_TILES}, e AS (SELECT l, tile >> (2 * l) AS tile, signal * support * 0.25 AS flux, support * 0.25 AS area FROM t, (SELECT unnest([1, 2, 3, 4]) AS l)), u AS (SELECT l, tile, sum(flux) AS flux, sum(area) AS area FROM e GROUP BY ALL)
SELECT l AS level, tile, round(flux / area, 9) AS signal, round(least(1, area / (4.0::DOUBLE ** l * 0.25)), 9) AS support FROM u""")
def hierarchy(spark, sf):
    return rb.hierarchy(_tiles(spark, sf), "tile", 4, 0.25).select("level", "tile", _r(C("signal"), 9).alias("signal"), _r(C("support"), 9).alias("support"))


@query("a_ud_grade", f"{_TILES} SELECT tile >> 4 AS tile, round(avg(signal), 9) AS signal FROM t GROUP BY ALL")
def ud_grade(spark, sf):
    return _tiles(spark, sf).groupBy(hp.parent(C("tile"), 2).alias("tile")).agg(_r(F.avg("signal"), 9).alias("signal"))


@query("a_moc_fraction", f"{_TILES} SELECT count(*) AS cells, round(count(*) / 49152.0, 9) AS fraction FROM t")
def moc_fraction(spark, sf):
    return _tiles(spark, sf).agg(F.count("*").alias("cells")).select("cells", _r(C("cells") / hp.npix(6), 9).alias("fraction"))


@query("a_coverage", f"{_TILES}, f AS (SELECT source_id % 8 AS frame, pix FROM px) SELECT frame, count(DISTINCT pix) AS tiles, count(DISTINCT pix >> 4) AS parents, min(pix) AS first_tile FROM f GROUP BY frame")
def coverage(spark, sf):
    p = catalog(spark, sf).select((C("source_id") % 8).alias("frame"), hp.ang2pix(6, C("ra"), C("dec")).alias("tile"))
    return p.groupBy("frame").agg(F.countDistinct("tile").alias("tiles"), F.countDistinct(hp.parent(C("tile"), 2)).alias("parents"), F.min("tile").alias("first_tile"))


@query("a_bbox", f"WITH {CATALOG} SELECT source_id % 16 AS g, round(min(ra) - 1, 6) AS ra0, round(max(ra) + 1, 6) AS ra1, round(greatest(-90, min(dec) - 1), 6) AS dec0, round(least(90, max(dec) + 1), 6) AS dec1 FROM cat GROUP BY ALL")
def bbox(spark, sf):
    return catalog(spark, sf).groupBy((C("source_id") % 16).alias("g")).agg(
        _r(F.min("ra") - 1).alias("ra0"), _r(F.max("ra") + 1).alias("ra1"), _r(F.greatest(F.lit(-90.0), F.min("dec") - 1)).alias("dec0"), _r(F.least(F.lit(90.0), F.max("dec") + 1)).alias("dec1"))


_PATCH = f"WITH {IMAGE}, p AS (SELECT frame, x // 8 AS px, y // 8 AS py, value FROM im)"
_CLIP = "".join(f", m{i} AS (SELECT *, median(value) OVER (PARTITION BY frame, px, py) AS m FROM {'p' if i == 0 else f'k{i - 1}'}), d{i} AS (SELECT *, 1.482602218505602 * median(abs(value - m)) OVER (PARTITION BY frame, px, py) AS s FROM m{i}), k{i} AS (SELECT frame, px, py, value FROM d{i} WHERE s <= 1e-12 OR abs(value - m) <= 5 * s)" for i in range(2))
_NOISE = f"{_PATCH}{_CLIP}, z AS (SELECT *, median(value) OVER (PARTITION BY frame, px, py) AS m FROM k1), n AS (SELECT frame, px, py, (1.482602218505602 * median(abs(value - m))) ** 2 AS var, count(*) AS n FROM z GROUP BY ALL HAVING count(*) >= 16)"


def _noise(spark, sf):
    """(frame, px, py, var, n): the clipped variance of patches of 8 by 8 with at least 16 samples."""
    p = image(spark, sf).select("frame", F.floor(C("x") / 8).alias("px"), F.floor(C("y") / 8).alias("py"), "value")
    keys = ["frame", "px", "py"]
    kept = rb.clipped(p, keys, "value", 5.0, 5.0, 2, fr.NOISE_MAD_TO_SIGMA)
    s = rb.beside(kept, keys, m=rb.median(C("value")))
    return s.groupBy(*keys).agg(F.pow(rb.median(F.abs(C("value") - C("m"))) * fr.NOISE_MAD_TO_SIGMA, F.lit(2)).alias("var"), F.count("*").alias("n")).where("n >= 16")


@query("a_noise_patch", f"{_NOISE} SELECT frame, px, py, round(var, 4) AS var, n FROM n")
def noise_patch(spark, sf):
    return _noise(spark, sf).withColumn("var", _r(C("var"), 4))


@query("a_noise_global", f"{_NOISE}, f AS (SELECT DISTINCT frame FROM im) SELECT f.frame, round(greatest(1e-6, coalesce(median(var), 0)), 4) AS var, count(var) AS patches, count(var) = 0 AS degenerate FROM f LEFT JOIN n ON f.frame = n.frame GROUP BY f.frame")
def noise_global(spark, sf):
    frames = image(spark, sf).select("frame").distinct()
    g = frames.join(_noise(spark, sf), "frame", "left").groupBy("frame").agg(F.coalesce(rb.median(C("var")), F.lit(0.0)).alias("var"), F.count("var").alias("patches"))
    return g.select("frame", _r(F.greatest(F.lit(1e-6), "var"), 4).alias("var"), "patches", (C("patches") == 0).alias("degenerate"))


@query("a_noise_plane", f"""{_NOISE}, q AS (SELECT frame, px::DOUBLE AS x, py::DOUBLE AS y, var AS v FROM n), s AS (SELECT frame, count(*) AS n, avg(x) AS mx, avg(y) AS my, avg(v) AS mv, covar_pop(x, x) AS xx, covar_pop(y, y) AS yy, covar_pop(x, y) AS xy, covar_pop(x, v) AS xv, covar_pop(y, v) AS yv FROM q GROUP BY frame HAVING count(*) >= 4), k AS (SELECT *, (xv * yy - yv * xy) / (xx * yy - xy * xy) AS b, (yv * xx - xv * xy) / (xx * yy - xy * xy) AS c FROM s)
SELECT frame, round(mv - b * mx - c * my, 3) AS a, round(b, 3) AS b, round(c, 3) AS c FROM k""")
def noise_plane(spark, sf):
    """Least squares var = a + b x + c y from moments; frames with fewer than four patches have none."""
    q = _noise(spark, sf).select("frame", C("px").cast("double").alias("x"), C("py").cast("double").alias("y"), C("var").alias("v"))
    cov = {a + b: F.covar_pop(a, b).alias(a + b) for a, b in (("x", "x"), ("y", "y"), ("x", "y"), ("x", "v"), ("y", "v"))}
    s = q.groupBy("frame").agg(F.count("*").alias("n"), *[F.avg(c).alias("m" + c) for c in "xyv"], *cov.values()).where("n >= 4")
    det = C("xx") * C("yy") - C("xy") * C("xy")
    s = s.withColumn("b", F.try_divide(C("xv") * C("yy") - C("yv") * C("xy"), det)).withColumn("c", F.try_divide(C("yv") * C("xx") - C("xv") * C("xy"), det))
    return s.select("frame", _r(C("mv") - C("b") * C("mx") - C("c") * C("my"), 3).alias("a"), _r(C("b"), 3).alias("b"), _r(C("c"), 3).alias("c"))


_MASTER = "".join(f", m{i} AS (SELECT *, median(v) OVER (PARTITION BY pix) AS m FROM {'sm' if i == 0 else f'k{i - 1}'}), d{i} AS (SELECT *, 1.4826 * median(abs(v - m)) OVER (PARTITION BY pix) AS s FROM m{i}), k{i} AS (SELECT * EXCLUDE (m, s) FROM d{i} WHERE s <= 1e-12 OR (v >= m - 3 * s AND v <= m + 3 * s))" for i in range(3))


@query("a_master", f"WITH {SAMPLES}{_MASTER} SELECT pix, round(avg(v), 7) AS mean, round(median(v), 7) AS med, count(*) AS n FROM k2 GROUP BY pix")
def master(spark, sf):
    k = rb.clipped(samples(spark, sf).select("pix", "v"), ["pix"], "v", 3.0, 3.0, 3)
    return k.groupBy("pix").agg(_r(F.avg("v"), 7).alias("mean"), _r(rb.median(C("v")), 7).alias("med"), F.count("*").alias("n"))


@query("a_master_flat", f"WITH {SAMPLES}, f AS (SELECT pix, frame, greatest(0.1, v / median(v) OVER (PARTITION BY frame)) AS v FROM sm), a AS (SELECT pix, avg(v) AS v FROM f GROUP BY pix), g AS (SELECT median(v) AS m FROM a) SELECT pix, round(greatest(0.1, v / m), 6) AS flat FROM a, g")
def master_flat(spark, sf):
    f = rb.beside(samples(spark, sf).select("pix", "frame", "v"), ["frame"], m=rb.median(C("v"))).withColumn("v", F.greatest(F.lit(0.1), C("v") / C("m")))
    a = rb.beside(f.groupBy("pix").agg(F.avg("v").alias("v")), [], g=rb.median(C("v")))
    return a.select("pix", _r(F.greatest(F.lit(0.1), C("v") / C("g"))).alias("flat"))


@query("a_flat_norm", f"WITH {IMAGE}, m AS (SELECT frame, median(value) AS m FROM im GROUP BY frame) SELECT im.frame, x, y, round(CASE WHEN m <= 0 THEN value ELSE greatest(0.1, value / m) END, 6) AS flat FROM im JOIN m ON im.frame = m.frame")
def flat_norm(spark, sf):
    i = rb.beside(image(spark, sf), ["frame"], m=rb.median(C("value")))
    return i.select("frame", "x", "y", _r(F.when(C("m") <= 0, C("value")).otherwise(F.greatest(F.lit(0.1), C("value") / C("m")))).alias("flat"))


@query("f_hot_cold", f"WITH {IMAGE}, m AS (SELECT *, median(value) OVER (PARTITION BY frame) AS m FROM im), d AS (SELECT *, 1.4826 * median(abs(value - m)) OVER (PARTITION BY frame) AS s FROM m) SELECT frame, x, y, CASE WHEN value > m + 2 * s THEN 'hot' ELSE 'cold' END AS kind FROM d WHERE value > m + 2 * s OR value < m - 1.2 * s")
def hot_cold(spark, sf):
    i = image(spark, sf)
    i = i.join(rb.spreads(i, ["frame"], "value").withColumn("s", C("dev") * fr.MAD_TO_SIGMA), "frame")
    hot, cold = C("value") > C("med") + 2 * C("s"), C("value") < C("med") - 1.2 * C("s")
    return i.where(hot | cold).select("frame", "x", "y", F.when(hot, "hot").otherwise("cold").alias("kind"))


@query("f_mag_consistency", f"WITH {SAMPLES}, m AS (SELECT pix, ord_, v, median(v) OVER (PARTITION BY pix) AS m FROM (SELECT pix, l_orderkey AS ord_, v FROM sm)) SELECT pix, ord_ AS id, round(v, 6) AS v FROM m WHERE abs(v - m) <= 100")
def mag_consistency(spark, sf):
    s = rb.beside(samples(spark, sf).select("pix", C("l_orderkey").alias("id"), "v"), ["pix"], m=rb.median(C("v")))
    return s.where(F.abs(C("v") - C("m")) <= 100).select("pix", "id", _r(C("v")).alias("v"))


@query("a_scale_simple", f"WITH {SAMPLES}, r AS (SELECT frame, v / w AS r FROM sm WHERE w > 0), k AS (SELECT frame, r, row_number() OVER (PARTITION BY frame ORDER BY r) AS k, count(*) OVER (PARTITION BY frame) AS n FROM r) SELECT frame, round(r, 6) AS scale FROM k WHERE k = n // 2 + 1")
def scale_simple(spark, sf):
    r = samples(spark, sf).where("w > 0").select("frame", (C("v") / C("w")).alias("r"))
    return rb.upper_medians(r, ["frame"], "r", "scale").select("frame", _r(C("scale")).alias("scale"))


@query("a_snr_model", f"WITH {SAMPLES}, s AS (SELECT frame, (v - w) / d AS snr FROM sm WHERE d > 0) SELECT frame, round(median(snr), 4) AS snr, count(*) AS n, round(1 / (ln(10) * (avg(snr) / 1000)), 6) AS phot FROM s GROUP BY frame")
def snr_model(spark, sf):
    s = samples(spark, sf).where("d > 0").select("frame", ((C("v") - C("w")) / C("d")).alias("snr"))
    return s.groupBy("frame").agg(_r(rb.median(C("snr")), 4).alias("snr"), F.count("*").alias("n"), _r(1 / (math.log(10) * (F.avg("snr") / 1000))).alias("phot"))


@query("a_upm_norm", f"WITH {SAMPLES}, r AS (SELECT control, frame, sum(d) AS raw FROM sm GROUP BY ALL) SELECT control, frame, round(CASE WHEN sum(raw) OVER (PARTITION BY control) > 1e-12 THEN raw / sum(raw) OVER (PARTITION BY control) * 0.9 ELSE 0 END, 8) AS w FROM r")
def upm_norm(spark, sf):
    r = samples(spark, sf).groupBy("control", "frame").agg(F.sum("d").alias("raw"))
    total = F.sum("raw").over(Window.partitionBy("control"))
    return r.select("control", "frame", _r(F.when(total > 1e-12, C("raw") / total * 0.9).otherwise(0.0), 8).alias("w"))


@query("a_ctrl_depth", f"WITH {SAMPLES}, c AS (SELECT pix2, count(DISTINCT frame) AS frames FROM sm GROUP BY pix2) SELECT CASE WHEN frames >= 2 THEN 2 ELSE 1 END AS depth, count(*) AS controls FROM c GROUP BY ALL")
def ctrl_depth(spark, sf):
    c = samples(spark, sf).groupBy("pix2").agg(F.countDistinct("frame").alias("frames"))
    return c.groupBy(F.when(C("frames") >= 2, 2).otherwise(1).alias("depth")).agg(F.count("*").alias("controls"))


@query("a_stack_legacy", f"WITH {SAMPLES} SELECT pix2, count(*) AS n, round(sum(w), 6) AS sw, round(sum(w * v), 3) AS swv, round(sum(w * v * v) / 1e6, 3) AS swv2, count(*) < 3 AS low_confidence FROM sm GROUP BY pix2")
def stack_legacy(spark, sf):
    s = samples(spark, sf).groupBy("pix2")
    return s.agg(F.count("*").alias("n"), _r(F.sum("w")).alias("sw"), _r(F.sum(C("w") * C("v")), 3).alias("swv"), _r(F.sum(C("w") * C("v") * C("v")) / 1e6, 3).alias("swv2"), (F.count("*") < 3).alias("low_confidence"))


@query("a_auto_stretch", f"WITH {IMAGE}, r AS (SELECT frame, value, row_number() OVER (PARTITION BY frame ORDER BY value) - 1 AS k, count(*) OVER (PARTITION BY frame) AS n FROM im WHERE value > 0), a AS (SELECT frame, max(CASE WHEN k = floor(n * 0.005) THEN value END) AS lo, max(CASE WHEN k = least(n - 1, floor(n * 0.995)) THEN value END) AS hi, max(CASE WHEN k = n // 2 THEN value END) AS med FROM r GROUP BY frame) SELECT frame, lo, hi, round(least(0.99, greatest(0.01, (med - lo) / CASE WHEN hi - lo < 1e-30 THEN 1 ELSE hi - lo END)), 6) AS mid FROM a")
def auto_stretch(spark, sf):
    a = rb.order_statistics(image(spark, sf).where("value > 0"), ["frame"], "value", {"lo": 0.005, "hi": 0.995, "med": 0.5})
    span = C("hi") - C("lo")
    return a.select("frame", "lo", "hi", _r(fr.clamp((C("med") - C("lo")) / F.when(span < 1e-30, 1.0).otherwise(span), 0.01, 0.99)).alias("mid"))


@query("a_auto_range", f"""WITH {IMAGE}, v AS (SELECT frame, CASE WHEN value > 480 THEN value * 100 ELSE value END AS v FROM im), k AS (SELECT frame, v, row_number() OVER (PARTITION BY frame ORDER BY v) AS k, count(*) OVER (PARTITION BY frame) AS n FROM v), m AS (SELECT frame, v AS med FROM k WHERE k = n // 2 + 1),
d AS (SELECT v.frame, abs(v - med) AS d, med FROM v JOIN m ON v.frame = m.frame), dk AS (SELECT *, row_number() OVER (PARTITION BY frame ORDER BY d) AS k, count(*) OVER (PARTITION BY frame) AS n FROM d), s AS (SELECT frame, med, 1.4826 * d AS mad FROM dk WHERE k = n // 2 + 1),
p AS (SELECT frame, quantile_cont(v, 0.01) AS p1, quantile_cont(v, 0.99) AS p99 FROM v GROUP BY frame), q AS (SELECT v.frame, quantile_cont(v, 0.99) AS c99, count(*) AS c FROM v JOIN s ON v.frame = s.frame WHERE v <= med + 12 * mad GROUP BY v.frame)
SELECT p.frame, round(p1, 5) AS lo, round(CASE WHEN p99 > med + 30 * mad AND c >= 32 THEN c99 ELSE p99 END, 5) AS hi FROM p JOIN s ON p.frame = s.frame JOIN q ON p.frame = q.frame""")
def auto_range(spark, sf):
    """1 % and 99 %, the latter of what is left below median + 12 MAD where it lies over median + 30 MAD."""
    v = image(spark, sf).select("frame", F.when(C("value") > 480, C("value") * 100).otherwise(C("value")).alias("v"))
    v = v.join(rb.upper_medians(v, ["frame"], "v", "med"), "frame")
    dev = rb.upper_medians(v.select("frame", F.abs(C("v") - C("med")).alias("d")), ["frame"], "d", "mad")
    v = v.join(dev.select("frame", (C("mad") * fr.MAD_TO_SIGMA).alias("mad")), "frame")
    kept = F.when(C("v") <= C("med") + 12 * C("mad"), C("v"))
    p = v.groupBy("frame").agg(F.percentile("v", F.lit(0.01)).alias("p1"), F.percentile("v", F.lit(0.99)).alias("p99"), F.percentile(kept, F.lit(0.99)).alias("c99"), F.count(kept).alias("c"), F.first("med").alias("med"), F.first("mad").alias("mad"))
    return p.select("frame", _r(C("p1"), 5).alias("lo"), _r(F.when((C("p99") > C("med") + 30 * C("mad")) & (C("c") >= 32), C("c99")).otherwise(C("p99")), 5).alias("hi"))


@query("a_trimmed_mad", f"WITH {SAMPLES}, r AS (SELECT pix, abs(d - t) AS r, row_number() OVER (PARTITION BY pix ORDER BY abs(d - t)) - 1 AS k, count(*) OVER (PARTITION BY pix) AS n FROM sm) SELECT pix, round(avg(r), 6) AS scale FROM r WHERE k >= floor(n * 0.1) AND k < floor(n * 0.9) GROUP BY pix")
def trimmed_mad(spark, sf):
    w = Window.partitionBy("pix")
    r = samples(spark, sf).select("pix", F.abs(C("d") - C("t")).alias("r")).withColumn("k", F.row_number().over(w.orderBy("r")) - 1).withColumn("n", F.count("*").over(w))
    return r.where((C("k") >= F.floor(C("n") * 0.1)) & (C("k") < F.floor(C("n") * 0.9))).groupBy("pix").agg(_r(F.avg("r")).alias("scale"))


_EDGES = "ed AS (SELECT c_custkey AS a, 10000000 + c_custkey // 5 AS b FROM customer UNION SELECT c_custkey, 20000000 + (c_custkey + 5) // 10 FROM customer)"


@query("a_components", f"WITH RECURSIVE {_EDGES}, e2 AS (SELECT a, b FROM ed UNION SELECT b, a FROM ed), r AS (SELECT a AS id, a AS root FROM e2 UNION SELECT e2.b, r.root FROM r JOIN e2 ON r.id = e2.a) SELECT id, min(root) AS root FROM r GROUP BY id")
def components(spark, sf):
    from skyloom.plans.roles import table

    k = C("c_custkey")
    c = table(spark, sf, "customer")
    edges = c.select(k.alias("a"), (F.floor(k / 5) + 10_000_000).alias("b")).unionByName(c.select(k.alias("a"), (F.floor((k + 5) / 10) + 20_000_000).alias("b")))
    return rb.components(edges, "a", "b")
