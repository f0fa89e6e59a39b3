"""Queries of ordering, sets, windows and element kernels."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.plans.geometry import ang2pix_sql, distance_sql
from skyloom.plans.registry import query
from skyloom.plans.roles import CATALOG, IMAGE, SAMPLES, catalog, image, samples, table

C = F.col


@query("s_mag", f"WITH {CATALOG} SELECT source_id, row_number() OVER (ORDER BY CASE WHEN source_id % 53 = 0 THEN 1 ELSE 0 END, mag, source_id) AS place FROM cat ORDER BY place LIMIT 100")
def mag(spark, sf):
    """The brightest hundred, stars without a magnitude last."""
    c = catalog(spark, sf).withColumn("m", F.when(C("source_id") % 53 == 0, F.lit(float("nan"))).otherwise(C("mag")))
    top = c.orderBy(F.isnan("m"), "m", "source_id").limit(100)
    return top.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.isnan("m"), "m", "source_id")).cast("long")).select("source_id", "place")


@query("s_distance", f"WITH {CATALOG}, {ang2pix_sql(3, 'cat', 'source_id, ra, dec')}, t AS (SELECT pix, avg(ra) AS ra, avg(dec) AS dec FROM px GROUP BY pix) SELECT pix AS tile, round({distance_sql('ra', 'dec', '180.0', '10.0')}, 6) AS dist FROM t ORDER BY dist, tile LIMIT 50")
def distance(spark, sf):
    t = catalog(spark, sf).withColumn("tile", hp.ang2pix(3, C("ra"), C("dec"))).groupBy("tile").agg(F.avg("ra").alias("ra"), F.avg("dec").alias("dec"))
    return t.select("tile", F.round(hp.angular_distance(C("ra"), C("dec"), F.lit(180.0), F.lit(10.0)), 6).alias("dist")).orderBy("dist", "tile").limit(50)


@query("s_select_stars", f"WITH {CATALOG}, r AS (SELECT source_id, floor(ra / 30)::BIGINT AS gx, floor((dec + 90) / 30)::BIGINT AS gy, mag FROM cat), k AS (SELECT *, row_number() OVER (PARTITION BY gx, gy ORDER BY mag, source_id) AS k FROM r) SELECT gx, gy, source_id FROM k WHERE k <= 3")
def select_stars(spark, sf):
    w = Window.partitionBy("gx", "gy").orderBy("mag", "source_id")
    r = catalog(spark, sf).select("source_id", F.floor(C("ra") / 30).alias("gx"), F.floor((C("dec") + 90) / 30).alias("gy"), "mag")
    return r.withColumn("k", F.row_number().over(w)).where("k <= 3").select("gx", "gy", "source_id")


@query("s_mag_limit", f"WITH {CATALOG}, b AS (SELECT floor(mag * 10)::BIGINT AS bin, count(*) AS n FROM cat GROUP BY ALL), c AS (SELECT bin, sum(n) OVER (ORDER BY bin) AS n FROM b) SELECT min(bin) / 10.0::DOUBLE AS limit_mag FROM c WHERE n >= 500")
def mag_limit(spark, sf):
    """The tenth of a magnitude at which 500 stars are reached; the running count is over bins, not stars."""
    bins = catalog(spark, sf).groupBy(F.floor(C("mag") * 10).alias("bin")).agg(F.count("*").alias("n"))
    run = bins.withColumn("n", F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("bin")))
    return run.where("n >= 500").agg((F.min("bin") / 10).alias("limit_mag"))


@query("s_stride", f"WITH {SAMPLES}, r AS (SELECT control, l_orderkey AS id, l_linenumber AS k, l_suppkey AS s, row_number() OVER (PARTITION BY control ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_extendedprice, l_quantity) - 1 AS n FROM sm) SELECT control, id, k, s FROM r WHERE n % 16 = 0 AND n // 16 < 1000")
def stride(spark, sf):
    w = Window.partitionBy("control").orderBy("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_extendedprice", "l_quantity")
    r = samples(spark, sf).withColumn("n", F.row_number().over(w) - 1)
    return r.where("n % 16 = 0 AND n < 16000").select("control", C("l_orderkey").alias("id"), C("l_linenumber").alias("k"), C("l_suppkey").alias("s"))


@query("s_top_votes", "WITH v AS (SELECT l_suppkey % 40 AS i, l_partkey % 40 AS j FROM lineitem) SELECT i, j, count(*) AS votes FROM v GROUP BY ALL ORDER BY votes DESC, i, j LIMIT 50")
def top_votes(spark, sf):
    v = table(spark, sf, "lineitem").groupBy((C("l_suppkey") % 40).alias("i"), (C("l_partkey") % 40).alias("j")).agg(F.count("*").alias("votes"))
    return v.orderBy(C("votes").desc(), "i", "j").limit(50)


@query("u_moc_union", f"WITH {CATALOG}, {ang2pix_sql(5, 'cat', 'source_id')}, u AS (SELECT pix // 4 AS cell FROM px WHERE source_id % 2 = 0 UNION SELECT pix // 4 FROM px WHERE source_id % 3 = 0) SELECT cell, 1024 + cell AS uniq FROM u")
def moc_union(spark, sf):
    p = catalog(spark, sf).select("source_id", hp.parent(hp.ang2pix(5, C("ra"), C("dec")), 1).alias("cell"))
    u = p.where("source_id % 2 = 0").select("cell").union(p.where("source_id % 3 = 0").select("cell")).distinct()
    return u.select("cell", hp.uniq(4, C("cell")).alias("uniq"))


@query("u_neighbor_dedup", "WITH e AS (SELECT o_custkey % 50 AS a, o_orderkey % 60 AS b FROM orders) SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM e WHERE a <> b")
def neighbor_dedup(spark, sf):
    e = table(spark, sf, "orders").select((C("o_custkey") % 50).alias("a"), (C("o_orderkey") % 60).alias("b")).where("a <> b")
    return e.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


@query("u_incremental", f"WITH {SAMPLES} SELECT pix, count(*) AS n, round(sum(w), 6) AS sw, round(sum(w * v) / sum(w), 8) AS mean FROM sm GROUP BY pix")
def incremental(spark, sf):
    """Sums of frames 0-3 as stored, joined by those of frames 4-7: a union of partial sums and one more aggregate."""
    s = samples(spark, sf)
    part = lambda df: df.groupBy("pix").agg(F.count("*").alias("n"), F.sum("w").alias("sw"), F.sum(C("w") * C("v")).alias("swv"))
    both = part(s.where("frame < 4")).unionByName(part(s.where("frame >= 4")))
    return both.groupBy("pix").agg(F.sum("n").alias("n"), F.sum("sw").alias("sw"), F.sum("swv").alias("swv")).select("pix", "n", F.round("sw", 6).alias("sw"), F.round(C("swv") / C("sw"), 8).alias("mean"))


@query("w_prefix_scan", f"WITH {IMAGE} SELECT frame, x, y, round(sum(value) OVER (PARTITION BY frame, y ORDER BY x ROWS UNBOUNDED PRECEDING), 4) AS run FROM im")
def prefix_scan(spark, sf):
    w = Window.partitionBy("frame", "y").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    return image(spark, sf).select("frame", "x", "y", F.round(F.sum("value").over(w), 4).alias("run"))


@query("w_box_filter", f"WITH {IMAGE}, r AS (SELECT frame, x, y, avg(value) OVER (PARTITION BY frame, y ORDER BY x ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS v FROM im) SELECT frame, x, y, round(avg(v) OVER (PARTITION BY frame, x ORDER BY y ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 9) AS v FROM r")
def box_filter(spark, sf):
    """A separable 5 by 5 mean: two windows along the axes."""
    along = lambda a, b: Window.partitionBy("frame", b).orderBy(a).rowsBetween(-2, 2)
    r = image(spark, sf).withColumn("v", F.avg("value").over(along("x", "y")))
    return r.select("frame", "x", "y", F.round(F.avg("v").over(along("y", "x")), 9).alias("v"))


@query("w_convolve", f"WITH {IMAGE}, k AS (SELECT dx, dy, [1, 2, 1][dx + 2] * [1, 2, 1][dy + 2] / 16.0::DOUBLE AS k FROM (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy)) SELECT frame, x + dx AS x, y + dy AS y, round(sum(value * k), 9) AS v FROM im, k WHERE x + dx BETWEEN 0 AND 63 AND y + dy BETWEEN 0 AND 63 GROUP BY ALL")
def convolve(spark, sf):
    """3 by 3 convolution: each pixel adds to its neighbours, with map-side combine."""
    taps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"), F.lit((2 - abs(i)) * (2 - abs(j)) / 16).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    at = image(spark, sf).withColumn("t", F.explode(taps)).select("frame", (C("x") + C("t.dx")).alias("x"), (C("y") + C("t.dy")).alias("y"), (C("value") * C("t.k")).alias("v"))
    return at.where(C("x").between(0, 63) & C("y").between(0, 63)).groupBy("frame", "x", "y").agg(F.round(F.sum("v"), 9).alias("v"))


@query("w_bad_pixel", f"""WITH {IMAGE}, b AS (SELECT *, CASE WHEN (x * 7 + y * 13) % 17 = 0 THEN NULL ELSE value END AS v FROM im), n AS (SELECT frame, x, y, v,
 last_value(v IGNORE NULLS) OVER l AS lv, last_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER l AS lx, first_value(v IGNORE NULLS) OVER r AS rv, first_value(CASE WHEN v IS NOT NULL THEN x END IGNORE NULLS) OVER r AS rx FROM b
 WINDOW l AS (PARTITION BY frame, y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), r AS (PARTITION BY frame, y ORDER BY x ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING))
SELECT frame, x, y, round(CASE WHEN v IS NOT NULL THEN v ELSE (coalesce(lv / (x - lx), 0) + coalesce(rv / (rx - x), 0)) / (coalesce(1.0::DOUBLE / (x - lx), 0) + coalesce(1.0::DOUBLE / (rx - x), 0)) END, 5) AS v FROM n""")
def bad_pixel(spark, sf):
    """Masked pixels from the nearest good ones left and right, weighted by 1 / distance."""
    b = image(spark, sf).withColumn("v", F.when((C("x") * 7 + C("y") * 13) % 17 != 0, C("value"))).withColumn("gx", F.when(C("v").isNotNull(), C("x")))
    w = Window.partitionBy("frame", "y").orderBy("x")
    left, right = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    n = b.select("frame", "x", "y", "v", *[f(c, ignorenulls=True).over(o).alias(s + c) for s, f, o in (("l", F.last, left), ("r", F.first, right)) for c in ("v", "gx")])
    wl, wr = F.lit(1.0) / (C("x") - C("lgx")), F.lit(1.0) / (C("rgx") - C("x"))
    zero = F.lit(0.0)
    mean = (F.coalesce(C("lv") * wl, zero) + F.coalesce(C("rv") * wr, zero)) / (F.coalesce(wl, zero) + F.coalesce(wr, zero))
    return n.select("frame", "x", "y", F.round(F.coalesce("v", mean), 5).alias("v"))


@query("w_background_noise", f"""WITH {IMAGE}, d0 AS (SELECT frame, y, value - lag(value) OVER (PARTITION BY frame, y ORDER BY x) AS d FROM im), k0 AS (SELECT * FROM d0 WHERE d IS NOT NULL)"""
    + "".join(f", m{i} AS (SELECT *, median(d) OVER (PARTITION BY frame, y) AS m FROM k{i}), s{i} AS (SELECT *, 1.4826 * median(abs(d - m)) OVER (PARTITION BY frame, y) AS s FROM m{i}), k{i + 1} AS (SELECT frame, y, d FROM s{i} WHERE s <= 1e-12 OR abs(d - m) <= 5 * s)" for i in range(3))
    + ", r AS (SELECT frame, y, stddev_pop(d) AS sd FROM k3 GROUP BY ALL) SELECT frame, round(median(sd) * 0.70710678, 5) AS noise FROM r GROUP BY frame")
def background_noise(spark, sf):
    """First differences along rows, three rounds of clipping, the median of the rows' spreads."""
    from skyloom.operators import robust as rb

    d = image(spark, sf).select("frame", "y", (C("value") - F.lag("value").over(Window.partitionBy("frame", "y").orderBy("x"))).alias("d")).where("d IS NOT NULL")
    kept = rb.clipped(d, ["frame", "y"], "d", 5.0, 5.0, 3)
    rows = kept.groupBy("frame", "y").agg(F.stddev_pop("d").alias("sd"))
    return rows.groupBy("frame").agg(F.round(rb.median(C("sd")) * 0.70710678, 5).alias("noise"))


@query("k_vector_ops", "SELECT round(sum(l_quantity * l_discount), 4) AS dot, round(sum(l_quantity), 4) AS total, max(l_quantity) AS largest, round(sqrt(sum(l_discount * l_discount)), 6) AS norm, round(sum(2.5 * l_quantity + l_discount), 3) AS axpy FROM lineitem")
def vector_ops(spark, sf):
    q, d = C("l_quantity"), C("l_discount")
    return table(spark, sf, "lineitem").agg(F.round(F.sum(q * d), 4).alias("dot"), F.round(F.sum(q), 4).alias("total"), F.max(q).alias("largest"), F.round(F.sqrt(F.sum(d * d)), 6).alias("norm"), F.round(F.sum(2.5 * q + d), 3).alias("axpy"))


@query("k_histogram", "SELECT least(255, floor(value / 490.1 * 256))::BIGINT AS bin, count(*) AS n FROM events GROUP BY ALL")
def histogram(spark, sf):
    return table(spark, sf, "events").groupBy(F.least(F.lit(255), F.floor(C("value") / 490.1 * 256)).alias("bin")).agg(F.count("*").alias("n"))


@query("k_transpose", f"WITH {IMAGE} SELECT frame, y AS x, x AS y, value FROM im")
def transpose(spark, sf):
    return image(spark, sf).select("frame", C("y").alias("x"), C("x").alias("y"), "value")


@query("k_matmul", f"WITH {IMAGE} SELECT a.y AS i, b.x AS j, round(sum(a.value * b.value), 6) AS v FROM im a JOIN im b ON a.x = b.y AND a.frame = 0 AND b.frame = 1 GROUP BY ALL")
def matmul(spark, sf):
    i = image(spark, sf)
    a = i.where("frame = 0").select(C("y").alias("i"), C("x").alias("k"), C("value").alias("u"))
    b = i.where("frame = 1").select(C("y").alias("k"), C("x").alias("j"), C("value").alias("w"))
    return a.join(b, "k").groupBy("i", "j").agg(F.round(F.sum(C("u") * C("w")), 6).alias("v"))


@query("k_scatter_add", "SELECT hash_key AS slot, round(sum(l_quantity), 4) AS v FROM (SELECT (l_partkey * 31 + l_suppkey * 17) % 1024 AS hash_key, l_quantity FROM lineitem) GROUP BY ALL")
def scatter_add(spark, sf):
    return table(spark, sf, "lineitem").groupBy(((C("l_partkey") * 31 + C("l_suppkey") * 17) % 1024).alias("slot")).agg(F.round(F.sum("l_quantity"), 4).alias("v"))
