"""Queries of scalar expressions on frames, stars and controls."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from skyloom.functions import frames as fr
from skyloom.plans.registry import query
from skyloom.plans.roles import CATALOG, SAMPLES, catalog, samples, table

C = F.col


def _rounded(df, keep, **columns):
    return df.select(*keep, *[F.round(v, 6).alias(k) for k, v in columns.items()])


_LI = "li AS (SELECT row_number() OVER () AS n, l_orderkey AS id, l_partkey AS p, l_suppkey AS s, l_linenumber AS k, l_quantity AS q, l_extendedprice AS e, l_discount AS d, l_tax AS t FROM lineitem)"


def _li(spark, sf):
    return table(spark, sf, "lineitem").select(C("l_orderkey").alias("id"), C("l_partkey").alias("p"), C("l_suppkey").alias("s"), C("l_linenumber").alias("k"), C("l_quantity").alias("q"), C("l_extendedprice").alias("e"), C("l_discount").alias("d"), C("l_tax").alias("t"))


@query("x_calibrate", f"WITH {_LI} SELECT id, p, round((e / 100 - q - 0.8::DOUBLE * (q * 1.5 - q)) / greatest(d * 10, 0.1), 6) AS full_form, round((e / 100 - q * 1.5) / greatest(d * 10, 0.1), 6) AS dark_only FROM li")
def calibrate(spark, sf):
    light, dark, flat = C("e") / 100, C("q") * 1.5, C("d") * 10
    return _rounded(_li(spark, sf), ["id", "p"], full_form=fr.calibrate(light, dark, flat, C("q"), 0.8), dark_only=fr.calibrate(light, dark, flat))


@query("x_photscale", f"WITH {_LI}, s AS (SELECT s, 1 + avg(d) AS scale FROM li GROUP BY s) SELECT id, p, li.s, round(e * scale, 8) AS flux FROM li JOIN s ON li.s = s.s")
def photscale(spark, sf):
    li = _li(spark, sf)
    return li.join(li.groupBy("s").agg((F.avg("d") + 1).alias("scale")), "s").select("id", "p", "s", F.round(C("e") * C("scale"), 8).alias("flux"))


@query("x_scale_law", f"WITH {_LI} SELECT id, p, round(e * q * q, 6) AS variance, round(d / (q * q), 6) AS ivar FROM li")
def scale_law(spark, sf):
    v, i = fr.scale_law(C("e"), C("d"), C("q"))
    return _rounded(_li(spark, sf), ["id", "p"], variance=v, ivar=i)


@query("x_gain_var", f"WITH {_LI} SELECT id, p, round(CASE WHEN t * 100 - 2 <= 0 THEN 0 ELSE greatest(0, e - 20000) / (t * 100 - 2) + 9 / (t * 100 - 2) ** 2 END, 6) AS var FROM li")
def gain_var(spark, sf):
    return _rounded(_li(spark, sf), ["id", "p"], var=fr.gain_variance(C("e") - 20000, C("t") * 100 - 2, F.lit(3.0)))


@query("x_phot_quality", f"WITH {_LI} SELECT id, p, round(2.5 * (CASE WHEN d > 0 THEN d ELSE 0 END), 6) AS mag, round(ln(10) * (CASE WHEN d > 0 THEN d ELSE 0 END), 6) AS rel, CASE WHEN d <= 0 THEN 2 WHEN k > 3 THEN 0 ELSE 1 END AS st FROM li")
def phot_quality(spark, sf):
    q = fr.photometric_quality(C("d"), C("k") - 3)
    return _li(spark, sf).select("id", "p", q.alias("q")).select("id", "p", F.round("q.sigma_mag", 6).alias("mag"), F.round("q.sigma_rel", 6).alias("rel"), C("q.fit_status").alias("st"))


@query("x_psf_quality", f"WITH {_LI} SELECT id, p, CASE WHEN k = 7 THEN 1 WHEN (k & 6) <> 0 THEN 2 WHEN d <= 0 THEN 3 ELSE 0 END AS st, round(CASE WHEN d > 0 THEN d / 0.73167 ELSE 0 END, 6) AS sigma, round(CASE WHEN d > 0 THEN q / d ELSE 0 END, 6) AS qpsf FROM li")
def psf_quality(spark, sf):
    q = fr.psf_quality(F.when(C("k") == 7, 1.0).otherwise(0.0), C("k"), C("q"), C("d"))
    return _li(spark, sf).select("id", "p", q.alias("z")).select("id", "p", C("z.fit_status").alias("st"), F.round("z.sigma", 6).alias("sigma"), F.round("z.q", 6).alias("qpsf"))


_QF = "CASE WHEN (f & 16) <> 0 THEN 0 WHEN (f & 2) <> 0 THEN 0.1 WHEN (f & 1) <> 0 THEN 1 ELSE 0.5 END::DOUBLE"


@query("x_quality_factor", f"WITH c AS (SELECT c_custkey AS id, c_custkey % 32 AS f FROM customer) SELECT id, {_QF} AS qf FROM c")
def quality_factor(spark, sf):
    return table(spark, sf, "customer").select(C("c_custkey").alias("id"), fr.quality_factor(C("c_custkey") % 32).alias("qf"))


@query("x_upm_raw_weight", f"WITH {_LI}, f AS (SELECT *, p % 32 AS f FROM li) SELECT id, p, round({_QF} * d, 6) AS w, round({_QF} * least(1, greatest(0, t * 20)) * (q * q / (1 + q * q)) / greatest(abs(d), 0.001) ** 2, 4) AS legacy FROM f WHERE d > 0")
def upm_raw_weight(spark, sf):
    f = C("p") % 32
    return _li(spark, sf).where("d > 0").select("id", "p", F.round(fr.control_weight(f, C("d")), 6).alias("w"), F.round(fr.legacy_weight(f, C("t") * 20, C("q"), C("d")), 4).alias("legacy"))


@query("x_huber", f"WITH {_LI}, r AS (SELECT id, p, (q - 25) / 10 AS r FROM li) SELECT id, p, round(CASE WHEN abs(r) <= 1.345 THEN 0.5 * r * r ELSE 1.345 * (abs(r) - 0.6725) END, 6) AS rho, round(CASE WHEN abs(r) <= 1.345 THEN 1 ELSE 1.345 / abs(r) END, 6) AS w FROM r")
def huber(spark, sf):
    r = (C("q") - 25) / 10
    return _rounded(_li(spark, sf), ["id", "p"], rho=fr.huber_rho(r), w=fr.huber_weight(r))


@query("x_tukey_w", f"WITH {_LI}, r AS (SELECT id, p, (q - 25) / 20 AS u FROM li) SELECT id, p, round(CASE WHEN abs(u) >= 1 THEN 0 ELSE (1 - u * u) ** 2 END, 6) AS w FROM r")
def tukey(spark, sf):
    return _rounded(_li(spark, sf), ["id", "p"], w=fr.tukey_weight((C("q") - 25) / 20))


@query("x_kcorr", """WITH c AS (SELECT c_custkey AS id, least(1, greatest(0.5, (c_custkey % 80) / 100.0 + 0.3))::DOUBLE AS pf, least(600, greatest(300, (c_custkey % 50) * 10 + 200))::DOUBLE AS sc FROM customer), g AS (SELECT *, (pf - 0.5) / 0.5 * 2 AS i FROM c),
h AS (SELECT *, least(floor(i), 2)::INTEGER AS a, least(floor(i) + 1, 2)::INTEGER AS b FROM g), k AS (SELECT *, [1.2112, 1.3925, 1.4980]::DOUBLE[] AS l3, [2.3958, 2.8971, 3.2035]::DOUBLE[] AS l6 FROM h),
r AS (SELECT id, sc, l3[a + 1] + (l3[b + 1] - l3[a + 1]) * (i - a) AS r3, l6[a + 1] + (l6[b + 1] - l6[a + 1]) * (i - a) AS r6 FROM k)
SELECT id, round(r3 + (r6 - r3) * (sc - 300) / 300, 6) AS k FROM r""")
def kcorr(spark, sf):
    c = table(spark, sf, "customer").select(C("c_custkey").alias("id"), (C("c_custkey") % 80 / 100 + 0.3).alias("pf"), (C("c_custkey") % 50 * 10 + 200).cast("double").alias("sc"))
    return _rounded(c, ["id"], k=fr.median_correction(C("pf"), C("sc")))


@query("x_ctrl_var", f"WITH {_LI} SELECT id, p, round(pi() / 2 * q * q / k, 6) AS var, round(k / (pi() / 2 * q * q), 8) AS ivar FROM li")
def ctrl_var(spark, sf):
    v = fr.control_variance(C("q"), C("k"))
    return _li(spark, sf).select("id", "p", F.round(v, 6).alias("var"), F.round(1 / v, 8).alias("ivar"))


_MTF = "CASE WHEN abs({m} - 0.5) < 1e-10 THEN {x} ELSE least(1, greatest(0, ({m} - 1) * {x} / ((2 * {m} - 1) * {x} - {m}))) END"


@query("x_mtf", f"WITH {_LI} SELECT id, p, round({_MTF.format(x='(q / 50)', m='(0.1 + d)')}, 6) AS y FROM li")
def mtf(spark, sf):
    return _rounded(_li(spark, sf), ["id", "p"], y=fr.midtones(C("q") / 50, C("d") + 0.1))


@query("x_tone", f"WITH {_LI}, y AS (SELECT id, p, sqrt(q / 50) AS a, ln(1 + 0.8 * q / 50) / ln(1.8::DOUBLE) AS b, asinh(0.5 * q / 50) / asinh(0.5) AS c FROM li) SELECT id, p, round({_MTF.format(x='a', m='0.25')}, 6) AS sq, round({_MTF.format(x='b', m='0.15')}, 6) AS lg, round({_MTF.format(x='c', m='0.25')}, 6) AS ash FROM y")
def tone(spark, sf):
    x = C("q") / 50
    named = {"sq": "sqrt", "lg": "log", "ash": "asinh"}
    return _rounded(_li(spark, sf), ["id", "p"], **{k: fr.tone(x, v, F.lit(fr.DISPLAY_PRESETS[v][0]), fr.DISPLAY_PRESETS[v][1]) for k, v in named.items()})


@query("x_stf_normalize", f"WITH {_LI}, s AS (SELECT id, p, least(0.999, greatest(0, q / 40 - 0.1)) AS b, least(1, greatest(0.001, e / 60000)) AS w, least(0.999, greatest(0.001, d * 12)) AS m FROM li) SELECT id, p, round(b, 9) AS black, round(CASE WHEN w <= b THEN least(1, b + 0.05) ELSE w END, 9) AS white, round(m, 9) AS mid FROM s")
def stf_normalize(spark, sf):
    s = fr.display_state(C("q") / 40 - 0.1, C("e") / 60000, C("d") * 12, C("t"))
    return _li(spark, sf).select("id", "p", s.alias("s")).select("id", "p", F.round("s.black", 9).alias("black"), F.round("s.white", 9).alias("white"), F.round("s.midtones", 9).alias("mid"))


@query("x_lod", "SELECT p_partkey AS id, greatest(0, least(7, round(7 - log2(greatest(p_size * 0.37 - 0.2, 0.1) / 1.84))::INTEGER)) AS lod FROM part")
def lod(spark, sf):
    return table(spark, sf, "part").select(C("p_partkey").alias("id"), fr.level_of_detail(C("p_size") * 0.37 - 0.2, 7).alias("lod"))


@query("x_target_nside", "WITH v AS (SELECT p_partkey AS id, ceil(58.6 / (CASE WHEN f < 0.01 THEN 60 ELSE least(f, 170) END / 768.0)) AS ideal FROM (SELECT p_partkey, p_size * 0.9 - 0.9 AS f FROM part)) SELECT id, least(8192, greatest(64, 2 ** ceil(log2(ideal))))::INTEGER AS nside FROM v")
def target_nside(spark, sf):
    return table(spark, sf, "part").select(C("p_partkey").alias("id"), fr.target_nside(C("p_size") * 0.9 - 0.9, F.lit(768), 64, 8192).cast("int").alias("nside"))


@query("x_iso_mjd", "SELECT o_orderkey AS id, round(epoch_us(o_orderdate) / 86400000000.0::DOUBLE + 40587, 6) AS mjd FROM orders")
def iso_mjd(spark, sf):
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, sf, "orders").select(C("o_orderkey").alias("id"), F.round(fr.iso_mjd(iso), 6).alias("mjd"))


@query("x_hms_dms", "SELECT c_custkey AS id, round((c_custkey % 24 + (c_custkey % 60) / 60.0::DOUBLE + (c_custkey % 59 + 0.5) / 3600.0::DOUBLE) * 15, 7) AS ra, round(CASE WHEN c_custkey % 2 = 0 THEN -1 ELSE 1 END * (c_custkey % 90 + (c_custkey % 60) / 60.0::DOUBLE + (c_custkey % 58 + 0.25) / 3600.0::DOUBLE), 7) AS dec FROM customer")
def hms_dms(spark, sf):
    k = C("c_custkey")
    part = lambda n: (k % n).cast("string")
    c = table(spark, sf, "customer").select(
        k.alias("id"), F.concat(part(24), F.lit(":"), part(60), F.lit(":"), part(59), F.lit(".5")).alias("r"), F.concat(F.when(k % 2 == 0, "-").otherwise("+"), part(90), F.lit(" "), part(60), F.lit(" "), part(58), F.lit(".25")).alias("d"))
    return c.select("id", F.round(fr.sexagesimal(C("r"), True), 7).alias("ra"), F.round(fr.sexagesimal(C("d"), False), 7).alias("dec"))


_NAMES = ["Red", "g", "BLUE", "Lum", "Ha", "OIII", "V", "sdss-r"]


@query("x_filter_map", f"WITH c AS (SELECT c_custkey AS id, {_NAMES}[c_custkey % 8 + 1] AS f FROM customer) SELECT id, CASE lower(f) WHEN 'red' THEN 'Baader R' WHEN 'g' THEN 'Baader G' WHEN 'blue' THEN 'Baader B' WHEN 'lum' THEN 'Baader UV/IR Cut / L CMOS Optimized' WHEN 'ha' THEN 'Baader 7nm H-alpha' WHEN 'oiii' THEN 'Baader 8.5nm OIII' ELSE f END AS curve FROM c")
def filter_map(spark, sf):
    f = F.get(F.array(*[F.lit(n) for n in _NAMES]), (C("c_custkey") % 8).cast("int"))
    return table(spark, sf, "customer").select(C("c_custkey").alias("id"), fr.filter_curve(f).alias("curve"))


_FILES = "f AS (SELECT o_orderkey AS id, concat('p', o_orderkey % 9000, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE concat('_', o_orderkey % 4 + 1) END, ['_od.fits.fz', '.wht.fits.fz', '.fits.fz', '.txt'][o_orderkey % 4 + 1]) AS f FROM orders)"


def _files(spark, sf):
    k = C("o_orderkey")
    tail = F.get(F.array(*[F.lit(x) for x in ("_od.fits.fz", ".wht.fits.fz", ".fits.fz", ".txt")]), (k % 4).cast("int"))
    return table(spark, sf, "orders").select(k.alias("id"), "o_orderdate", "o_totalprice", F.concat(F.lit("p"), (k % 9000).cast("string"), F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("_"), (k % 4 + 1).cast("string"))), tail).alias("f"))


@query("x_classify_file", f"WITH {_FILES}, s AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(f, '\\.fits\\.fz$', ''), '_od$', ''), '\\.wht$', '') AS stem FROM f) SELECT id, CASE WHEN f LIKE '%\\_od.fits.fz' ESCAPE '\\' THEN 'od' WHEN f LIKE '%.wht.fits.fz' THEN 'weight' WHEN f LIKE '%.fits.fz' THEN 'science' ELSE 'other' END AS kind, CASE WHEN regexp_full_match(stem, '.*_[0-9]+') THEN regexp_extract(stem, '^(.*)_([0-9]+)$', 1) ELSE stem END AS pointing, CASE WHEN regexp_full_match(stem, '.*_[0-9]+') THEN regexp_extract(stem, '^(.*)_([0-9]+)$', 2) END AS ccd FROM s")
def classify_file(spark, sf):
    f = _files(spark, sf)
    return f.select("id", fr.file_kind(C("f")).alias("kind"), fr.file_identity(C("f")).alias("i")).select("id", "kind", "i.pointing", "i.ccd")


@query("a_index_summary", f"WITH {_FILES}, j AS (SELECT CASE WHEN f LIKE '%\\_od.fits.fz' ESCAPE '\\' THEN 'od' WHEN f LIKE '%.wht.fits.fz' THEN 'weight' WHEN f LIKE '%.fits.fz' THEN 'science' ELSE 'other' END AS kind, year(o_orderdate)::INTEGER AS y, o_totalprice FROM f JOIN orders ON id = o_orderkey) SELECT y, kind, count(*) AS files, round(sum(o_totalprice), 2) AS bytes FROM j GROUP BY ROLLUP (y, kind)")
def index_summary(spark, sf):
    f = _files(spark, sf).select(F.year("o_orderdate").alias("y"), fr.file_kind(C("f")).alias("kind"), "o_totalprice")
    return f.rollup("y", "kind").agg(F.count("*").alias("files"), F.round(F.sum("o_totalprice"), 2).alias("bytes"))


@query("x_simpson", """WITH v AS (SELECT vec_id AS id, embedding AS y FROM embeddings)
SELECT id, round(list_sum(list_transform(range(0, 61), lambda i: y[i + 1]::DOUBLE * CASE WHEN i = 0 OR i = 60 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)) * 0.5 / 3 + (y[61]::DOUBLE + 3 * y[62]::DOUBLE + 3 * y[63]::DOUBLE + y[64]::DOUBLE) * 3 * 0.5 / 8, 6) AS s64, round(list_sum(list_transform(range(0, 63), lambda i: y[i + 1]::DOUBLE * CASE WHEN i = 0 OR i = 62 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)) * 0.5 / 3, 6) AS s63 FROM v""")
def simpson(spark, sf):
    y = C("embedding").cast("array<double>")
    return table(spark, sf, "embeddings").select(C("vec_id").alias("id"), F.round(fr.simpson(y, 0.5), 6).alias("s64"), F.round(fr.simpson(F.slice(y, 1, 63), 0.5), 6).alias("s63"))


@query("x_prepare_curve", f"WITH {SAMPLES}, c AS (SELECT pix, l_linenumber AS wl, v, row_number() OVER (PARTITION BY pix, l_linenumber ORDER BY l_orderkey, l_linenumber, l_suppkey, l_shipdate, l_returnflag, l_extendedprice) AS r FROM sm) SELECT pix, wl, v FROM c WHERE r = 1")
def prepare_curve(spark, sf):
    s = samples(spark, sf).groupBy("pix").agg(F.sort_array(F.collect_list(F.struct(F.struct("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag", "l_extendedprice").alias("o"), "v"))).alias("s"))
    points = F.transform("s", lambda x: F.struct(x["o"]["l_linenumber"].alias("wl"), x["v"].alias("val")))
    return s.select("pix", F.explode(fr.prepared_curve(points)).alias("c")).select("pix", "c.wl", C("c.val").alias("v"))


@query("x_sha256", "SELECT event_id AS id, sha256(props) AS digest FROM events")
def sha256(spark, sf):
    return table(spark, sf, "events").select(C("event_id").alias("id"), F.sha2("props", 256).alias("digest"))


@query("x_header_kv", "SELECT event_id AS id, (props::JSON ->> '$.k')::INTEGER AS k FROM events")
def header_kv(spark, sf):
    kv = F.from_json("props", "map<string,string>")
    return table(spark, sf, "events").select(C("event_id").alias("id"), F.try_element_at(kv, F.lit("k")).cast("int").alias("k"))


@query("f_mag_range", f"WITH {CATALOG} SELECT source_id FROM cat WHERE mag >= 2 AND mag <= 7")
def mag_range(spark, sf):
    return catalog(spark, sf).where(C("mag").between(2, 7)).select("source_id")


@query("f_reject_star", f"WITH {_LI} SELECT id, p, CASE WHEN q < 5 THEN 1 WHEN q > 45 THEN 2 WHEN d > 0.09 THEN 3 WHEN t > 0.07 THEN 4 WHEN e > 60000 THEN 5 ELSE 0 END AS code FROM li")
def reject_star(spark, sf):
    code = F.when(C("q") < 5, 1).when(C("q") > 45, 2).when(C("d") > 0.09, 3).when(C("t") > 0.07, 4).when(C("e") > 60000, 5).otherwise(0)
    return _li(spark, sf).select("id", "p", code.alias("code"))


_BENT = "b AS (SELECT id, p, CASE WHEN p % 97 = 0 THEN 'NaN'::DOUBLE WHEN p % 89 = 0 THEN 'Infinity'::DOUBLE ELSE e END AS v, k, d FROM li)"


def _bent(spark, sf):
    li = _li(spark, sf)
    return li.withColumn("v", F.when(C("p") % 97 == 0, F.lit(math.nan)).when(C("p") % 89 == 0, F.lit(math.inf)).otherwise(C("e")))


@query("f_valid_pixel", f"WITH {_LI}, {_BENT} SELECT id, p, v FROM b WHERE isfinite(v) AND v < 50000")
def valid_pixel(spark, sf):
    return _bent(spark, sf).where(fr.finite(C("v")) & (C("v") < 50000)).select("id", "p", "v")


@query("f_eligibility", f"WITH {_LI}, {_BENT}, r AS (SELECT p % 50 AS g, CASE WHEN NOT isfinite(v) THEN 'nonfinite' WHEN k = 7 THEN 'invalid' WHEN d <= 0.01 THEN 'support' WHEN (k & 1) = 0 THEN 'flags' ELSE 'eligible' END AS why FROM b) SELECT g, why, count(*) AS n FROM r GROUP BY ALL")
def eligibility(spark, sf):
    why = F.when(~fr.finite(C("v")), "nonfinite").when(C("k") == 7, "invalid").when(C("d") <= 0.01, "support").when(C("k").bitwiseAND(F.lit(1)) == 0, "flags").otherwise("eligible")
    return _bent(spark, sf).groupBy((C("p") % 50).alias("g"), why.alias("why")).agg(F.count("*").alias("n"))


@query("f_weights_valid", f"WITH {_LI}, {_BENT} SELECT p, bool_and(isfinite(v) AND v >= 0) AS ok FROM b GROUP BY p")
def weights_valid(spark, sf):
    return _bent(spark, sf).groupBy("p").agg(F.bool_and(fr.finite(C("v")) & (C("v") >= 0)).alias("ok"))


@query("f_compat", "SELECT count(DISTINCT c_mktsegment) AS filters, count(DISTINCT c_nationkey) AS frames, bool_and(c_name IS NOT NULL) AS named, count(DISTINCT c_mktsegment) = 1 AS compatible FROM customer")
def compat(spark, sf):
    return table(spark, sf, "customer").agg(F.countDistinct("c_mktsegment").alias("filters"), F.countDistinct("c_nationkey").alias("frames"), F.bool_and(C("c_name").isNotNull()).alias("named")).withColumn("compatible", C("filters") == 1)
