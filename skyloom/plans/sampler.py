"""Queries of control samples, image neighbourhoods, identities and product tiles."""

from __future__ import annotations

import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.operators import darks, robust, sampler, upm
from skyloom.plans.registry import query
from skyloom.plans.roles import IMAGE, SAMPLES, image, samples, table
from skyloom.session import shared_base
from skyloom.sources import products

C = F.col
#: Cells of 8 pixels on the 64-pixel frames of the test tables; the patch is the whole cell but its first row and column.
SMALL = sampler.Sampler(cell=8, radius=3)


def _pixels(spark, sf):
    return image(spark, sf).select("frame", (C("frame") * 0).alias("tile"), "x", "y", C("value").alias("signal"), (((C("x") + C("y")) % 5 + 1) / F.lit(5.0)).alias("support"))


_MAD = "1.4826 * list_median(list_transform({l}, lambda v: abs(v - {m})))"
_PATCH = f"""WITH {IMAGE}, px AS (SELECT frame, 0::BIGINT AS tile, x // 8 AS gx, y // 8 AS gy, value AS signal, ((x + y) % 5 + 1) / 5.0::DOUBLE AS support FROM im WHERE x % 8 > 0 AND y % 8 > 0),
ce AS (SELECT frame, tile, gx, gy, list_sort(list(signal)) AS l, avg(support) AS support, count(*) AS n FROM px GROUP BY ALL),
k0 AS (SELECT *, m, {_MAD.format(l='l', m='m')} AS s, l AS kept, true AS go FROM (SELECT *, list_median(l) AS m FROM ce WHERE n >= 5))"""
for _i in range(3):
    _PATCH += f""", f{_i} AS (SELECT * EXCLUDE (x), x, list_median(x) AS nm FROM (SELECT *, list_filter(kept, lambda v: v <= m + 3 * s) AS x FROM k{_i})),
g{_i} AS (SELECT *, CASE WHEN NOT go OR len(x) < 5 THEN 0 WHEN abs(nm - m) < 1e-12 * greatest(abs(m), 1e-12) THEN 1 ELSE 2 END AS act, {_MAD.format(l='x', m='nm')} AS ns FROM f{_i}),
k{_i + 1} AS (SELECT frame, tile, gx, gy, l, support, n, CASE act WHEN 2 THEN nm ELSE m END AS m, CASE WHEN act = 2 AND ns > 0 THEN ns ELSE s END AS s, CASE act WHEN 0 THEN kept ELSE x END AS kept, act = 2 AND ns > 0 AS go FROM g{_i})"""
_PATCH += """, st AS (SELECT ce.frame, ce.tile, ce.gx, ce.gy, coalesce(m, 0) AS m, CASE WHEN k.n IS NULL THEN 0 WHEN s > 0 THEN s ELSE 1e-12 END AS mad, coalesce(len(list_filter(k.l, lambda v: v > m + 3 * (CASE WHEN s > 0 THEN s ELSE 1e-12 END))) / k.n, 0) AS bright,
 ce.n AS n_total, coalesce(len(kept), 0) AS n_retained, coalesce(k.support, 0) AS support, CASE WHEN k.n IS NULL THEN 1 ELSE 0 END AS reason FROM ce LEFT JOIN k3 k ON ce.frame = k.frame AND ce.gx = k.gx AND ce.gy = k.gy)"""
_GATES = f"""{_PATCH}, nb AS (SELECT a.frame, a.gx, a.gy, list(b.m) AS al, list(b.m) FILTER (WHERE abs(b.gx - a.gx) <= 2 AND abs(b.gy - a.gy) <= 2) AS ne FROM st a JOIN st b ON a.frame = b.frame GROUP BY ALL),
ch AS (SELECT frame, gx, gy, list_sort(CASE WHEN len(ne) < 3 THEN al ELSE ne END) AS v FROM nb), li AS (SELECT *, v[len(v) // 2 + 1] AS b FROM ch),
lm AS (SELECT frame, gx, gy, CASE WHEN len(v) >= 3 THEN b + 3 * 1.4826 * list_sort(list_transform(v, lambda x: abs(x - b)))[len(v) // 2 + 1] END AS lim FROM li),
gt AS (SELECT st.* EXCLUDE (reason), CASE WHEN st.reason <> 0 THEN st.reason WHEN (st.gx * 3 + st.gy * 5 + st.frame) % 23 = 0 THEN 5 WHEN lim IS NULL THEN 0 WHEN m > lim THEN 3 WHEN bright > 0.2 THEN 4 WHEN n_retained < 0.6 * n_total THEN 2 ELSE 0 END AS reason FROM st JOIN lm ON st.frame = lm.frame AND st.gx = lm.gx AND st.gy = lm.gy)"""


def _gated(spark, sf):
    veto = (C("gx") * 3 + C("gy") * 5 + C("frame")) % 23 == 0
    return sampler.gates(sampler.patch_statistics(_pixels(spark, sf), SMALL), SMALL, veto)


@query("a_patch_stat", f"{_PATCH} SELECT frame, gx, gy, round(m, 4) AS m, round(mad, 4) AS mad, round(bright, 6) AS bright, n_total, n_retained, round(support, 6) AS support, reason FROM st")
def patch_stat(spark, sf):
    s = sampler.patch_statistics(_pixels(spark, sf), SMALL)
    return s.select("frame", "gx", "gy", F.round("m", 4).alias("m"), F.round("mad", 4).alias("mad"), F.round("bright", 6).alias("bright"), C("n_total").cast("long").alias("n_total"), C("n_retained").cast("long").alias("n_retained"), F.round("support", 6).alias("support"), "reason")


@query("f_sampler_gates", f"{_GATES} SELECT frame, gx, gy, reason FROM gt")
def sampler_gates(spark, sf):
    return _gated(spark, sf).select("frame", "gx", "gy", "reason")


@query("upm_sample", f"{_GATES}, n AS (SELECT *, count(*) OVER (PARTITION BY gx, gy) AS frames FROM gt WHERE reason = 0) SELECT gx * 8 + gy AS control, frame, round(m, 4) AS value, round(sqrt(1.4 * pi() / 2 * mad * mad / greatest(n_retained, 1)), 6) AS unc FROM n WHERE frames >= 2")
def upm_sample(spark, sf):
    return sampler.observations(_gated(spark, sf)).select((C("gx") * 8 + C("gy")).alias("control"), "frame", F.round("m", 4).alias("value"), F.round(F.sqrt("variance"), 6).alias("unc"))


@query("w_cell_neighbourhood", f"{_PATCH} SELECT a.frame, a.gx, a.gy, count(*) AS n, round(median(b.m), 4) AS med FROM st a JOIN st b ON a.frame = b.frame AND abs(a.gx - b.gx) <= 2 AND abs(a.gy - b.gy) <= 2 GROUP BY ALL")
def cell_neighbourhood(spark, sf):
    """The median over the cells within two of each cell: an equi-join on shifted cells."""
    s = sampler.patch_statistics(_pixels(spark, sf), SMALL).select("frame", "gx", "gy", "m")
    shift = F.explode(F.sequence(F.lit(-2), F.lit(2)))
    sent = s.withColumn("dx", shift).withColumn("dy", shift).select("frame", (C("gx") + C("dx")).alias("gx"), (C("gy") + C("dy")).alias("gy"), "m")
    return s.select("frame", "gx", "gy").join(sent, ["frame", "gx", "gy"]).groupBy("frame", "gx", "gy").agg(F.count("*").alias("n"), F.round(robust.median(C("m")), 4).alias("med"))


_TAPS = "t AS (SELECT im.frame, im.x + dx AS x, im.y + dy AS y, im.value AS v, dx, dy FROM im, (SELECT unnest([-1, 0, 1]) AS dx), (SELECT unnest([-1, 0, 1]) AS dy))"


@query("w_stencils", f"WITH {IMAGE}, {_TAPS}, g AS (SELECT frame, x, y, median(v) AS med, min(v) AS eroded, max(v) AS dilated, max(v) FILTER (WHERE dx <> 0 OR dy <> 0) AS beside, round(sum(v * [1, 2, 1][dx + 2] * [1, 2, 1][dy + 2]) / sum([1, 2, 1][dx + 2] * [1, 2, 1][dy + 2]), 6) AS smooth FROM t GROUP BY ALL) SELECT im.frame, im.x, im.y, med, eroded, dilated, smooth, coalesce(value > beside, true) AS peak FROM im JOIN g ON im.frame = g.frame AND im.x = g.x AND im.y = g.y")
def stencils(spark, sf):
    """Median, erosion, dilation, binomial smoothing and local maxima over 3 by 3 pixels; what is missing doesn't count. Each pixel is sent to its neighbours once for all of them."""
    im = image(spark, sf)
    taps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy"), F.lit(float((2 - abs(i)) * (2 - abs(j)))).alias("k")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    sent = im.withColumn("t", F.explode(taps)).select("frame", (C("x") + C("t.dx")).alias("x"), (C("y") + C("t.dy")).alias("y"), C("value").alias("v"), C("t.k").alias("k"), ((C("t.dx") == 0) & (C("t.dy") == 0)).alias("own"))
    g = sent.groupBy("frame", "x", "y").agg(
        robust.median(C("v")).alias("med"), F.min("v").alias("eroded"), F.max("v").alias("dilated"), F.max(F.when(~C("own"), C("v"))).alias("beside"), F.max(F.when(C("own"), C("v"))).alias("value"),
        F.round(F.sum(C("v") * C("k")) / F.sum("k"), 6).alias("smooth"))
    return g.where(C("value").isNotNull()).select("frame", "x", "y", "med", "eroded", "dilated", "smooth", F.coalesce(C("value") > C("beside"), F.lit(True)).alias("peak"))


@query("img_background", f"WITH {IMAGE}, me AS (SELECT frame, x // 16 AS mx, y // 16 AS my, median(value) AS b FROM im GROUP BY ALL), sm AS (SELECT a.frame, a.mx, a.my, median(c.b) AS b FROM me a JOIN me c ON a.frame = c.frame AND abs(a.mx - c.mx) <= 1 AND abs(a.my - c.my) <= 1 GROUP BY ALL) SELECT im.frame, x, y, round(value - b, 7) + 0.0::DOUBLE AS v FROM im JOIN sm ON im.frame = sm.frame AND x // 16 = mx AND y // 16 = my")
def background(spark, sf):
    """Values less the background of their mesh cell: medians of 16 by 16 pixels, smoothed by a median over 3 by 3 cells."""
    im = image(spark, sf).withColumn("mx", F.floor(C("x") / 16)).withColumn("my", F.floor(C("y") / 16))
    mesh = im.groupBy("frame", "mx", "my").agg(robust.median(C("value")).alias("b"))
    shift = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    sent = mesh.withColumn("dx", shift).withColumn("dy", shift).select("frame", (C("mx") + C("dx")).alias("mx"), (C("my") + C("dy")).alias("my"), "b")
    smooth = sent.groupBy("frame", "mx", "my").agg(robust.median(C("b")).alias("b"))
    return im.join(smooth, ["frame", "mx", "my"]).select("frame", "x", "y", (F.round(C("value") - C("b"), 7) + F.lit(0.0)).alias("v"))


@query("img_cosmetic", f"""WITH {IMAGE}, h AS (SELECT *, CASE WHEN value > 480 OR value < 2 THEN NULL ELSE value END AS v FROM im), n AS (SELECT *, last_value(v IGNORE NULLS) OVER l AS lv, first_value(v IGNORE NULLS) OVER r AS rv FROM h
 WINDOW l AS (PARTITION BY frame, y ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), r AS (PARTITION BY frame, y ORDER BY x ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) SELECT frame, x, y, round(coalesce(v, (lv + rv) / 2, lv, rv, value), 6) AS value, v IS NULL AS repaired FROM n""")
def cosmetic(spark, sf):
    """Hot and cold pixels repaired from the nearest good ones of their row."""
    h = image(spark, sf).withColumn("v", F.when(~((C("value") > 480) | (C("value") < 2)), C("value")))
    w = Window.partitionBy("frame", "y").orderBy("x")
    left, right = F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.first("v", True).over(w.rowsBetween(1, Window.unboundedFollowing))
    n = h.withColumn("lv", left).withColumn("rv", right)
    return n.select("frame", "x", "y", F.round(F.coalesce("v", (C("lv") + C("rv")) / 2, "lv", "rv", "value"), 6).alias("value"), C("v").isNull().alias("repaired"))


@query("x_frame_id", f"WITH {SAMPLES}, r AS (SELECT frame, control, sha256(concat_ws('|', pix, flags, l_orderkey, l_linenumber)) AS h FROM sm), p AS (SELECT frame, control, sha256(string_agg(h, '' ORDER BY h)) AS h FROM r GROUP BY ALL) SELECT frame, sha256(string_agg(h, '' ORDER BY control)) AS manifest, substr(sha256(string_agg(h, '' ORDER BY control)), 1, 16) AS frame_id FROM p GROUP BY frame")
def frame_id(spark, sf):
    """An identity of a frame's content: hashes of rows, of parts, of the frame, so that no task holds more than one part's hashes; the order of rows and files doesn't count."""
    r = samples(spark, sf).select("frame", "control", F.sha2(F.concat_ws("|", "pix", "flags", "l_orderkey", "l_linenumber"), 256).alias("h"))
    p = r.groupBy("frame", "control").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("h")), ""), 256).alias("h"))
    whole = F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("control", "h"))), lambda x: x["h"]), ""), 256)
    return p.groupBy("frame").agg(whole.alias("manifest")).withColumn("frame_id", F.substring("manifest", 1, 16))


@query("x_star_id", "WITH q AS (SELECT c_custkey, c_nationkey AS frame, round(c_acctbal)::BIGINT % 50 AS cell FROM customer) SELECT c_custkey AS id, frame, cell, row_number() OVER (PARTITION BY frame, cell ORDER BY c_custkey) - 1 AS probe FROM q")
def star_id(spark, sf):
    """A star's identity: its frame, its quantised place, and its turn among those of the same place."""
    q = table(spark, sf, "customer").select(C("c_custkey").alias("id"), C("c_nationkey").alias("frame"), (F.round("c_acctbal").cast("long") % 50).alias("cell"))
    return q.withColumn("probe", F.row_number().over(Window.partitionBy("frame", "cell").orderBy("id")).cast("long") - 1)


@query("x_nside_from_cd", "WITH c AS (SELECT s_suppkey AS id, 1e-4 * (1 + s_suppkey % 40) AS cd11, 1e-5 * (s_suppkey % 7) AS cd12, -1e-5 * (s_suppkey % 5) AS cd21, 1e-4 * (1 + s_suppkey % 40) AS cd22 FROM supplier), s AS (SELECT id, sqrt(abs(cd11 * cd22 - cd12 * cd21)) * 3600 AS scale FROM c) SELECT id, round(scale, 6) AS scale, least(4194304, greatest(16, 2 ** ceil(log2(211034.6 / scale))))::BIGINT AS nside FROM s")
def nside_from_cd(spark, sf):
    k = C("s_suppkey")
    c = table(spark, sf, "supplier").select(k.alias("id"), (F.lit(1e-4) * (1 + k % 40)).alias("cd11"), (F.lit(1e-5) * (k % 7)).alias("cd12"), (F.lit(-1e-5) * (k % 5)).alias("cd21"), (F.lit(1e-4) * (1 + k % 40)).alias("cd22"))
    s = c.select("id", hp.pixel_scale(*[C(x) for x in ("cd11", "cd12", "cd21", "cd22")]).alias("scale"))
    return s.select("id", F.round("scale", 6).alias("scale"), hp.nside_for_scale(C("scale")).alias("nside"))


@query("f_nonref_degenerate", "WITH f AS (SELECT c_custkey AS id, (c_custkey % 130) / 100.0::DOUBLE AS dra, ((c_custkey * 7) % 125) / 100.0::DOUBLE AS ddec FROM customer) SELECT id FROM f WHERE dra BETWEEN 0.1 AND 1.0 AND ddec BETWEEN 0.1 AND 1.0")
def nonref_degenerate(spark, sf):
    """Frames whose corners span 0.1 to 1 degrees on both axes."""
    k = C("c_custkey")
    f = table(spark, sf, "customer").select(k.alias("id"), (k % 130 / F.lit(100.0)).alias("dra"), (k * 7 % 125 / F.lit(100.0)).alias("ddec"))
    return f.where(C("dra").between(0.1, 1.0) & C("ddec").between(0.1, 1.0)).select("id")


_LINKS = "ln AS (SELECT DISTINCT s_suppkey AS a, s_suppkey + CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 2 END AS b FROM supplier WHERE s_suppkey % 7 <> 0)"


@query("a_geo_components", f"WITH RECURSIVE {_LINKS}, e AS (SELECT a, b FROM ln UNION SELECT b, a FROM ln), r(id, root) AS (SELECT DISTINCT a, a FROM e UNION SELECT e.b, r.root FROM r JOIN e ON r.id = e.a) SELECT id, min(root) AS root FROM r GROUP BY id")
def geo_components(spark, sf):
    """Components of linked controls."""
    k = C("s_suppkey")
    return robust.components(table(spark, sf, "supplier").where(k % 7 != 0).select(k.alias("a"), (k + F.when(k % 5 == 0, 1).otherwise(2)).alias("b")).distinct(), "a", "b")


def _model(spark, sf):
    s = samples(spark, sf).groupBy("frame", "control").agg(F.round(F.avg("d"), 4).alias("c"))
    return s.where(C("frame") > 0)


@query("upm_hash", f"WITH {SAMPLES}, c AS (SELECT frame, control, round(round(avg(d), 4) * 10000)::BIGINT AS c FROM sm WHERE frame > 0 GROUP BY ALL), f AS (SELECT frame, sha256(string_agg(concat_ws(',', control, c), ';' ORDER BY control)) AS h FROM c GROUP BY frame) SELECT sha256(string_agg(concat_ws(',', frame, h), ';' ORDER BY frame)) AS hash, count(*) AS frames FROM f")
def model_hash(spark, sf):
    """The joint model's hash: of each frame's sorted rows, then of the frames."""
    return upm.model_hash(_model(spark, sf))


@query("snk_upm_sparse", f"WITH {SAMPLES}, c AS (SELECT frame, control, round(avg(d), 4) AS c FROM sm WHERE frame > 0 GROUP BY ALL) SELECT frame, count(*) AS n, round(sum(c), 4) AS total FROM c WHERE c <> 0 GROUP BY frame")
def upm_sparse(spark, sf):
    """The model written as tables of non-zero rows, opened again and checked."""
    path = f"{shared_base(spark)}/upm-{uuid.uuid4().hex}"
    upm.save(_model(spark, sf), path)
    return upm.open_model(spark, path).groupBy("frame").agg(F.count("*").alias("n"), F.round(F.sum("c"), 4).alias("total"))


@query("upm_cg")
def smoothed(spark, sf):
    """Fields of frames that are smooth over linked controls."""
    nodes = samples(spark, sf).groupBy("frame", "control").agg(F.sum("w").alias("weight"), F.sum(C("w") * C("d")).alias("rhs"))
    x = C("control")
    links = nodes.select(x.alias("a")).distinct().select("a", F.explode(F.array(F.when(C("a") % 8 < 7, C("a") + 1), F.when(C("a") < 56, C("a") + 8))).alias("b")).where("b is not null")
    return upm.smoothed(nodes, links, smoothing=5.0, anchor=1e-3)


_VAR = f"WITH {SAMPLES}, v AS (SELECT pix // 16 AS tile, pix % 16 AS local, sum(w * d) / sum(w) AS signal, sum(sup) AS support, sum(w * w * t) / (sum(w) * sum(w)) AS variance FROM sm GROUP BY ALL)"


def _cells(spark, sf):
    """Pixels of tiles of 16: the weighted mean, and what the variance is made of."""
    t = samples(spark, sf).groupBy(F.floor(C("pix") / 16).alias("tile"), (C("pix") % 16).alias("local"))
    return t.agg((F.sum(C("w") * C("d")) / F.sum("w")).alias("signal"), F.sum(C("w") * C("w") * C("t")).alias("var_num"), F.sum("w").alias("area"))


def _signal(spark, sf) -> str:
    path = f"{shared_base(spark)}/signal-{uuid.uuid4().hex}"
    products.write_pixels(_cells(spark, sf).select("tile", "local", "signal"), path)
    return path


@query("snk_hips_var", f"{_VAR}, g AS (SELECT tile, bool_or(variance > 0 AND isfinite(variance)) AS good FROM v GROUP BY tile) SELECT v.tile, local, CASE WHEN variance > 0 THEN round(variance, 9) END AS variance, CASE WHEN variance > 0 THEN round(1 / variance, 4) END AS ivar FROM v JOIN g ON v.tile = g.tile WHERE good")
def hips_var(spark, sf):
    """Variance tiles with their inverse, written and read again. The sink refuses tiles without any variance, so these are left out beforehand."""
    path = f"{shared_base(spark)}/variance-{uuid.uuid4().hex}"
    cells = _cells(spark, sf)
    products.write_variance(cells.join(products.without_variance(products.variances(cells)), "tile", "left_anti"), path)
    shown = lambda c, places: F.when(~F.isnan(c), F.round(c, places)).alias(c)
    return products.read_tiles(spark, path).select("tile", "local", shown("variance", 9), shown("ivar", 4))


@query("src_hips_leaf", f"{_VAR} SELECT tile, local, round(signal, 7) AS signal FROM v WHERE tile = 3 AND local = 5")
def hips_leaf(spark, sf):
    """One leaf cell of written tiles: the folder of its tile is opened, and the row groups that may hold it."""
    return products.read_leaf(spark, _signal(spark, sf), 3 * 16 + 5, depth=2).select("tile", "local", F.round("signal", 7).alias("signal"))


@query("src_hips_leaves", f"{_VAR}, k AS (SELECT s_suppkey AS id, s_suppkey * 37 % 2500 AS leaf FROM supplier) SELECT id, leaf, round(signal, 7) AS signal FROM k LEFT JOIN v ON tile = leaf // 16 AND local = leaf % 16")
def hips_leaves(spark, sf):
    """The pixel of each of many leaf cells, some of which lie in no tile."""
    k = C("s_suppkey")
    wanted = table(spark, sf, "supplier").select(k.alias("id"), (k * 37 % 2500).alias("leaf"))
    return products.read_leaves(spark, _signal(spark, sf), wanted, depth=2).select("id", "leaf", F.round("signal", 7).alias("signal"))


_LIT = "CASE WHEN l_orderkey % 41 = 0 THEN 300.0::DOUBLE WHEN (l_orderkey + l_linenumber) % 29 = 0 THEN 3.0::DOUBLE WHEN l_orderkey % 31 = 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END"
_DARKS = f"""{SAMPLES}, raw AS (SELECT frame, l_linenumber AS x, l_orderkey AS y, CASE WHEN frame = 6 THEN 52.0::DOUBLE ELSE 2 + sup * 100 END AS dark, 9 + CASE WHEN frame = 5 THEN -137 ELSE 137 END * sup + t * 3 + {_LIT} AS light FROM sm),
p AS (SELECT frame, x, y, 2.0::DOUBLE AS bias, round(avg(dark), 6) AS dark, round(avg(light), 6) AS light FROM raw GROUP BY ALL), z AS (SELECT frame, 8 AS width, max(y) + 1 AS height FROM p GROUP BY frame)"""


def _darks(spark, sf):
    """Line items as pixels of frames eight wide, of one pixel the mean; some are bright stars, some off by less. One dark is flat, one light falls with its dark."""
    s = samples(spark, sf)
    n, line = C("l_orderkey"), C("l_linenumber")
    off = F.when(n % 41 == 0, 300.0).when((n + line) % 29 == 0, 3.0).when(n % 31 == 0, 0.5).otherwise(0.0)
    raw = s.select("frame", line.alias("x"), n.alias("y"), F.when(C("frame") == 6, 52.0).otherwise(C("sup") * 100 + 2).alias("dark"), (F.when(C("frame") == 5, -137).otherwise(137) * C("sup") + 9 + C("t") * 3 + off).alias("light"))
    p = raw.groupBy("frame", "x", "y").agg(F.lit(2.0).alias("bias"), *[F.round(F.avg(c), 6).alias(c) for c in ("dark", "light")])
    return p, p.groupBy("frame").agg(F.lit(8).alias("width"), (F.max("y") + 1).alias("height")).withColumn("ratio", C("frame") * 0.1 + 0.9)


def _strided_sql(pixels: str, per_cell: int, total: int) -> str:
    """t(frame, c, x, y, light, dark, bias), a strided sample of the background of p with the frames z, and n, where in it cells begin."""
    return f"""{pixels}, m AS (SELECT *, median(light) OVER (PARTITION BY frame) AS m FROM p), d AS (SELECT *, median(abs(light - m)) OVER (PARTITION BY frame) AS d FROM m),
b AS (SELECT d.*, least(7, y // greatest(1, height // 8)) * 8 + least(7, x // greatest(1, width // 8)) AS c FROM d JOIN z USING (frame) WHERE d <= 0 OR abs(light - m) <= d * 3 * 1.4826::DOUBLE),
r AS (SELECT frame, c, x, y, light, dark, bias, row_number() OVER (PARTITION BY frame, c ORDER BY y, x) - 1 AS r, greatest(1, count(*) OVER (PARTITION BY frame, c) // {per_cell}) AS s FROM b), t AS (SELECT * FROM r WHERE r % s = 0 AND r // s < {per_cell}),
n AS (SELECT frame, c, coalesce(sum(count(*)) OVER (PARTITION BY frame ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t GROUP BY frame, c)"""


_CLIPPED = "".join(f", r{i} AS (SELECT frame, x, y, regr_slope(y, x) OVER w AS k, regr_intercept(y, x) OVER w AS c, regr_sxx(y, x) OVER w AS sxx FROM i{i} WINDOW w AS (PARTITION BY frame)), d{i} AS (SELECT *, y - c - k * x AS e FROM r{i}), m{i} AS (SELECT *, median(e) OVER (PARTITION BY frame) AS m FROM d{i}), s{i} AS (SELECT *, 1.4826 * median(abs(e - m)) OVER (PARTITION BY frame) AS s FROM m{i}), i{i + 1} AS (SELECT frame, x, y, k, c, sxx FROM s{i} WHERE sxx > 1e-12 AND (s <= 0 OR abs(e - m) <= 3 * s))" for i in range(5))


# once a round keeps all, those after it give the same line; a sample that falls under 50 or loses its spread stays so
@query("a_dark_k", f"""WITH {_strided_sql(_DARKS, 1000, 50000)}, u AS (SELECT frame, dark - bias AS x, light - bias AS y FROM t JOIN n USING (frame, c) WHERE before < 50000), o AS (SELECT frame, count(*) AS n FROM u GROUP BY frame), i0 AS (SELECT u.* FROM u JOIN o USING (frame) WHERE n >= 100){_CLIPPED},
v AS (SELECT *, y - c - k * x AS e FROM i5), h AS (SELECT *, median(y) OVER (PARTITION BY frame) AS my, median(e) OVER (PARTITION BY frame) AS me FROM v),
f AS (SELECT frame, any_value(k) AS k, count(*) AS kept, median(abs(y - my)) AS wide, median(abs(e - me)) AS rest FROM h GROUP BY frame),
g AS (SELECT z.frame, coalesce(o.n, 0) AS n, f.k, coalesce(kept >= 50 AND NOT (wide > 0 AND rest >= wide) AND k > 0 AND k <= 10, false) AS ok FROM z LEFT JOIN o USING (frame) LEFT JOIN f USING (frame))
SELECT frame, round(CASE WHEN ok THEN k ELSE frame * 0.1::DOUBLE + 0.9::DOUBLE END, 6) AS k, NOT ok AS fell_back, n FROM g""")
def dark_k(spark, sf):
    """How far darks are to be scaled: the slope of light over dark, less bias, over strided samples of the frames' background, by five rounds of clipping; the exposures' ratio where that fails."""
    got = darks.dark_scales(*_darks(spark, sf))
    return got.select("frame", F.round("k", 6).alias("k"), "fell_back", C("samples").alias("n"))


_EXPOSED = "e AS (SELECT event_id % 4 AS frame, (event_id // 4) % 256 AS x, event_id // 1024 AS y, 2.0::DOUBLE AS bias, 10 + (event_id * 7919 % 1000) / 50.0::DOUBLE AS dark, value FROM events), p AS (SELECT *, round(bias + (1.1::DOUBLE + frame * 0.2::DOUBLE) * (dark - bias) + value / 50, 6) AS light FROM e), z AS (SELECT frame, 256 AS width, max(y) + 1 AS height FROM p GROUP BY frame)"


def _exposed(spark, sf):
    """Events as pixels of frames 256 wide, each a dark scaled by the frame's own factor and some light; and the frames."""
    e = C("event_id")
    p = table(spark, sf, "events").select((e % 4).alias("frame"), (F.floor(e / 4) % 256).alias("x"), F.floor(e / 1024).alias("y"), F.lit(2.0).alias("bias"), (e * 7919 % 1000 / F.lit(50.0) + 10).alias("dark"), "value")
    p = p.withColumn("light", F.round(C("bias") + (C("frame") * 0.2 + 1.1) * (C("dark") - C("bias")) + C("value") / 50, 6))
    return p, p.groupBy("frame").agg(F.lit(256).alias("width"), (F.max("y") + 1).alias("height"), F.lit(1.0).alias("ratio"))


@query("s_stride_total", f"""WITH {_EXPOSED}, m AS (SELECT *, median(light) OVER (PARTITION BY frame) AS m FROM p), d AS (SELECT *, median(abs(light - m)) OVER (PARTITION BY frame) AS d FROM m),
b AS (SELECT d.*, least(7, y // greatest(1, height // 8)) * 8 + least(7, x // greatest(1, width // 8)) AS c FROM d JOIN z USING (frame) WHERE d <= 0 OR abs(light - m) <= d * 3 * 1.4826::DOUBLE),
r AS (SELECT frame, c, x, y, row_number() OVER (PARTITION BY frame, c ORDER BY y, x) - 1 AS r, greatest(1, count(*) OVER (PARTITION BY frame, c) // 20) AS s FROM b), t AS (SELECT * FROM r WHERE r % s = 0 AND r // s < 20),
n AS (SELECT frame, c, coalesce(sum(count(*)) OVER (PARTITION BY frame ORDER BY c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM t GROUP BY frame, c)
SELECT frame, x, y FROM t JOIN n USING (frame, c) WHERE before < 1000""")
def stride_total(spark, sf):
    """A strided sample of the background of frames: 20 of a cell, cells in order until 1000."""
    pixels, frames = _exposed(spark, sf)
    return darks.strided(darks.background(pixels), frames, per_cell=20, total=1000).select("frame", "x", "y")


@query("a_dark_k_sampled")
def dark_k_sampled(spark, sf):
    """The darks' scales from strided samples, with the exposures' ratio where no slope is found."""
    got = darks.dark_scales(*_exposed(spark, sf))
    return got.withColumn("k", F.round("k", 6))
