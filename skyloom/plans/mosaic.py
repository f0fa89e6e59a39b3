"""Queries of the joint frame model."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.functions.frames import quality_factor
from skyloom.operators import upm
from skyloom.plans.registry import query
from skyloom.plans.roles import SAMPLES, samples, table

C = F.col
ROUNDS = 3


def _obs(spark, sf):
    o = samples(spark, sf).select("frame", "control", C("d").alias("v"), F.lit(0.02).alias("unc"), (quality_factor(C("flags")) * C("w")).alias("raw"))
    return upm.normalised(o)


_OBS = f"WITH {SAMPLES}, q AS (SELECT frame, control, d AS v, CASE WHEN (flags & 2) <> 0 THEN 0.1 WHEN (flags & 1) <> 0 THEN 1 ELSE 0.5 END * w AS raw FROM sm), o AS (SELECT frame, control, v, raw / sum(raw) OVER (PARTITION BY control) AS w FROM q), m0 AS (SELECT control, sum(w * v) / sum(w) AS m FROM o GROUP BY control), c0 AS (SELECT DISTINCT frame, control, 0.0::DOUBLE AS c FROM o)"
for _i in range(ROUNDS):
    _OBS += f""", h{_i} AS (SELECT o.*, c, w * CASE WHEN abs((v - m - c) / 0.02) <= 1.345 THEN 1 ELSE 1.345 / abs((v - m - c) / 0.02) END AS h FROM o JOIN m{_i} m ON o.control = m.control JOIN c{_i} c ON o.frame = c.frame AND o.control = c.control),
m{_i + 1} AS (SELECT control, CASE WHEN sum(h) FILTER (WHERE frame = 0) > 1e-12 THEN sum(h * (v - c)) FILTER (WHERE frame = 0) / sum(h) FILTER (WHERE frame = 0) ELSE sum(h * (v - c)) / sum(h) END AS m FROM h{_i} GROUP BY control),
c{_i + 1} AS (SELECT frame, h.control, CASE WHEN frame = 0 THEN 0 ELSE sum(h * (v - m)) / (sum(h) + 0.001) END AS c FROM h{_i} h JOIN m{_i + 1} m ON h.control = m.control GROUP BY frame, h.control)"""


@query("upm_fit")
def fit(spark, sf):
    """The model fitted until nothing moves by 1e-6, in 100 rounds at most: too many to unroll in SQL."""
    m, c = upm.fit(_obs(spark, sf))
    return c.join(m, "control").select("frame", "control", F.round("m", 6).alias("m"), F.round("c", 6).alias("c"))


@query("upm_fit_steps", f"{_OBS} SELECT c.frame, c.control, round(m, 6) AS m, round(c, 6) AS c FROM c{ROUNDS} c JOIN m{ROUNDS} m ON c.control = m.control")
def fit_steps(spark, sf):
    """The first three rounds, which SQL can follow."""
    m, c = upm.fit(_obs(spark, sf), rounds=ROUNDS, tolerance=0.0)
    return c.join(m, "control").select("frame", "control", F.round("m", 6).alias("m"), F.round("c", 6).alias("c"))


@query("upm_objective")
def objective(spark, sf):
    obs = _obs(spark, sf)
    return upm.objective(obs, *upm.fit(obs)).select(F.round("objective", 4).alias("objective"))


@query("upm_objective_steps", f"{_OBS} SELECT round(sum(w * CASE WHEN abs((v - m - c) / 0.02) <= 1.345 THEN 0.5 * ((v - m - c) / 0.02) ** 2 ELSE 1.345 * (abs((v - m - c) / 0.02) - 0.6725) END), 4) AS objective FROM o JOIN m{ROUNDS} m ON o.control = m.control JOIN c{ROUNDS} c ON o.frame = c.frame AND o.control = c.control")
def objective_steps(spark, sf):
    obs = _obs(spark, sf)
    m, c = upm.fit(obs, rounds=ROUNDS, tolerance=0.0)
    return upm.objective(obs, m, c).select(F.round("objective", 4).alias("objective"))


@query("upm_gauge", f"WITH {SAMPLES} SELECT DISTINCT frame, 0::BIGINT AS reference FROM sm")
def gauge(spark, sf):
    return upm.gauge(samples(spark, sf).select("frame", "control"))


@query("upm_controls", f"WITH {SAMPLES} SELECT control // 8 AS tile, min(control % 8) AS g0, max(control % 8) AS g1, count(DISTINCT control) AS controls FROM sm GROUP BY ALL")
def controls(spark, sf):
    c = samples(spark, sf).select(F.floor(C("control") / 8).alias("tile"), (C("control") % 8).alias("g"), "control")
    return c.groupBy("tile").agg(F.min("g").alias("g0"), F.max("g").alias("g1"), F.countDistinct("control").alias("controls"))


@query("upm_graph", "WITH n AS (SELECT c_custkey % 20 AS tile, (c_custkey // 20) % 8 AS gx, (c_custkey // 160) % 8 AS gy FROM customer GROUP BY ALL) SELECT a.tile, a.gx, a.gy, b.gx AS hx, b.gy AS hy FROM n a JOIN n b ON a.tile = b.tile AND ((b.gx = a.gx + 1 AND b.gy = a.gy) OR (b.gx = a.gx AND b.gy = a.gy + 1))")
def graph(spark, sf):
    """Links of a node to its right and lower neighbours in the tile: an equi-join on shifted places."""
    k = C("c_custkey")
    n = table(spark, sf, "customer").select((k % 20).alias("tile"), (F.floor(k / 20) % 8).alias("gx"), (F.floor(k / 160) % 8).alias("gy")).distinct()
    steps = F.explode(F.array(F.struct((C("gx") + 1).alias("hx"), C("gy").alias("hy")), F.struct(C("gx").alias("hx"), (C("gy") + 1).alias("hy"))))
    want = n.select("tile", "gx", "gy", steps.alias("s")).select("tile", "gx", "gy", "s.hx", "s.hy")
    return want.join(n.select("tile", C("gx").alias("hx"), C("gy").alias("hy")), ["tile", "hx", "hy"]).select("tile", "gx", "gy", "hx", "hy")


_NODES = "nd AS (SELECT c_custkey % 4 AS frame, (c_custkey // 4) % 5 AS tile, (c_custkey // 20) % 6 + 1 AS gx, (c_custkey // 120) % 5 + 2 AS gy, min(c_acctbal) / 997 AS c FROM customer GROUP BY ALL)"
_AXIS = "CASE WHEN {v} <= {lo} THEN {lo} WHEN {v} >= {hi} THEN {hi} - 64 WHEN {v} <= least({g1}, greatest({g0}, {v} // 64)) * 64 + 32 THEN least({g1}, greatest({g0}, {v} // 64)) * 64 - 32 ELSE least({g1}, greatest({g0}, {v} // 64)) * 64 + 32 END"


_FIELD = f"""WITH {_NODES}, b AS (SELECT tile, min(gx) AS gx0, max(gx) AS gx1, min(gy) AS gy0, max(gy) AS gy1 FROM nd GROUP BY tile), p AS (SELECT event_id AS id, event_id % 4 AS frame, (event_id // 4) % 5 AS tile, (event_id * 37) % 512 AS x, (event_id * 91) % 512 AS y, value FROM events),
s AS (SELECT p.*, {_AXIS.format(v='x', lo='(gx0 * 64 + 32)', hi='(gx1 * 64 + 32)', g0='gx0', g1='gx1')} AS x0, {_AXIS.format(v='y', lo='(gy0 * 64 + 32)', hi='(gy1 * 64 + 32)', g0='gy0', g1='gy1')} AS y0 FROM p JOIN b ON p.tile = b.tile),
l AS (SELECT s.*, coalesce(n00.c, 0) AS c00, coalesce(n10.c, 0) AS c10, coalesce(n01.c, 0) AS c01, coalesce(n11.c, 0) AS c11 FROM s
 LEFT JOIN nd n00 ON n00.frame = s.frame AND n00.tile = s.tile AND n00.gx = x0 // 64 AND n00.gy = y0 // 64 LEFT JOIN nd n10 ON n10.frame = s.frame AND n10.tile = s.tile AND n10.gx = x0 // 64 + 1 AND n10.gy = y0 // 64
 LEFT JOIN nd n01 ON n01.frame = s.frame AND n01.tile = s.tile AND n01.gx = x0 // 64 AND n01.gy = y0 // 64 + 1 LEFT JOIN nd n11 ON n11.frame = s.frame AND n11.tile = s.tile AND n11.gx = x0 // 64 + 1 AND n11.gy = y0 // 64 + 1)"""
_AT = "(c00 + (x - x0) / 64.0 * (c10 - c00)) * (1 - (y - y0) / 64.0) + (c01 + (x - x0) / 64.0 * (c11 - c01)) * ((y - y0) / 64.0)"


def _nodes_and_pixels(spark, sf):
    k, e = C("c_custkey"), C("event_id")
    nodes = table(spark, sf, "customer").select((k % 4).alias("frame"), (F.floor(k / 4) % 5).alias("tile"), (F.floor(k / 20) % 6 + 1).alias("gx"), (F.floor(k / 120) % 5 + 2).alias("gy"), C("c_acctbal"))
    nodes = nodes.groupBy("frame", "tile", "gx", "gy").agg((F.min("c_acctbal") / 997).alias("c"))
    return nodes, table(spark, sf, "events").select(e.alias("id"), (e % 4).alias("frame"), (F.floor(e / 4) % 5).alias("tile"), (e * 37 % 512).alias("x"), (e * 91 % 512).alias("y"), "value")


@query("upm_calibrate", f"{_FIELD} SELECT id, round(value - ({_AT}), 9) AS value FROM l")
def calibrate(spark, sf):
    nodes, pixels = _nodes_and_pixels(spark, sf)
    return upm.evaluate(pixels, nodes).select("id", F.round(C("value") - C("c"), 9).alias("value"))


@query("upm_dense", f"{_FIELD} SELECT id, round({_AT}, 9) AS c FROM l")
def dense(spark, sf):
    """The whole field of every tile, read at the events' pixels."""
    nodes, pixels = _nodes_and_pixels(spark, sf)
    return pixels.join(upm.dense(nodes), ["frame", "tile"]).select("id", F.round(F.get("field", (C("x") * 512 + C("y")).cast("int")), 9).alias("c"))


@query("upm_fit_smooth")
def fit_smooth(spark, sf):
    """The fit with a pull between neighbours, the controls being one tile's; four rounds at most."""
    grid = samples(spark, sf).select("control", F.lit(5).cast("long").alias("tile"), F.floor(C("control") / 8).alias("gx"), (C("control") % 8).alias("gy")).distinct()
    m, c = upm.fit_smoothed(_obs(spark, sf), upm.linked(grid, 1), 0.2, rounds=4, tolerance=1e-4)
    return c.join(m, "control").select("frame", "control", F.round("m", 5).alias("m"), F.round("c", 5).alias("c"))


@query("upm_graph_tiles")
def graph_tiles(spark, sf):
    """Links of the customers' control nodes in tiles and across their borders."""
    k = C("c_custkey")
    n = table(spark, sf, "customer").select((k % 48).alias("tile"), (F.floor(k / 48) % 8).alias("gx"), (F.floor(k / 384) % 8).alias("gy")).distinct()
    return upm.linked(n.withColumn("control", C("tile") * 64 + C("gx") * 8 + C("gy")), 1)
