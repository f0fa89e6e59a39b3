"""Queries of pattern matching, transforms between lists of stars, and distortion fits."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import solve
from skyloom.plans.registry import query
from skyloom.plans.roles import table
from skyloom.session import dealt

C = F.col
# fourteen stars a frame; of the image's stars every third is a false one
_LISTS = """cat AS (SELECT c_custkey // 14 AS frame, c_custkey AS id, (c_custkey * 7919) % 1013 + (c_custkey * 31) % 97 / 97.0::DOUBLE AS x, (c_custkey * 104729) % 1009 + (c_custkey * 57) % 89 / 89.0::DOUBLE AS y FROM customer),
obs AS (SELECT frame, id, CASE WHEN id % 3 = 0 THEN (id * 6151) % 997 ELSE 1.25::DOUBLE * (0.8::DOUBLE * x - 0.6::DOUBLE * y) + 40 END AS x, CASE WHEN id % 3 = 0 THEN (id * 3571) % 991 ELSE 1.25::DOUBLE * (0.6::DOUBLE * x + 0.8::DOUBLE * y) - 25 END AS y FROM cat)"""


def _lists(spark, sf):
    """Lists dealt by frames, so that triples, of which a frame has many more than stars, are made by all tasks where their stars lie."""
    k = C("c_custkey")
    cat = table(spark, sf, "customer").select(F.floor(k / 14).alias("frame"), k.alias("id"), (k * 7919 % 1013 + k * 31 % 97 / 97.0).alias("x"), (k * 104729 % 1009 + k * 57 % 89 / 89.0).alias("y"))
    cat = dealt(cat, "frame")
    false = C("id") % 3 == 0
    x = F.when(false, (C("id") * 6151 % 997).cast("double")).otherwise((C("x") * 0.8 - C("y") * 0.6) * 1.25 + 40)
    y = F.when(false, (C("id") * 3571 % 991).cast("double")).otherwise((C("x") * 0.6 + C("y") * 0.8) * 1.25 - 25)
    return cat, cat.select("frame", "id", x.alias("x"), y.alias("y"))


def _triangle_sql(source: str, name: str) -> str:
    side = lambda i, j, k: f"{{'d': sqrt((s{i}.x - s{j}.x) ** 2 + (s{i}.y - s{j}.y) ** 2), 's': s{k}.id}}"
    return f"""{name}_o AS (SELECT s1.frame, list_sort([{side(1, 2, 3)}, {side(1, 3, 2)}, {side(2, 3, 1)}]) AS o FROM {source} s1 JOIN {source} s2 ON s1.frame = s2.frame AND s1.id < s2.id JOIN {source} s3 ON s3.frame = s1.frame AND s2.id < s3.id),
{name} AS (SELECT frame, o[3].s AS a, o[2].s AS b, o[1].s AS c, o[2].d / o[3].d AS ba, o[1].d / o[3].d AS ca FROM {name}_o WHERE o[3].d >= 1e-6 AND o[2].d / o[3].d <= 0.9)"""


_VOTES = f"""WITH {_LISTS}, {_triangle_sql('obs', 'l')}, {_triangle_sql('cat', 'r')}, m AS (SELECT l.frame, l.a, l.b, l.c, r.a AS a2, r.b AS b2, r.c AS c2 FROM l JOIN r ON l.frame = r.frame AND (l.ba - r.ba) ** 2 + (l.ca - r.ca) ** 2 < 4e-6),
v AS (SELECT frame, u, w, count(*) AS votes FROM (SELECT frame, a AS u, a2 AS w FROM m UNION ALL SELECT frame, b, b2 FROM m UNION ALL SELECT frame, c, c2 FROM m) GROUP BY ALL)"""


def _votes(spark, sf):
    cat, obs = _lists(spark, sf)
    return solve.votes(solve.triangles(obs, ["frame"]), solve.triangles(cat, ["frame"]), ["frame"])


@query("j_triangle_vote", f"{_VOTES} SELECT frame, u, w, votes FROM v")
def triangle_vote(spark, sf):
    return _votes(spark, sf)


@query("j_polygon", f"{_VOTES}, k AS (SELECT *, row_number() OVER (PARTITION BY frame, u ORDER BY votes DESC, w) AS ru, row_number() OVER (PARTITION BY frame, w ORDER BY votes DESC, u) AS rw FROM v WHERE votes >= 2) SELECT frame, u, w FROM k WHERE ru = 1 AND rw = 1")
def consensus(spark, sf):
    """The pairs that the votes of both sides agree on."""
    return solve.consensus(_votes(spark, sf), ["frame"]).select("frame", "u", "w")


def _pairs(spark, sf):
    cat, obs = _lists(spark, sf)
    pairs = solve.likely(_votes(spark, sf), ["frame"])
    return pairs.join(obs.withColumnRenamed("id", "u").hint("merge"), ["frame", "u"]).join(cat.select("frame", C("id").alias("w"), C("x").alias("x2"), C("y").alias("y2")).hint("merge"), ["frame", "w"])


@query("a_umeyama", f"""WITH {_LISTS}, p AS (SELECT o.frame, o.x, o.y, c.x AS x2, c.y AS y2 FROM obs o JOIN cat c ON o.frame = c.frame AND o.id = c.id WHERE o.id % 3 <> 0),
s AS (SELECT frame, covar_pop(x, x2) + covar_pop(y, y2) AS d, covar_pop(x, y2) - covar_pop(y, x2) AS c, var_pop(x) + var_pop(y) AS v, count(*) AS n FROM p GROUP BY frame) SELECT frame, round(sqrt(d * d + c * c) / v, 9) AS scale, round(atan2(c, d), 9) AS theta, n FROM s WHERE n >= 2""")
def umeyama(spark, sf):
    cat, obs = _lists(spark, sf)
    pairs = obs.where("id % 3 <> 0").join(cat.select("frame", "id", C("x").alias("x2"), C("y").alias("y2")), ["frame", "id"])
    return solve.similarity(pairs, ["frame"]).where("n >= 2").select("frame", F.round("scale", 9).alias("scale"), F.round("theta", 9).alias("theta"), "n")


@query("a_ransac", f"WITH {_LISTS} SELECT frame, 0.8::DOUBLE AS scale, round(-atan2(0.6::DOUBLE, 0.8::DOUBLE), 6) AS theta FROM cat GROUP BY frame HAVING count(*) = 14")
def ransac(spark, sf):
    """From the voted pairs, wrong ones among them, back to the transform that the lists of whole frames were made with."""
    found, _ = solve.consistent(_pairs(spark, sf), ["frame"], 0.01)
    whole = _lists(spark, sf)[0].groupBy("frame").count().where("count = 14")
    return found.join(whole.hint("merge"), "frame", "left_semi").select("frame", F.round("scale", 6).alias("scale"), F.round("theta", 6).alias("theta"))


_SIP = {"dx": {(2, 0): 3e-6, (1, 1): -2e-6, (0, 3): 4e-9}, "dy": {(0, 2): 5e-6, (2, 1): -1e-9}}


@query("a_sip_fit", """WITH t AS (SELECT unnest(['dx', 'dx', 'dx', 'dy', 'dy']) AS target, unnest([3, 4, 9, 5, 7]) AS place, unnest([3000.0, -2000.0, 4.0, 5000.0, -1.0]::DOUBLE[]) AS nano), f AS (SELECT DISTINCT event_id % 4 AS frame FROM events)
SELECT frame, target, place::INTEGER AS place, nano FROM f, t""")
def sip_fit(spark, sf):
    """The distortion that the events' places were given, back from a fit of order 3, every 50th place being off by 3 pixels; in units of 1e-9."""
    e = C("event_id")
    p = table(spark, sf, "events").select((e % 4).alias("frame"), e, (e * 7919 % 4001 - 2000).cast("double").alias("x"), (e * 104729 % 3989 - 1994).cast("double").alias("y"))
    bent = lambda c: sum((F.lit(v) * F.pow("x", F.lit(i)) * F.pow("y", F.lit(j)) for (i, j), v in _SIP[c].items()), F.lit(0.0)) + F.when(e % 50 == 0, 3.0).otherwise(0.0)
    fit = solve.polynomial_fit(p.withColumns({"dx": bent("dx"), "dy": bent("dy")}), ["frame"], ["dx", "dy"], 3, rounds=8)
    flat = fit.select("frame", "target", F.posexplode("coefficients").alias("place", "v")).select("frame", "target", "place", F.round(C("v") * 1e9, 0).alias("nano"))
    return flat.where((F.abs("nano") > 0.5) & (C("place") >= 3))
