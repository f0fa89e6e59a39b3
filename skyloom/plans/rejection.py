"""Queries of outlier rejection and weighted integration."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import rejection as rj
from skyloom.plans.registry import query
from skyloom.plans.roles import SAMPLES, STACK_ORDER, STACK_SQL_ORDER, samples

RANKED = f"WITH {SAMPLES}, st AS (SELECT *, row_number() OVER (PARTITION BY {{by}} ORDER BY {STACK_SQL_ORDER}) AS ord FROM sm)"


def _stacks(spark, sf, by="pix"):
    return rj.stacks(samples(spark, sf), [by], STACK_ORDER, "v", w="w", sup="sup")


def _values():
    return F.transform("stack", lambda x: x["v"])


def _per_sample(stacked, reasons):
    """(pix, ord, reason) of each sample."""
    zipped = F.zip_with("stack", reasons, lambda s, r: F.struct(s["ord"].alias("ord"), r.cast("int").alias("reason")))
    return stacked.select(stacked.columns[0], F.explode(zipped).alias("z")).select(stacked.columns[0], F.col("z.ord").cast("long").alias("ord"), "z.reason")


_PERCENTILE = """p AS (SELECT *, median(v) OVER (PARTITION BY {by}) AS med, count(*) OVER (PARTITION BY {by}) AS n FROM st), q AS (SELECT *, CASE WHEN v - med < -abs(med) * 0.2 THEN 1 WHEN v - med > abs(med) * 0.1 THEN 2 ELSE 0 END AS raw FROM p),
r AS (SELECT *, CASE WHEN n <= 2 OR n <= 4 AND min(raw) OVER (PARTITION BY {by}) > 0 OR bool_or(NOT isfinite(v)) OVER (PARTITION BY {by}) THEN 3 ELSE raw END AS reason FROM q)"""


@query("rej_percentile", f"{RANKED.format(by='pix2')}, {_PERCENTILE.format(by='pix2')} SELECT pix2, ord, reason FROM r")
def percentile(spark, sf):
    return _per_sample(_stacks(spark, sf, "pix2"), rj.percentile_reasons(F.col("stack")))


@query("rej_minmax", f"{RANKED.format(by='pix2')}, n AS (SELECT *, count(*) OVER (PARTITION BY pix2) AS n, row_number() OVER (PARTITION BY pix2 ORDER BY v, ord) AS k FROM st) SELECT pix2, ord, CASE WHEN n - 2 < 4 THEN 3 WHEN k = 1 THEN 1 WHEN k = n THEN 2 ELSE 0 END AS reason FROM n")
def minmax(spark, sf):
    return _per_sample(_stacks(spark, sf, "pix2"), rj.minmax_reasons(F.col("stack")))


@query("rej_none", f"{RANKED.format(by='pix')} SELECT pix, count(*) AS n, 0 AS rejected FROM st GROUP BY pix")
def none(spark, sf):
    return _stacks(spark, sf).select("pix", F.size("stack").cast("long").alias("n"), F.lit(0).alias("rejected"))


def _rounds_sql(centre: str, spread: str) -> str:
    """Unrolled rounds of clipping about a centre; a round that changes nothing leaves the rest as they are."""
    out = [f"c0 AS (SELECT pix, ord, v - median(v) OVER (PARTITION BY pix) AS v FROM st WHERE pix IN (SELECT pix FROM st GROUP BY pix HAVING count(*) > 2))"]  # noqa: F541
    for i in range(8):
        out.append(f"m{i} AS (SELECT *, {centre} OVER (PARTITION BY pix) AS m FROM c{i})")
        out.append(f"d{i} AS (SELECT *, {spread} OVER (PARTITION BY pix) AS s FROM m{i})")
        out.append(f"c{i + 1} AS (SELECT pix, ord, v FROM d{i} WHERE s <= 1e-12 OR ((v - m) / s >= -4 AND (v - m) / s <= 3))")
    return ", ".join(out) + ", l AS (SELECT DISTINCT pix, m FROM m7), z AS (SELECT c0.pix, CASE WHEN c8.ord IS NOT NULL THEN 0 WHEN c0.v < m THEN 1 ELSE 2 END AS reason FROM c0 LEFT JOIN c8 ON c0.pix = c8.pix AND c0.ord = c8.ord LEFT JOIN l ON l.pix = c0.pix) SELECT st.pix, coalesce(max(low), 0) AS rejected_low, coalesce(max(high), 0) AS rejected_high, count(*) - coalesce(max(low + high), 0) AS accepted FROM st LEFT JOIN (SELECT pix, count(*) FILTER (WHERE reason = 1) AS low, count(*) FILTER (WHERE reason = 2) AS high FROM z GROUP BY pix) g ON st.pix = g.pix GROUP BY st.pix"


def _counts(spark, sf, method):
    """Of rules to which the samples' order is nothing."""
    d = rj.rejection(method, _values())
    return rj.bags(samples(spark, sf), ["pix"], "v").select("pix", d.alias("d")).select("pix", *[F.col(f"d.{c}").cast("long").alias(c) for c in ("rejected_low", "rejected_high", "accepted")])


@query("rej_sigma", f"{RANKED.format(by='pix')}, {_rounds_sql('median(v)', '1.4826 * median(abs(v - m))')}")
def sigma(spark, sf):
    return _counts(spark, sf, "sigma")


@query("rej_averaged", f"{RANKED.format(by='pix')}, {_rounds_sql('avg(v)', 'sqrt(pi() / 2) * avg(abs(v - m))')}")
def averaged(spark, sf):
    return _counts(spark, sf, "averaged")


def _full(spark, sf, method, ordered=True):
    stacked = _stacks(spark, sf) if ordered else rj.bags(samples(spark, sf), ["pix"], "v")
    return stacked.select("pix", rj.rejection(method, _values()).alias("d")).select("pix", "d.accepted", "d.rejected_low", "d.rejected_high", "d.iterations", "d.status")


@query("rej_winsor")
def winsor(spark, sf):
    return _full(spark, sf, "winsorized")


@query("rej_median_sigma")
def median_sigma(spark, sf):
    return _full(spark, sf, "median_sigma")


@query("rej_linear")
def linear(spark, sf):
    return _full(spark, sf, "linear", ordered=False)


@query("rej_esd")
def esd(spark, sf):
    return _full(spark, sf, "esd")


@query("rej_rcr")
def rcr(spark, sf):
    return _full(spark, sf, "rcr", ordered=False)


@query("rej_plan", f"WITH {SAMPLES}, n AS (SELECT pix2, count(*) AS n FROM sm GROUP BY pix2) SELECT pix2, n, CASE WHEN n < 6 THEN 'percentile' WHEN n <= 15 THEN 'winsorized' ELSE 'linear' END AS method FROM n")
def plan(spark, sf):
    return samples(spark, sf).groupBy("pix2").agg(F.count("*").alias("n")).withColumn("method", rj.auto_method(F.col("n")))


@query("a_reject_hist", f"{RANKED.format(by='pix')}, {_PERCENTILE.format(by='pix')}, c AS (SELECT pix, count(*) FILTER (WHERE reason IN (1, 2)) AS rejected FROM r GROUP BY pix) SELECT rejected, count(*) AS pixels FROM c GROUP BY rejected")
def reject_hist(spark, sf):
    rejected = F.size(F.filter(rj.percentile_reasons(F.col("stack"), in_order=True), lambda x: x.isin(rj.LOW, rj.HIGH))).cast("long")
    return rj.bags(samples(spark, sf), ["pix"], "v").groupBy(rejected.alias("rejected")).agg(F.count("*").alias("pixels"))


_INTEGRATE = """g AS (SELECT * FROM r WHERE reason IN (0, 3)), i AS (SELECT {by}, sum(w * v) / sum(w) AS signal, max(sup) AS support, count(*) AS n_used FROM g GROUP BY {by}), a AS (SELECT {by}, count(*) AS n FROM st GROUP BY {by})
SELECT a.{by}, round(signal, 7) AS signal, round(support, 6) AS support, coalesce(n_used, 0)::INTEGER AS n_used, n::INTEGER AS n_candidates, CASE WHEN n_used IS NULL THEN 2 ELSE 0 END AS status FROM a LEFT JOIN i ON a.{by} = i.{by}"""


def _mosaic(spark, sf, by):
    stacked = rj.bags(samples(spark, sf), [by], "v", w="w", sup="sup")
    r = rj.integrate(F.col("stack"), rj.percentile_reasons(F.col("stack"), in_order=True))
    return stacked.select(by, r.alias("r")).select(by, F.round("r.signal", 7).alias("signal"), F.round("r.support", 6).alias("support"), "r.n_used", "r.n_candidates", "r.status")


@query("mosaic_stack", f"{RANKED.format(by='pix')}, {_PERCENTILE.format(by='pix')}, {_INTEGRATE.format(by='pix')}")
def mosaic_stack(spark, sf):
    return _mosaic(spark, sf, "pix")


@query("a_wmean", f"{RANKED.format(by='pix2')}, {_PERCENTILE.format(by='pix2')}, {_INTEGRATE.format(by='pix2')}")
def wmean(spark, sf):
    return _mosaic(spark, sf, "pix2")


@query("mosaic_auto")
def mosaic_auto(spark, sf):
    """Rejection by the method that suits each stack's depth, then integration: one scan and one exchange."""
    stacked = _stacks(spark, sf, "pix2").withColumn("reasons", rj.rejection("auto", _values())["reasons"])
    return stacked.select("pix2", rj.auto_method(F.size("stack")).alias("method"), rj.integrate(F.col("stack"), F.col("reasons")).alias("r")).select("pix2", "method", "r.*")
