"""Queries of array kernels over blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from skyloom.operators import kernels
from skyloom.plans.registry import query
from skyloom.plans.roles import IMAGE, image, table

C = F.col


@query("k_fourier")
def fourier(spark, sf):
    f = kernels.fourier(image(spark, sf), ["frame"], 64, 64, block=16)
    return f.select("frame", "u", "v", F.round(C("re"), 3).alias("re"), F.round(C("im"), 3).alias("im"))


@query("k_fourier_energy", f"WITH {IMAGE} SELECT frame, round(4096 * sum(value * value) / 1e6, 4) AS energy, round(sum(value), 3) AS total FROM im GROUP BY frame")
def fourier_energy(spark, sf):
    """The squares of the transform add up to those of the image, and its first number is the image's sum."""
    f = kernels.fourier(image(spark, sf), ["frame"], 64, 64, block=16)
    return f.groupBy("frame").agg(F.round(F.sum(C("re") ** 2 + C("im") ** 2) / 1e6, 4).alias("energy"), F.round(F.max(F.when((C("u") == 0) & (C("v") == 0), C("re"))), 3).alias("total"))


@query("k_spmv", "SELECT l_orderkey AS row, round(sum(l_quantity * coalesce(p_size, 0)), 4)::DOUBLE AS value FROM lineitem LEFT JOIN part ON p_partkey = l_partkey GROUP BY l_orderkey")
def spmv(spark, sf):
    entries = table(spark, sf, "lineitem").select(C("l_orderkey").alias("row"), C("l_partkey").alias("col"), C("l_quantity").cast("double").alias("value"))
    vector = table(spark, sf, "part").select(C("p_partkey").alias("i"), C("p_size").cast("double").alias("value"))
    return kernels.sparse_product(entries, vector, block=128).select("row", F.round("value", 4).alias("value"))
