"""Queries of the sky-frame operators, with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyloom.plans import aggregates, detect, fits, frames, geometry, kernels, mosaic, products, rejection, sampler, selection, solve, spatial, sphere  # noqa: F401  each registers its queries
from skyloom.plans.registry import QUERIES, SQL, Query


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return QUERIES["mosaic_stack"](spark, sf_dir)


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
