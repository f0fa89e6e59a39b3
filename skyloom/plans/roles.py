"""The driver's tables in the roles of sky data, each with the SQL of the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, ra, dec, mag): a star for each customer."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(k.alias("source_id"), ((k * 137) % 3600 / F.lit(10.0)).alias("ra"), ((k * 73) % 1700 / F.lit(10.0) - 85).alias("dec"), (F.col("c_acctbal") / 1000).alias("mag"))


CATALOG = "cat AS (SELECT c_custkey AS source_id, ((c_custkey * 137) % 3600) / 10.0::DOUBLE AS ra, ((c_custkey * 73) % 1700) / 10.0::DOUBLE - 85 AS dec, c_acctbal / 1000 AS mag FROM customer)"


def pointings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(point_id, ra0, dec0): a pointing for each supplier, a little off the stars' grid."""
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(k.alias("point_id"), ((k * 211) % 3600 / F.lit(10.0) + 0.033).alias("ra0"), ((k * 97) % 1700 / F.lit(10.0) - 85 + 0.021).alias("dec0"))


POINTINGS = "pt AS (SELECT s_suppkey AS point_id, ((s_suppkey * 211) % 3600) / 10.0::DOUBLE + 0.033::DOUBLE AS ra0, ((s_suppkey * 97) % 1700) / 10.0::DOUBLE - 85 + 0.021::DOUBLE AS dec0 FROM supplier)"

PAIR = "JOIN pt ON point_id = source_id % (SELECT count(*) FROM supplier)"


def paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every star with a pointing; the pointings, numbered from 0, are dealt out in turn."""
    pt = pointings(spark, sf_dir)
    return catalog(spark, sf_dir).withColumn("point_id", F.col("source_id") % pt.agg(F.count("*")).scalar()).join(pt, "point_id")


STACK_ORDER = ["l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag", "l_extendedprice", "l_quantity", "l_discount"]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as samples: pix, a shallower pix2, frame, v, w, sup, flags, and the columns of the total order."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_partkey").alias("pix"), F.concat_ws("-", F.col("l_partkey").cast("string"), "l_returnflag", "l_linestatus").alias("pix2"), (F.col("l_suppkey") % 8).alias("frame"), (F.col("l_partkey") % 64).alias("control"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"), F.col("l_quantity").alias("w"), (F.lit(1.0) - F.col("l_discount")).alias("sup"), F.col("l_linenumber").alias("flags"), F.col("l_discount").alias("d"), F.col("l_tax").alias("t"), *STACK_ORDER)


SAMPLES = f"sm AS (SELECT l_partkey AS pix, concat_ws('-', l_partkey, l_returnflag, l_linestatus) AS pix2, l_suppkey % 8 AS frame, l_partkey % 64 AS control, l_extendedprice / l_quantity AS v, l_quantity AS w, 1.0::DOUBLE - l_discount AS sup, l_linenumber AS flags, l_discount AS d, l_tax AS t, {', '.join(STACK_ORDER)} FROM lineitem)"
STACK_SQL_ORDER = ", ".join(STACK_ORDER)


def image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(frame, x, y, value): events as pixels of frames of 64 by 64; of one pixel the mean, rounded."""
    e = F.col("event_id")
    p = table(spark, sf_dir, "events").select((e % 4).alias("frame"), (F.floor(e / 4) % 64).alias("x"), (F.floor(e / 256) % 64).alias("y"), "value")
    return p.groupBy("frame", "x", "y").agg(F.round(F.avg("value"), 4).alias("value"))


IMAGE = "im AS (SELECT event_id % 4 AS frame, (event_id // 4) % 64 AS x, (event_id // 256) % 64 AS y, round(avg(value), 4) AS value FROM events GROUP BY ALL)"
