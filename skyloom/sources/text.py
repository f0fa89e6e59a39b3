"""Text sources: properties files, catalog and boundary tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def properties(spark: SparkSession, path: str) -> DataFrame:
    """(path, key, value) of key = value lines; blank lines and comments don't count, of a key that repeats the last line counts."""
    lines = spark.read.text(path).select(F.input_file_name().alias("path"), F.trim("value").alias("line"), F.monotonically_increasing_id().alias("n"))
    kept = lines.where((F.col("line") != "") & ~F.col("line").startswith("#") & F.col("line").contains("="))
    pairs = kept.select("path", "n", F.trim(F.regexp_extract("line", "^([^=]*)=", 1)).alias("key"), F.trim(F.regexp_extract("line", "^[^=]*=(.*)$", 1)).alias("value"))
    return pairs.groupBy("path", "key").agg(F.max_by("value", "n").alias("value"))


def snr_catalog(spark: SparkSession, path: str) -> DataFrame:
    """(star_id, ra_deg, dec_deg, snr, quality_flags, photometric_status, malformed): rows that don't fit are kept as malformed, with nulls."""
    schema = "star_id long, ra_deg double, dec_deg double, snr double, quality_flags int, photometric_status int, malformed string"
    return spark.read.csv(path, schema=schema, sep="\t", comment="#", mode="PERMISSIVE", columnNameOfCorruptRecord="malformed")


def boundaries(spark: SparkSession, path: str) -> DataFrame:
    """(ra_low, ra_up, de_low, const) of tab-separated lines; comment, title, unit and ruler lines have no numbers and go."""
    parts = spark.read.text(path).where(~F.col("value").startswith("#")).select(F.split("value", "\t").alias("p")).where(F.size("p") >= 4)
    number = lambda i: F.trim(F.get("p", F.lit(i))).try_cast("double")
    rows = parts.select(number(0).alias("ra_low"), number(1).alias("ra_up"), number(2).alias("de_low"), F.trim(F.get("p", F.lit(3))).alias("const"))
    return rows.where("ra_low IS NOT NULL AND ra_up IS NOT NULL AND de_low IS NOT NULL")
