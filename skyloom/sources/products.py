"""The product set: tiles in Parquet, partitioned by coarse tile so that a region reads its own folders only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions.frames import finite

PARTITION = "region"


def write_tiles(tiles: DataFrame, path: str, tile: str = "tile", levels: int = 5, mode: str = "overwrite") -> None:
    """tiles under path, in folders of the ancestor `levels` up and sorted by tile inside."""
    region = F.shiftright(F.col(tile), 2 * levels)
    tiles.withColumn(PARTITION, region).repartition(PARTITION).sortWithinPartitions(PARTITION, tile).write.mode(mode).partitionBy(PARTITION).parquet(path)


def read_tiles(spark: SparkSession, path: str, wanted: list[int] | None = None, tile: str = "tile", levels: int = 5) -> DataFrame:
    """All tiles, or the wanted ones: by partition, then by the statistics of the files."""
    t = spark.read.parquet(path)
    if wanted is not None:
        t = t.where(F.col(PARTITION).isin(sorted({w >> (2 * levels) for w in wanted})) & F.col(tile).isin(wanted))
    return t.drop(PARTITION)


def write_pixels(pixels: DataFrame, path: str, levels: int = 5, mode: str = "errorifexists") -> None:
    """pixels (tile, local, ...) under path, in folders like write_tiles, sorted by tile and place inside. A range of tiles is one task's, so a full region is several files."""
    at = pixels.withColumn(PARTITION, F.shiftright("tile", 2 * levels))
    at.repartitionByRange(PARTITION, "tile").sortWithinPartitions(PARTITION, "tile", "local").write.mode(mode).partitionBy(PARTITION).parquet(path)


def variances(cells: DataFrame, var_num: str = "var_num", area: str = "area") -> DataFrame:
    """cells with variance, var_num / area**2, and ivar; both NaN where area or var_num isn't positive and finite."""
    n, a = F.col(var_num).cast("double"), F.col(area).cast("double")
    good = finite(n) & finite(a) & (n > 0) & (a > 0)
    v = F.when(good, n / (a * a)).otherwise(F.lit(float("nan")))
    return cells.withColumn("variance", v).withColumn("ivar", F.when(good, a * a / n).otherwise(F.lit(float("nan"))))


def without_variance(cells: DataFrame) -> DataFrame:
    """The tiles that have no pixel with a variance."""
    return cells.groupBy("tile").agg(F.max(~F.isnan("variance")).alias("any")).where("not any").select("tile")


def write_variance(cells: DataFrame, path: str, levels: int = 5, mode: str = "errorifexists") -> None:
    """variances(cells) under path as (tile, local, variance, ivar). Nothing is written, and ValueError names up to ten tiles, if a tile has no pixel with a variance."""
    v = variances(cells).select("tile", "local", "variance", "ivar")
    bad = [r.tile for r in without_variance(v).orderBy("tile").limit(10).collect()]
    if bad:
        raise ValueError(f"tiles without valid variance: {bad}")
    write_pixels(v, path, levels, mode)


def read_leaf(spark: SparkSession, path: str, leaf: int, depth: int = 9, levels: int = 5) -> DataFrame:
    """The pixel of one leaf cell, `depth` levels below its tile, or no row: by folder, then by the statistics of tile and place."""
    tile, local = leaf >> 2 * depth, leaf & (1 << 2 * depth) - 1
    return spark.read.parquet(path).where((F.col(PARTITION) == tile >> 2 * levels) & (F.col("tile") == tile) & (F.col("local") == local)).drop(PARTITION)


def read_leaves(spark: SparkSession, path: str, leaves: DataFrame, leaf: str = "leaf", depth: int = 9, levels: int = 5) -> DataFrame:
    """leaves with their pixel, a null one where the tile or place isn't there; folders that no leaf needs are skipped where Spark can tell."""
    at = leaves.withColumn("tile", F.shiftright(leaf, 2 * depth)).withColumn("local", F.col(leaf) - F.shiftleft("tile", 2 * depth)).withColumn(PARTITION, F.shiftright("tile", 2 * levels))
    return at.join(spark.read.parquet(path), [PARTITION, "tile", "local"], "left").drop(PARTITION)


def metadata(tiles: DataFrame, order: int, tile: str = "tile", signal: str = "signal", support: str = "support") -> DataFrame:
    """One row: tiles, sky fraction, covered share and the range of the signal."""
    return tiles.agg(F.countDistinct(tile).alias("tiles"), F.avg(support).alias("mean_support"), F.min(signal).alias("data_min"), F.max(signal).alias("data_max")).withColumn("sky_fraction", F.col("tiles") / (12 * 4**order)).withColumn("hips_order", F.lit(order))
