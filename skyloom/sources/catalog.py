"""A star catalog in Parquet: folders of coarse cells, sorted by fine cells inside, so that a cone reads the folders and row groups that it reaches."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.operators.spatial import place_pairs, places
from skyloom.operators.sphere import cells_in_disc, disc_cells, unit
from skyloom.session import dealt, tasks

REGION, CELL = "region", "cell"


def write_catalog(stars: DataFrame, path: str, coarse: int = 3, fine: int = 9, mode: str = "errorifexists") -> None:
    """stars (ra, dec in degrees, …) under path. A range of cells is one of many tasks', which share the folders out; a dense region is several files; stars without a position are left out."""
    at = dealt(stars).withColumn(CELL, hp.ang2pix(fine, F.col("ra"), F.col("dec"))).where(F.col(CELL).isNotNull())
    at = at.withColumn(REGION, F.shiftright(CELL, 2 * (fine - coarse)).cast("int"))
    at.repartitionByRange(tasks(at.sparkSession), REGION, CELL).sortWithinPartitions(REGION, CELL).write.mode(mode).partitionBy(REGION).parquet(path)


def _ranges(cells: np.ndarray, most: int) -> list[tuple[int, int]]:
    """At most `most` ranges that hold the cells: where there are more, the narrowest gaps close."""
    c = np.unique(cells)
    gap = np.diff(c)
    cuts = np.flatnonzero(gap > 1)
    if len(cuts) >= most:
        cuts = np.sort(cuts[np.argsort(-gap[cuts], kind="stable")[: most - 1]])
    return [(int(c[i]), int(c[j])) for i, j in zip(np.concatenate([[0], cuts + 1]), np.concatenate([cuts, [len(c) - 1]]), strict=True)]


def read_cone(spark: SparkSession, path: str, ra: float, dec: float, radius: float, coarse: int = 3, fine: int = 9, ranges: int = 32) -> DataFrame:
    """Stars within radius degrees of a direction, with dist: folders by the cone's coarse cells, row groups by ranges of its fine ones (of the finest order at which they are few), then by the distance itself."""
    centre, r = unit(np.array([ra]), np.array([dec])), np.array([np.radians(radius)])
    depth = min(fine, max(coarse, int(np.log2(60 / max(radius, 1e-3))) + 3))  # some hundred cells
    cells = disc_cells(centre, r, depth, touching=True)[1]
    inside = F.lit(False)
    for low, high in _ranges(cells, ranges):
        inside |= F.col(CELL).between(low << 2 * (fine - depth), ((high + 1) << 2 * (fine - depth)) - 1)
    regions = sorted({int(c) >> 2 * (depth - coarse) for c in cells})
    near = spark.read.parquet(path).where(F.col(REGION).isin(regions) & inside)
    return near.withColumn("dist", hp.angular_distance(F.col("ra"), F.col("dec"), F.lit(float(ra)), F.lit(float(dec)))).where(F.col("dist") <= radius).drop(REGION, CELL)


def cone_places(spark: SparkSession, path: str, points: DataFrame, radius: float, kept: Column, mine: Column, coarse: int = 3, ra: str = "ra0", dec: str = "dec0") -> DataFrame:
    """(points, stars, dist, ...): for each two places within radius degrees that points and stars stand at, arrays of `mine` of the points and `kept` of the stars there; of many at one place several rows. Only folders that a point reaches are read where Spark can tell beforehand."""
    want = cells_in_disc(points.select(ra, dec), radius, coarse, ra, dec, touching=True).select(F.col("pix").cast("int").alias(REGION)).distinct()
    stars = spark.read.parquet(path).join(want, REGION, "left_semi")
    return place_pairs(places(points, ra, dec, mine, "points", [ra]), places(stars, "ra", "dec", kept, "stars", ["ra"]), radius, ra0=ra, dec0=dec)


def read_cones(spark: SparkSession, path: str, points: DataFrame, radius: float, coarse: int = 3, ra: str = "ra0", dec: str = "dec0") -> DataFrame:
    """points with the stars within radius degrees of each, with dist."""
    columns = [c for c in spark.read.parquet(path).columns if c not in (REGION, CELL)]
    near = cone_places(spark, path, points, radius, F.struct(*columns), F.struct(*points.columns), coarse, ra, dec)
    return near.select("points", "dist", F.explode("stars").alias("s")).select(F.explode("points").alias("p"), "s", "dist").select("p.*", "s.*", "dist")
