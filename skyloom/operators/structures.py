"""Connected structures of masked pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.operators.robust import components

_BITS = 20


def labelled(mask: DataFrame) -> DataFrame:
    """(frame, x, y, structure, size) of mask (frame, x, y): structure names the 8-connected component, by an equi-join on shifted places and rounds of minima."""
    place = (F.shiftleft(F.col("frame").cast("long"), 2 * _BITS) + F.shiftleft(F.col("y").cast("long"), _BITS) + F.col("x")).alias("id")
    cells = mask.select("frame", "x", "y").distinct()
    named = cells.select("frame", "x", "y", place)
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((1, 0), (-1, 1), (0, 1), (1, 1))]))
    ahead = named.withColumn("s", steps).select("frame", (F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y"), F.col("id").alias("a"))
    links = ahead.join(named, ["frame", "x", "y"]).select("a", F.col("id").alias("b"))
    roots = components(links, "a", "b")
    out = named.join(roots, "id", "left").select("frame", "x", "y", F.coalesce("root", "id").alias("structure"))
    return out.join(out.groupBy("structure").agg(F.count("*").alias("size")), "structure").select("frame", "x", "y", "structure", "size")


def grown(mask: DataFrame, width: int, height: int, min_size: int = 8, radius: int = 2) -> DataFrame:
    """(frame, x, y): mask, and all pixels within `radius` steps, diagonal ones too, of a structure of at least min_size pixels."""
    if radius <= 0:
        return mask.select("frame", "x", "y").distinct()
    large = labelled(mask).where(F.col("size") >= min_size)
    square = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-radius, radius + 1) for j in range(-radius, radius + 1)]))
    around = large.withColumn("s", square).select("frame", (F.col("x") + F.col("s.i")).alias("x"), (F.col("y") + F.col("s.j")).alias("y"))
    inside = around.where(F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1))
    return inside.unionByName(mask.select("frame", "x", "y")).distinct()
