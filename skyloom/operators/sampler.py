"""Control samples of frames: the statistic of a patch in each cell of a tile, gates that tell clean background from light, and what of it the joint model takes.

A patch holds a few hundred pixels and a tile 64 cells, so both are arrays of one row; frames and tiles spread over tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.operators.rejection import let, median, upper_median

# Reasons of a control sample.
CLEAN, SUPPORT, RETAINED, BRIGHT, CONTAMINATED, VETO = 0, 1, 2, 3, 4, 5


@dataclass(frozen=True)
class Sampler:
    """cell: pixels of a cell's side. radius: of the patch about its centre. clip, rounds: upper clipping in spreads. contaminated, contamination: spreads above which a pixel is light, and the share that may be. retained: least share kept. tolerance, reach: spreads above the neighbourhood, and its radius in cells."""

    cell: int = 64
    radius: int = 8
    min_samples: int = 5
    clip: float = 3.0
    rounds: int = 3
    contaminated: float = 3.0
    contamination: float = 0.2
    retained: float = 0.6
    tolerance: float = 3.0
    reach: int = 2
    k_corr: float = 1.4


def _spread(values: Column, about: Column) -> Column:
    return median(F.transform(values, lambda v: F.abs(v - about))) * 1.4826


def upper_clip(values: Column, p: Sampler) -> Column:
    """struct(kept, m, s) of an array: clipped from above only, about the median, until the median stands still, the spread collapses or too few would stay."""
    state = lambda kept, m, s, go: F.struct(kept.alias("kept"), m.alias("m"), s.alias("s"), go.alias("go"))

    def step(a: Column) -> Column:
        def of(left: Column, m: Column) -> Column:
            still = F.abs(m - a["m"]) < F.greatest(F.abs(a["m"]), F.lit(1e-12)) * 1e-12
            spread = let(_spread(left, m), lambda s: state(left, m, F.when(s > 0, s).otherwise(a["s"]), s > 0))
            return F.when(still, state(left, a["m"], a["s"], F.lit(False))).otherwise(spread)

        left = F.filter(a["kept"], lambda v: v <= a["m"] + a["s"] * p.clip)
        few = lambda x: state(a["kept"], a["m"], a["s"], F.lit(False))
        return F.when(~a["go"], a).otherwise(let(left, lambda x: F.when(F.size(x) < p.min_samples, few(x)).otherwise(let(median(x), lambda m: of(x, m)))))

    out = let(median(values), lambda m: let(_spread(values, m), lambda s: state(values, m, s, F.lit(True))))
    for _ in range(p.rounds):
        out = let(out, step)
    return out


def patch_statistics(pixels: DataFrame, p: Sampler = Sampler()) -> DataFrame:
    """(frame, tile, gx, gy, m, mad, bright, n_total, n_retained, support, variance, ivar, reason) of pixels (frame, tile, x, y, signal, support).

    Pixels without a finite signal or positive support don't count. A cell with fewer than min_samples has reason 1 and zeros.
    """
    half = p.cell // 2
    from skyloom.functions.frames import finite

    at = pixels.withColumns({"gx": F.floor(F.col("x") / p.cell), "gy": F.floor(F.col("y") / p.cell)})
    near = (F.abs(F.col("x") - F.col("gx") * p.cell - half) <= p.radius) & (F.abs(F.col("y") - F.col("gy") * p.cell - half) <= p.radius)
    keep = near & finite(F.col("signal")) & finite(F.col("support")) & (F.col("support") > 0)
    cells = at.where(keep).groupBy("frame", "tile", "gx", "gy").agg(F.sort_array(F.collect_list("signal")).alias("values"), F.avg("support").alias("support"))
    enough = F.size("values") >= p.min_samples
    cells = cells.withColumn("n_total", F.size("values")).withColumn("c", F.when(enough, upper_clip(F.col("values"), p)))
    sigma = F.when(F.col("c.s") > 0, F.col("c.s")).otherwise(F.lit(1e-12))
    bright = F.size(F.filter("values", lambda v: v > F.col("c.m") + sigma * p.contaminated)) / F.col("n_total")
    kept = F.size("c.kept")
    variance = F.lit(p.k_corr * math.pi / 2) * sigma * sigma / F.greatest(kept, F.lit(1))
    told = lambda c: F.when(enough, c).otherwise(F.lit(0.0))
    return cells.select(
        "frame", "tile", "gx", "gy", told(F.col("c.m")).alias("m"), told(sigma).alias("mad"), told(bright).alias("bright"), "n_total", F.when(enough, kept).otherwise(0).alias("n_retained"), told(F.col("support")).alias("support"),
        told(variance).alias("variance"), told(1 / variance).alias("ivar"), F.when(enough, CLEAN).otherwise(SUPPORT).alias("reason"))


def gates(cells: DataFrame, p: Sampler = Sampler(), veto: Column | None = None) -> DataFrame:
    """cells with the reason of those that are clean so far: vetoed, brighter than the neighbourhood, contaminated, or too little retained, in this order.

    The neighbourhood is the frame's cells of the tile within `reach`, or all of the tile where these are fewer than
    three; with fewer than three in the tile a cell passes. Its middle is the upper median.
    """
    w = Window.partitionBy("frame", "tile")
    around = cells.withColumn("__all", F.collect_list(F.struct("gx", "gy", "m")).over(w))  # at most the cells of a tile
    near = F.filter("__all", lambda c: (F.abs(c["gx"] - F.col("gx")) <= p.reach) & (F.abs(c["gy"] - F.col("gy")) <= p.reach))
    chosen = let(near, lambda x: F.transform(F.when(F.size(x) < 3, F.col("__all")).otherwise(x), lambda c: c["m"]))
    limit = let(chosen, lambda v: let(upper_median(v), lambda b: F.when(F.size(v) >= 3, b + upper_median(F.transform(v, lambda x: F.abs(x - b))) * 1.4826 * p.tolerance)))
    r = F.when(F.col("__limit").isNull(), CLEAN).when(F.col("m") > F.col("__limit"), BRIGHT).when(F.col("bright") > p.contamination, CONTAMINATED).when(F.col("n_retained") < F.col("n_total") * p.retained, RETAINED).otherwise(CLEAN)
    vetoed = F.lit(False) if veto is None else veto
    out = around.withColumn("__limit", limit).withColumn("reason", F.when(F.col("reason") != CLEAN, F.col("reason")).when(vetoed, VETO).otherwise(r))
    return out.drop("__all", "__limit")


def observations(cells: DataFrame, least: int = 2) -> DataFrame:
    """The clean rows of gated cells that at least `least` frames have clean."""
    clean = cells.where(F.col("reason") == CLEAN)
    return clean.withColumn("__n", F.count("*").over(Window.partitionBy("tile", "gx", "gy"))).where(F.col("__n") >= least).drop("__n")  # frames of a cell
