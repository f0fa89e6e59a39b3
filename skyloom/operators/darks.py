"""How far a dark frame is to be scaled: a strided sample of the background and a robust slope, with the exposures' ratio where that fails."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyloom.functions.frames import finite
from skyloom.operators.robust import medians
from skyloom.session import written

GRID, PER_CELL, TOTAL = 8, 1000, 50_000
LEAST, KEPT, ROUNDS, MOST_K = 100, 50, 5, 10.0  # samples, samples kept, rounds, scale
SPREAD = 3 * 1.4826


def background(pixels: DataFrame, by: str = "frame", light: str = "light") -> DataFrame:
    """Pixels within 3 * 1.4826 MAD of their frame's median; all of a frame without spread. Pixels that aren't finite are left out.

    Frames are aggregated, never held in one task.
    """
    rows = pixels.where(finite(F.col(light).cast("double")) & F.col(by).isNotNull())
    middle = written(medians(rows.select(by, light), [by], light, "__m"))
    off = rows.join(middle, by).withColumn("__o", F.abs(F.col(light) - F.col("__m")))
    spread = written(medians(off.select(by, "__o"), [by], "__o", "__d"))
    return off.join(spread, by).where((F.col("__d") <= 0) | (F.col("__o") <= F.col("__d") * SPREAD)).drop("__m", "__o", "__d")


def strided(pixels: DataFrame, frames: DataFrame, by: str = "frame", per_cell: int = PER_CELL, total: int = TOTAL) -> DataFrame:
    """Every k-th pixel of each of a frame's 8 by 8 cells, at most per_cell of one; cells, in order, are taken until total is reached.

    frames has width and height. A window is a cell, a 64th of a frame, ordered by y and x; places are taken to be unique.
    """
    cell = lambda at, n: F.least(F.lit(GRID - 1), F.floor(F.col(at) / F.greatest(F.lit(1), F.floor(F.col(n) / GRID))))
    at = pixels.join(frames.select(by, "width", "height"), by).withColumn("__c", cell("y", "height") * GRID + cell("x", "width")).drop("width", "height")
    taken = F.least(F.lit(per_cell), F.ceil(F.col("__n") / F.greatest(F.lit(1), F.floor(F.col("__n") / per_cell))))
    cells = at.groupBy(by, "__c").agg(F.count("*").alias("__n")).withColumn("__k", taken)
    before = F.coalesce(F.sum("__k").over(Window.partitionBy(by).orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # 64 cells a frame
    cells = written(cells.withColumn("__b", before).where(F.col("__b") < total).select(by, "__c", F.greatest(F.lit(1), F.floor(F.col("__n") / per_cell)).alias("__s")))
    ranked = at.join(cells, [by, "__c"]).withColumn("__r", F.row_number().over(Window.partitionBy(by, "__c").orderBy("y", "x")) - 1)
    return ranked.where((F.col("__r") % F.col("__s") == 0) & (F.col("__r") < F.col("__s") * per_cell)).drop("__c", "__s", "__r")


def _spread(v: np.ndarray) -> tuple[float, float]:
    m = float(np.median(v))
    return m, 1.4826 * float(np.median(np.abs(v - m)))


def slope(x: np.ndarray, y: np.ndarray) -> tuple[float | None, str]:
    """The slope of y over x after at most five rounds of clipping at three spreads, or None and why."""
    if len(x) < LEAST:
        return None, "INSUFFICIENT_SAMPLES"
    for _ in range(ROUNDS):
        if len(x) < KEPT:
            return None, "TOO_FEW_INLIERS"
        dx = x - x.mean()
        if (dx * dx).sum() <= 1e-12:
            return None, "ZERO_VARIANCE"
        k = (dx * (y - y.mean())).sum() / (dx * dx).sum()
        c = y.mean() - k * x.mean()
        rest = y - c - k * x
        m, s = _spread(rest)
        if s <= 0:
            break
        keep = np.abs(rest - m) <= 3 * s
        if keep.sum() < KEPT:
            return None, "TOO_FEW_INLIERS"
        x, y = x[keep], y[keep]
        if keep.all():
            break
    wide, left = _spread(y)[1], _spread(y - c - k * x)[1]
    if not np.isfinite(wide) or not np.isfinite(left):
        return None, "RESIDUAL_NAN"
    if wide > 0 and left >= wide:
        return None, "RESIDUAL_ABNORMAL"
    return (float(k), "OK") if 0 < k <= MOST_K else (None, "K_OUT_OF_RANGE")


def dark_scales(pixels: DataFrame, frames: DataFrame, by: str = "frame") -> DataFrame:
    """(by, k, fell_back, code, samples) of each frame: the slope of light over dark, both less bias, over strided(background).

    pixels has x, y, light, dark, bias; frames width, height and ratio, the exposures' ratio, which stands for k where the
    fit fails, for the reason `code`; a ratio that isn't positive and finite is BAD_RATIO and stays as it is. A group that
    reaches Python is a frame's sample, at most 51,000 values.
    """
    known = written(frames.select(by, "width", "height", F.col("ratio").cast("double").alias("ratio")).where(F.col(by).isNotNull()))
    double = lambda a, b: F.col(a).cast("double") - F.col(b).cast("double")
    s = strided(background(pixels.where(finite(double("dark", "bias")) & finite(double("light", "bias"))), by), known, by).select(by, double("dark", "bias").alias("x"), double("light", "bias").alias("y"))

    def fit(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["x", "y"])  # sums don't depend on how rows arrived
        k, code = slope(group.x.to_numpy(), group.y.to_numpy())
        return pd.DataFrame({by: [key[0]], "k": [k], "code": [code], "samples": [len(group)]}).astype({"k": "float64"})

    of = s.schema[by].dataType.simpleString()
    fits = s.groupBy(by).applyInPandas(fit, f"`{by}` {of}, k double, code string, samples long")
    code = F.when(~finite(F.col("ratio")) | (F.col("ratio") <= 0), "BAD_RATIO").otherwise(F.coalesce("code", F.lit("INSUFFICIENT_SAMPLES")))
    out = known.join(fits, by, "left").withColumn("code", code)
    ok = F.col("code") == "OK"
    return out.select(by, F.when(ok, F.col("k")).otherwise(F.col("ratio")).alias("k"), (~ok).alias("fell_back"), "code", F.coalesce("samples", F.lit(0)).alias("samples"))
