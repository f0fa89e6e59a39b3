"""Overlap of convex drops with the cells of a grid: the join behind drizzling."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CORNERS = [f"{c}{i}" for i in range(4) for c in "uv"]


def _clip(x: np.ndarray, y: np.ndarray, n: np.ndarray, axis: np.ndarray, bound: np.ndarray, sign: int):
    """One half-plane for all polygons at once: keep where sign * (axis - bound) >= 0. Polygons are rows, of n corners each."""
    size = x.shape[1]
    rows, at = np.arange(len(n))[:, None], np.arange(size)[None, :]
    real = at < n[:, None]
    after = np.where(at + 1 < n[:, None], at + 1, 0)
    d = sign * (axis - bound[:, None])
    d2, x2, y2 = d[rows, after], x[rows, after], y[rows, after]
    keep, cross = real & (d >= 0), real & ((d >= 0) != (d2 >= 0))
    t = np.where(cross, d / np.where(cross, d - d2, 1.0), 0.0)
    # each corner gives itself if inside, then the crossing of its edge
    count = keep.astype(int) + cross
    place = np.cumsum(count, axis=1) - count
    ox, oy = np.zeros((len(n), size + 1)), np.zeros((len(n), size + 1))
    r = np.broadcast_to(rows, real.shape)
    ox[r[keep], place[keep]], oy[r[keep], place[keep]] = x[keep], y[keep]
    p = place + keep
    ox[r[cross], p[cross]], oy[r[cross], p[cross]] = (x + t * (x2 - x))[cross], (y + t * (y2 - y))[cross]
    return ox, oy, count.sum(axis=1)


def cell_overlap(x: np.ndarray, y: np.ndarray, gx: np.ndarray, gy: np.ndarray) -> np.ndarray:
    """Area that convex polygons (rows of corners, in order) share with the unit cells (gx, gy)."""
    n = np.full(len(x), x.shape[1])
    for along_x, bound, sign in ((True, gx, 1), (True, gx + 1, -1), (False, gy, 1), (False, gy + 1, -1)):
        x, y, n = _clip(x, y, n, x if along_x else y, bound.astype(float), sign)
    at = np.arange(x.shape[1])[None, :]
    real, after = at < n[:, None], np.where(at + 1 < n[:, None], at + 1, 0)
    rows = np.arange(len(n))[:, None]
    return np.abs(np.where(real, x * y[rows, after] - x[rows, after] * y, 0.0).sum(axis=1)) / 2


def with_overlaps(drops: DataFrame, least: float = 1e-20) -> DataFrame:
    """drops with gx, gy and weight, a row for each cell that a drop covers: weight is the shared part of the drop's area.

    A drop has corners u0, v0 … u3, v3 in cell units, in order, and is convex. Candidates are the cells of its bounding
    box; shares and drops of `least` area or less are left out.
    """
    low, high = (lambda c: F.floor(F.least(*[F.col(f"{c}{i}") for i in range(4)]))), (lambda c: F.floor(F.greatest(*[F.col(f"{c}{i}") for i in range(4)])))
    met = drops.withColumn("gx", F.explode(F.sequence(low("u"), high("u")))).withColumn("gy", F.explode(F.sequence(low("v"), high("v"))))

    @F.arrow_udf("double")
    def share(u0: pa.Array, v0: pa.Array, u1: pa.Array, v1: pa.Array, u2: pa.Array, v2: pa.Array, u3: pa.Array, v3: pa.Array, gx: pa.Array, gy: pa.Array) -> pa.Array:
        c = [np.asarray(a, dtype=float) for a in (u0, v0, u1, v1, u2, v2, u3, v3)]
        return pa.array(cell_overlap(np.stack(c[0::2], axis=1), np.stack(c[1::2], axis=1), np.asarray(gx), np.asarray(gy)))

    u, v = [F.col(f"u{i}") for i in range(4)], [F.col(f"v{i}") for i in range(4)]
    area = F.abs(sum((u[i] * v[(i + 1) % 4] - u[(i + 1) % 4] * v[i] for i in range(4)), F.lit(0.0))) / 2
    out = met.withColumn("__shared", share(*[F.col(c) for c in CORNERS], "gx", "gy")).withColumn("__area", area)
    return out.where((F.col("__area") > least) & (F.col("__shared") > least)).withColumn("weight", F.col("__shared") / F.col("__area")).drop("__shared", "__area")


def drizzled(overlaps: DataFrame, by: list[str], value: str, variance: str, area: Column) -> DataFrame:
    """(*by, flux, area, var_num, n): sums of value, area and variance over drops, by weight; a variance that isn't positive doesn't count."""
    w = F.col("weight")
    return overlaps.groupBy(*by).agg(F.sum(F.col(value) * w).alias("flux"), F.sum(area * w).alias("area"), F.sum(F.when(F.col(variance) > 0, F.col(variance) * w * w).otherwise(0.0)).alias("var_num"), F.count("*").alias("n"))
