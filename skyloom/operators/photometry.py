"""Photometric fits of frames and interpolation of curves."""

from __future__ import annotations

from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions.frames import PHOTOMETRY_MAD, finite
from skyloom.operators.robust import medians
from skyloom.session import written

TUKEY = 4.685
REASONS = {"n": 0, "inconsistent": 1, "outliers": 2, "invalid": 3, "unmatched": 5}


def _moved(sums: list[Column], c: Column, gap: Column, rounds: Column, most: int, tolerance: float) -> Column:
    """struct(t, rounds, moving): Tukey's rounds from power sums of u = (value - location) / c over |u| < 1, t being the move in units of c.

    The first round is always right, later ones as long as no value has crossed the limits: while the move is below the gap
    between the limits and the value next to them.
    """

    def about(k: int, t: Column) -> Column:  # the power sum of u - t
        return reduce(lambda out, j: out + sums[j] * F.pow(-t, F.lit(k - j)) * comb(k, j), range(k + 1), F.lit(0.0))

    def step(a: Column, _: Column) -> Column:
        t, run = a["t"], a["going"] & (a["rounds"] < most)
        go = F.try_divide(about(1, t) - about(3, t) * 2 + about(5, t), about(0, t) - about(2, t) * 2 + about(4, t))
        moving = F.coalesce(F.abs(go) * c >= tolerance, F.lit(False))
        to = t + F.coalesce(go, F.lit(0.0))
        return F.when(run, F.struct(to.alias("t"), (a["rounds"] + 1).alias("rounds"), moving.alias("moving"), (moving & (F.abs(to) * c < gap)).alias("going"))).otherwise(a)

    start = F.struct(F.lit(0.0).alias("t"), rounds.alias("rounds"), F.lit(True).alias("moving"), F.lit(True).alias("going"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(most)), start, step)


def tukey_locations(df: DataFrame, by: list[str], value: str, rounds: int = 50, tolerance: float = 1e-10) -> DataFrame:
    """(*by, location, spread, rounds) of each group, however large: the median moved by Tukey's weights at 4.685 spreads, MAD / 0.6745, until it moves by less than the tolerance.

    A pass over the rows sums powers for the groups that still move, with map-side combine, beside the table of locations,
    which is written each time. From the sums follow all rounds in which the same values lie within the limits, so two
    or three passes do for most. A group without spread stays at its median. Null keys and values that aren't finite don't count.
    """
    rows = written(df.select(*by, F.col(value).cast("double").alias("__v")).where(finite(F.col("__v"))))
    v, at, s = F.col("__v"), F.col("location"), F.col("spread")
    start = written(medians(rows, by, "__v", "location"))
    off = medians(rows.join(start, by).withColumn("__d", F.abs(v - at)), by, "__d", "__d")
    state = written(start.join(off, by).select(*by, "location", (F.col("__d") / PHOTOMETRY_MAD).alias("spread"), F.lit(0).alias("rounds"), (F.col("__d") > 0).alias("moving")))
    u = (v - at) / (s * TUKEY)
    for _ in range(rounds):
        live = state.where(F.col("moving") & (F.col("rounds") < rounds))
        if live.isEmpty():
            break
        inside = F.abs(u) < 1
        sums = rows.join(live, by).groupBy(*by).agg(*[F.sum(F.when(inside, F.pow(u, F.lit(k)))).alias(f"__p{k}") for k in range(6)], F.min(F.abs(F.abs(v - at) - s * TUKEY)).alias("__gap"))
        told = state.join(sums, by, "left").withColumn("__m", F.when(F.col("__gap").isNotNull(), _moved([F.col(f"__p{k}") for k in range(6)], s * TUKEY, F.col("__gap"), F.col("rounds"), rounds, tolerance)))
        m = F.col("__m")
        state = written(told.select(*by, (at + F.coalesce(m["t"] * s * TUKEY, F.lit(0.0))).alias("location"), "spread", F.coalesce(m["rounds"], "rounds").alias("rounds"), F.coalesce(m["moving"], F.lit(False)).alias("moving")))
    return state.drop("moving")


def _told(rows: DataFrame, by: list[str], rounds: int, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Fits over rows of reason null by __r, and all rows with their reason."""
    used = F.col("reason").isNull()
    state = tukey_locations(rows.where(used), by, "__r", rounds, tolerance)
    off = F.abs(F.col("__r") - F.col("location"))
    told = rows.join(state, by, "left").withColumn("reason", F.when(~used, F.col("reason")).when((F.col("spread") <= 0) | (off < F.col("spread") * TUKEY), 0).otherwise(2)).withColumn("__off", F.when(F.col("reason") == 0, off))
    counts = told.groupBy(*by).agg(F.max("location").alias("location"), F.max("rounds").alias("rounds"), *[F.count_if(F.col("reason") == k).alias(name) for name, k in REASONS.items()])
    fits = counts.join(medians(told, by, "__off", "__off"), by, "left").withColumns({"location": F.coalesce("location", F.lit(0.0)), "rounds": F.coalesce("rounds", F.lit(0)), "sigma": F.coalesce(F.col("__off") / PHOTOMETRY_MAD, F.lit(0.0))})
    return fits.withColumn("scale", F.pow(F.lit(10.0), -F.col("location"))).drop("__off"), told.drop("location", "spread", "rounds", "__off", "__r")


def zero_points(matches: DataFrame, by: list[str], ratio: str, rounds: int = 50, tolerance: float = 1e-10) -> tuple[DataFrame, DataFrame]:
    """Per group (location, scale = 10**-location, sigma, n), and the matches with reason: 0 in the fit, 2 an outlier, 3 not finite.

    ratio is the logarithm of instrumental over synthetic flux. Groups may be whole frames, see tukey_locations.
    """
    fits, told = _told(matches.withColumn("__r", F.col(ratio)).withColumn("reason", F.when(~finite(F.col(ratio)), 3)), by, rounds, tolerance)
    return fits.select(*by, "location", "sigma", "n", "scale"), told


def calibrated(stars: DataFrame, by: list[str], instrumental: str, synthetic: str, magnitude: str, magnitudes_kept: float = 1.0, rounds: int = 50, tolerance: float = 1e-10) -> tuple[DataFrame, DataFrame]:
    """Per frame (location, scale, sigma, rounds, and the count of each of REASONS), and the detected stars with reason.

    A star without synthetic flux and magnitude has no partner in the catalog (5). A flux that isn't positive and finite,
    a missing magnitude or frame is invalid (3). Of the others, stars whose instrumental less catalog magnitude is more than
    magnitudes_kept from the frame's median are inconsistent (1); the rest gives the location of log10(instrumental /
    synthetic) by tukey_locations (0 in the fit, 2 an outlier). A frame without such stars has scale 1 and n 0.
    """
    f, s = F.col(instrumental).cast("double"), F.col(synthetic).cast("double")
    rows = stars.withColumn("__r", F.when((f > 0) & (s > 0), F.log10(f / s))).withColumn("__d", F.when(f > 0, -2.5 * F.log10(f)) - F.col(magnitude))
    whole = finite(F.col("__r")) & finite(F.col("__d"))
    for k in by:
        whole = whole & F.col(k).isNotNull()
    rows = rows.withColumn("reason", F.when(F.col(synthetic).isNull() & F.col(magnitude).isNull(), 5).when(~whole, 3))
    middle = written(medians(rows.where("reason is null"), by, "__d", "__middle"))
    far = F.abs(F.col("__d") - F.col("__middle")) > magnitudes_kept
    rows = rows.join(middle, by, "left").withColumn("reason", F.when(F.col("reason").isNull() & far, 1).otherwise(F.col("reason"))).drop("__d", "__middle")
    return _told(rows, by, rounds, tolerance)


def akima(x: np.ndarray, y: np.ndarray, at: np.ndarray, fill: float = 0.0) -> np.ndarray:
    """Akima's local cubic through rising x, of one curve or of a matrix with a curve a row; fill outside and for fewer than two points."""
    if len(x) < 2 or (np.diff(x) <= 0).any():
        return np.full((*y.shape[:-1], len(at)), fill)
    m = np.diff(y) / np.diff(x)
    if len(x) > 2:
        first, last = 2 * m[..., :1] - m[..., 1:2], 2 * m[..., -1:] - m[..., -2:-1]
        m = np.concatenate([2 * first - m[..., :1], first, m, last, 2 * last - m[..., -1:]], -1)
    else:
        m = np.repeat(m, 5, -1)
    left, right = np.abs(m[..., 3:] - m[..., 2:-1]), np.abs(m[..., 1:-2] - m[..., :-3])
    total = left + right
    t = np.where(total == 0, (m[..., 1:-2] + m[..., 2:-1]) / 2, (left * m[..., 1:-2] + right * m[..., 2:-1]) / np.where(total == 0, 1, total))
    j = np.clip(np.searchsorted(x, at, "right") - 1, 0, len(x) - 2)
    h, d = x[j + 1] - x[j], at - x[j]
    slope, t0, t1 = (y[..., j + 1] - y[..., j]) / h, t[..., j], t[..., j + 1]
    got = y[..., j] + d * (t0 + d / h * (3 * slope - 2 * t0 - t1 + d / h * (t0 + t1 - 2 * slope)))
    return np.where((at < x[0]) | (at > x[-1]), fill, got)


def interpolated(wl: Column, val: Column, at: list[float], fill: float = 0.0) -> Column:
    """array<double>: curves (arrays wl, val) at the given places."""
    where = np.array(at, float)

    @F.arrow_udf("array<double>")
    def run(x: pa.Array, y: pa.Array) -> pa.Array:
        rows = [akima(np.array(a, float), np.array(b, float), where, fill).tolist() for a, b in zip(x.to_pylist(), y.to_pylist(), strict=True)]
        return pa.array(rows, pa.list_(pa.float64()))

    return run(F.coalesce(wl, F.array().cast("array<double>")), F.coalesce(val, F.array().cast("array<double>")))


def synthetic_flux(spectrum: Column, transmission: Column, efficiency: Column, wavelengths: Column, step: float = 1.0) -> Column:
    """Simpson's integral of spectrum * transmission * efficiency * wavelength over samples `step` apart."""
    from skyloom.functions.frames import simpson

    product = F.zip_with(F.zip_with(spectrum, transmission, lambda a, b: a * b), F.zip_with(efficiency, wavelengths, lambda a, b: a * b), lambda a, b: a * b)
    return simpson(product, step)


Curve = tuple[list[float], list[float]]


def _prepared(wl: np.ndarray) -> np.ndarray:
    """Places that put wavelengths in rising order, of equal ones the first; those that aren't finite are left out."""
    order = np.argsort(wl, kind="stable")
    order = order[np.isfinite(wl[order])]
    return order[np.concatenate([[True], np.diff(wl[order]) > 0])] if len(order) else order


def _simpson_weights(n: int) -> np.ndarray:
    """Of n samples one apart: Simpson's rule, the last three of an odd number of intervals by the 3/8 rule, a single one by the trapezoid."""
    w, even = np.zeros(n), n if n % 2 else n - 3
    if n == 2:
        return np.full(2, 0.5)
    if even > 1:
        w[:even] = np.where(np.arange(even) % 2 == 1, 4, 2) / 3
        w[[0, even - 1]] = 1 / 3
    if n % 2 == 0:
        w[-4:] += np.array([3, 9, 9, 3]) / 8
    return w


def catalog_flux(spectrum: Column, magnitude: Column, wavelengths: list[float], transmission: Curve, efficiency: Curve | None = None, rows: int = 512) -> Column:
    """Synthetic flux of catalog spectra, bytes at common wavelengths in nm, through a filter and a detector's efficiency.

    A spectrum times 10**(-0.4 magnitude), the transmission and the efficiency (1 where it is None or has a single point) are interpolated at
    steps of 1 nm over the range common to all, 0 beyond; Simpson's integral of their product with the wavelength is the flux. 0 where
    there is no common range or the spectrum's length is another; null for a null spectrum or magnitude or a null in one.
    """
    wl = np.array(wavelengths, float)
    keep = _prepared(wl)
    curves = []
    for c in (transmission, efficiency):
        if c is not None:
            k = _prepared(np.array(c[0], float))
            curves.append((np.array(c[0], float)[k], np.array(c[1], float)[k]))
    curves = curves[:1] + [c for c in curves[1:] if len(c[0]) > 1]
    known = len(keep) > 1 and len(curves[0][0]) > 1
    low = max(c[0] for c in [wl[keep], *[c[0] for c in curves]]) if known else 0.0
    high = min(c[-1] for c in [wl[keep], *[c[0] for c in curves]]) if known else 0.0
    n = int(np.floor(high - low + 0.5)) + 1 if high > low else 0
    grid = low + np.arange(n)
    weight = grid * _simpson_weights(n) if n > 1 else np.zeros(n)
    for c in curves if n > 1 else []:
        weight = weight * akima(*c, grid)

    @F.arrow_udf("double")
    def run(s: pa.Array, mag: pa.Array) -> pa.Array:
        out, lengths = np.zeros(len(s)), np.diff(s.offsets.to_numpy())
        scale = np.power(10.0, -0.4 * mag.to_numpy(zero_copy_only=False))
        values, start = s.values.to_numpy(zero_copy_only=False).astype(float), s.offsets.to_numpy()[:-1]
        usable = np.flatnonzero(lengths == len(wl))
        for i in range(0, len(usable), rows):
            at = usable[i : i + rows]
            y = values[start[at][:, None] + keep] * scale[at][:, None]
            out[at] = np.where(np.isnan(y).any(1), np.nan, akima(wl[keep], y, grid) @ weight)
        return pa.array(out, mask=np.isnan(out))

    bytes_ = spectrum.cast("array<int>")
    return F.when(spectrum.isNotNull() & magnitude.isNotNull(), run(F.coalesce(bytes_, F.array().cast("array<int>")), F.coalesce(magnitude.cast("double"), F.lit(0.0))))
