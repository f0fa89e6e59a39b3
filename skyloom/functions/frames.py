"""Scalar expressions on frames, stars and controls. Column in, column out; nulls give null unless said otherwise."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

TRIMMED_TO_SIGMA = 0.73167
MAD_TO_SIGMA = 1.4826
NOISE_MAD_TO_SIGMA = 1.482602218505602
PHOTOMETRY_MAD = 0.6745

# Names of filters in headers, and the curves that they stand for.
FILTER_NAMES = {
    "red": "Baader R",
    "r": "Baader R",
    "green": "Baader G",
    "g": "Baader G",
    "blue": "Baader B",
    "b": "Baader B",
    "lum": "Baader UV/IR Cut / L CMOS Optimized",
    "l": "Baader UV/IR Cut / L CMOS Optimized",
    "luminance": "Baader UV/IR Cut / L CMOS Optimized",
    "h-alpha": "Baader 7nm H-alpha",
    "ha": "Baader 7nm H-alpha",
    "oiii": "Baader 8.5nm OIII",
}
# Median correction by source pixel scale (300, 600 arcsec) and drop size (0.5, middle, 1.0).
MEDIAN_CORRECTION = {300.0: (1.2112, 1.3925, 1.4980), 600.0: (2.3958, 2.8971, 3.2035)}
# Midtones and compression of the display presets.
DISPLAY_PRESETS = {"linear": (0.5, 0.0), "sqrt": (0.25, 0.0), "asinh": (0.25, 0.5), "log": (0.15, 0.8)}


def finite(x: Column) -> Column:
    """True for numbers that are neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(math.inf)), F.lit(False))


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def calibrate(light: Column, dark: Column, flat: Column, bias: Column | None = None, k: Column | float = 1.0) -> Column:
    """(L - B - k (D - B)) / max(F, 0.1); without bias (L - D) / max(F, 0.1)."""
    signal = light - dark if bias is None else light - bias - (k if isinstance(k, Column) else F.lit(k)) * (dark - bias)
    return signal / F.greatest(flat, F.lit(0.1))


def scale_law(variance: Column, ivar: Column, alpha: Column) -> tuple[Column, Column]:
    a2 = alpha * alpha
    return variance * a2, F.when((a2 > 0) & finite(ivar), ivar / a2).otherwise(ivar)


def gain_variance(signal: Column, gain: Column, read_noise: Column) -> Column:
    """Diagnostic shot and read noise; 0 without a positive gain."""
    return F.when(gain <= 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), signal) / gain + read_noise * read_noise / (gain * gain))


def photometric_quality(sigma_dex: Column, matches: Column) -> Column:
    """struct(sigma_mag, sigma_rel, fit_status)."""
    bad = ~finite(sigma_dex) | (sigma_dex <= 0)
    return F.struct(
        F.when(bad, F.lit(0.0)).otherwise(F.lit(2.5) * sigma_dex).alias("sigma_mag"),
        F.when(bad, F.lit(0.0)).otherwise(F.lit(math.log(10)) * sigma_dex).alias("sigma_rel"),
        F.when(bad, 2).when(matches > 0, 0).otherwise(1).alias("fit_status"),
    )


def psf_quality(status: Column, flags: Column, amplitude: Column, residual: Column) -> Column:
    """struct(fit_status, sigma, q): status 1 the fit failed, 2 saturated, 3 no usable numbers, else 0."""
    usable = finite(residual) & (residual > 0)
    state = F.when(status != 0, 1).when(flags.bitwiseAND(F.lit(2 | 4)) != 0, 2).when(~finite(amplitude) | ~usable, 3).otherwise(0)
    return F.struct(state.alias("fit_status"), F.when(usable, residual / F.lit(TRIMMED_TO_SIGMA)).otherwise(0.0).alias("sigma"), F.when(usable, amplitude / residual).otherwise(0.0).alias("q"))


def quality_factor(flags: Column) -> Column:
    """0 rejected by photometry, 0.1 saturated, 1 a good fit, else 0.5."""
    bit = lambda b: flags.bitwiseAND(F.lit(b)) != 0
    return F.when(bit(16), 0.0).when(bit(2), 0.1).when(bit(1), 1.0).otherwise(0.5)


def control_weight(flags: Column, control_ivar: Column) -> Column:
    """quality_factor * control_ivar. A control's inverse variance that is missing, not finite or not positive is an error: a silent weight would change what the model means."""
    missing = F.raise_error(F.lit("a control has no inverse variance")).cast("double")
    return F.when(F.coalesce(finite(control_ivar) & (control_ivar > 0), F.lit(False)), quality_factor(flags) * control_ivar).otherwise(missing)


def legacy_weight(flags: Column, support: Column, snr: Column, uncertainty: Column, power: float = 1.0, floor: float = 1e-3) -> Column:
    s2, u = snr * snr, F.greatest(F.abs(uncertainty), F.lit(floor))
    return quality_factor(flags) * F.pow(clamp(support, 0.0, 1.0), F.lit(power)) * (s2 / (F.lit(1.0) + s2)) / (u * u)


def huber_rho(r: Column, delta: float = 1.345) -> Column:
    a = F.abs(r)
    return F.when(a <= delta, F.lit(0.5) * r * r).otherwise(F.lit(delta) * (a - F.lit(0.5 * delta)))


def huber_weight(r: Column, delta: float = 1.345) -> Column:
    a = F.abs(r)
    return F.when(a <= delta, F.lit(1.0)).otherwise(F.lit(delta) / a)


def tukey_weight(u: Column) -> Column:
    t = F.lit(1.0) - u * u
    return F.when(F.abs(u) >= 1, F.lit(0.0)).otherwise(t * t)


def median_correction(drop: Column, scale: Column) -> Column:
    """The tabulated factor, linear in scale and over equal steps of drop; both are clamped to the table."""
    at = (clamp(drop, 0.5, 1.0) - 0.5) / 0.5 * 2
    low = F.least(F.floor(at), F.lit(2))
    high = F.least(F.floor(at) + 1, F.lit(2))
    part = at - low
    row = lambda v: F.element_at(F.array(*[F.lit(x) for x in v]), (low + 1).cast("int")) * (1 - part) + F.element_at(F.array(*[F.lit(x) for x in v]), (high + 1).cast("int")) * part
    (s0, r0), (s1, r1) = sorted(MEDIAN_CORRECTION.items())
    share = (clamp(scale, s0, s1) - s0) / (s1 - s0)
    return row(r0) * (1 - share) + row(r1) * share


def control_variance(sigma: Column, n: Column, k: Column | float = 1.0) -> Column:
    """k * pi/2 * sigma^2 / n: the variance of a median of n samples; null without samples."""
    return F.when(n > 0, (k if isinstance(k, Column) else F.lit(k)) * F.lit(math.pi / 2) * sigma * sigma / n)


def midtones(x: Column, m: Column) -> Column:
    """Midtones transfer, clamped to 0..1; m = 0.5 leaves x."""
    d = (2 * m - 1) * x - m
    d = F.when(F.abs(d) < 1e-30, F.lit(1e-30)).otherwise(d)
    return F.when(F.abs(m - 0.5) < 1e-10, x).otherwise(clamp((m - 1) * x / d, 0.0, 1.0))


def tone(x: Column, preset: str, m: Column, c: float) -> Column:
    """A display preset's curve, then the midtones transfer."""
    if preset == "sqrt":
        y = F.sqrt(x)
    elif preset == "log":
        y = F.log1p(F.lit(c) * x) / F.lit(math.log1p(c))
    elif preset == "asinh" and c > 1e-6:
        y = F.asinh(F.lit(c) * x) / F.lit(math.asinh(c))
    else:
        y = x
    return midtones(y, m)


def display_state(black: Column, white: Column, mid: Column, compression: Column) -> Column:
    """struct of the four, brought into their ranges; white at least 0.05 above black where they cross."""
    b, w = clamp(black, 0.0, 0.999), clamp(white, 0.001, 1.0)
    return F.struct(b.alias("black"), F.when(w <= b, F.least(F.lit(1.0), b + 0.05)).otherwise(w).alias("white"), clamp(mid, 0.001, 0.999).alias("midtones"), clamp(compression, 0.0, 1.0).alias("compression"))


def level_of_detail(fov: Column, leaf: int) -> Column:
    """The tile order for a field of view in degrees, half orders away from zero."""
    o = F.lit(7.0) - F.log2(F.greatest(fov, F.lit(0.1)) / 1.84)
    return F.greatest(F.lit(0), F.least(F.lit(leaf), F.round(o).cast("int")))


def target_nside(fov: Column, viewport: Column, least: int, most: int) -> Column:
    """The smallest least * 2**k with pixels no larger than the screen's, at most `most`."""
    f = F.when(fov < 0.01, 60.0).otherwise(F.least(fov, F.lit(170.0)))
    v = F.when(viewport <= 0, 768).otherwise(viewport)
    ideal = F.ceil(F.lit(58.6) / (f / v))
    steps = [least << k for k in range(64) if least << k <= most]
    out = F.lit(steps[-1])
    for s in reversed(steps[:-1]):
        out = F.when(ideal <= s, F.lit(s)).otherwise(out)
    return out


def iso_mjd(text: Column) -> Column:
    """Modified Julian date of an ISO time in UTC; null where it is none."""
    return F.unix_micros(F.try_to_timestamp(text)) / F.lit(86_400_000_000.0) + 40587


def sexagesimal(text: Column, hours: bool) -> Column:
    """Degrees of "d m s" or "d:m:s", or of a plain number; a leading sign counts for all parts. Null for null, 0 for what is no number."""
    body = F.regexp_replace(F.regexp_replace(F.trim(text), "^[+-]", ""), ":", " ")
    parts = F.split(F.trim(body), " +")
    n = [F.try_element_at(parts, F.lit(i)).try_cast("double") for i in (1, 2, 3)]
    sign = F.when(F.trim(text).startswith("-"), F.lit(-1.0)).otherwise(1.0)
    three = (n[0] + n[1] / 60 + n[2] / 3600) * (15.0 if hours else 1.0)
    return F.when(text.isNull(), None).otherwise(sign * F.coalesce(three, n[0], F.lit(0.0)))


def filter_curve(name: Column) -> Column:
    """The curve that a header's filter name stands for, or the name itself."""
    known = F.create_map(*[F.lit(x) for kv in FILTER_NAMES.items() for x in kv])
    return F.coalesce(F.try_element_at(known, F.lower(name)), name)


def file_kind(name: Column) -> Column:
    return F.when(name.endswith("_od.fits.fz"), "od").when(name.endswith(".wht.fits.fz"), "weight").when(name.endswith(".fits.fz"), "science").otherwise("other")


def file_identity(name: Column) -> Column:
    """struct(pointing, ccd): the number after the last underscore of the stem is the detector; null without one."""
    stem = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, r"\.fits\.fz$", ""), "_od$", ""), r"\.wht$", "")
    numbered = stem.rlike(r"^.*_\d+$")
    return F.struct(F.when(numbered, F.regexp_extract(stem, r"^(.*)_(\d+)$", 1)).otherwise(stem).alias("pointing"), F.when(numbered, F.regexp_extract(stem, r"^(.*)_(\d+)$", 2)).alias("ccd"))


def simpson(y: Column, step: float) -> Column:
    """Simpson's rule over equally spaced samples; with an odd number of intervals the last three by the 3/8 rule, a single one by the trapezoid. Fewer than two samples give 0."""
    n = F.size(y)
    odd = (n - 1) % 2 == 1
    even_end = F.when(odd, n - 3).otherwise(n)
    body = F.aggregate(F.sequence(F.lit(0), F.greatest(even_end - 1, F.lit(0))), F.lit(0.0), lambda a, i: a + F.get(y, i) * F.when((i == 0) | (i == even_end - 1), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)) * F.lit(step / 3)
    at = lambda k: F.get(y, n - k)
    tail = (at(4) + 3 * at(3) + 3 * at(2) + at(1)) * F.lit(3 * step / 8)
    return F.when(n < 2, 0.0).when(n == 2, (at(2) + at(1)) * F.lit(step / 2)).when(n == 4, tail).when(odd, body + tail).otherwise(body)


def prepared_curve(points: Column) -> Column:
    """points: array<struct<wl, val>>, by ascending wl without those that don't rise above their predecessor; of equal ones the first stays."""
    indexed = F.transform(points, lambda p, i: F.struct(p["wl"].alias("wl"), i.alias("i"), p["val"].alias("val")))
    ordered = F.sort_array(F.filter(indexed, lambda p: p["wl"].isNotNull()))
    # bound as the one element of an array, the sorted points are worked out once and not for each point again
    kept = F.transform(F.array(ordered), lambda o: F.filter(o, lambda p, i: (i == 0) | (F.get(o, F.greatest(i - 1, F.lit(0)))["wl"] < p["wl"])))[0]
    return F.transform(kept, lambda p: F.struct(p["wl"].alias("wl"), p["val"].alias("val")))


def tangent_forward(ra: Column, dec: Column, ra0: Column, dec0: Column) -> tuple[Column, Column, Column]:
    """Gnomonic (xi, eta) in degrees and the cosine of the distance; where that isn't positive the point is behind the plane and both are null."""
    a, d, d0 = F.radians(ra - ra0), F.radians(dec), F.radians(dec0)
    c = F.sin(d0) * F.sin(d) + F.cos(d0) * F.cos(d) * F.cos(a)
    xi, eta = F.cos(d) * F.sin(a) / c, (F.cos(d0) * F.sin(d) - F.sin(d0) * F.cos(d) * F.cos(a)) / c
    return F.when(c > 0, F.degrees(xi)), F.when(c > 0, F.degrees(eta)), c


def tangent_inverse(xi: Column, eta: Column, ra0: Column, dec0: Column) -> tuple[Column, Column]:
    x, y, d0 = F.radians(xi), F.radians(eta), F.radians(dec0)
    den = F.cos(d0) - y * F.sin(d0)
    ra = F.pmod(ra0 + F.degrees(F.atan2(x, den)), F.lit(360.0))
    return ra, F.degrees(F.atan2(F.sin(d0) + y * F.cos(d0), F.sqrt(x * x + den * den)))


def polynomial(dx: Column, dy: Column, coefficients: dict[tuple[int, int], float]) -> Column:
    """sum of a_ij dx^i dy^j, nested in dy."""
    by_x: dict[int, dict[int, float]] = {}
    for (i, j), a in coefficients.items():
        by_x.setdefault(i, {})[j] = a

    def nested(x: Column, terms: dict[int, Column]) -> Column:
        out = F.lit(0.0)
        for k in range(max(terms), -1, -1):
            out = out * x + terms.get(k, F.lit(0.0))
        return out

    return nested(dx, {i: nested(dy, {j: F.lit(a) for j, a in row.items()}) for i, row in by_x.items()}) if by_x else F.lit(0.0)


def polygon_area(points: Column) -> Column:
    """Shoelace area of array<struct<x, y>>; fewer than three points have none."""
    n = F.size(points)
    cross = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0.0), lambda a, i: a + F.get(points, i)["x"] * F.get(points, (i + 1) % n)["y"] - F.get(points, (i + 1) % n)["x"] * F.get(points, i)["y"])
    return F.when(n < 3, 0.0).otherwise(F.abs(cross) / 2)


def direction(ra: Column, dec: Column) -> Column:
    """Unit vector struct(x, y, z)."""
    a, d = F.radians(ra), F.radians(dec)
    return F.struct((F.cos(d) * F.cos(a)).alias("x"), (F.cos(d) * F.sin(a)).alias("y"), F.sin(d).alias("z"))


def slerp(a: Column, b: Column, t: Column) -> Column:
    """The unit vector at share t of the arc from a to b; a where the two are equal."""
    dot = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), a["x"] * b["x"] + a["y"] * b["y"] + a["z"] * b["z"]))
    w = F.acos(dot)
    s = F.sin(w)
    p, q = F.sin((1 - t) * w) / s, F.sin(t * w) / s
    return F.when(F.abs(s) < 1e-12, a).otherwise(F.struct(*[(a[c] * p + b[c] * q).alias(c) for c in "xyz"]))
