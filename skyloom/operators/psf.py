"""Moffat profiles of exponent 4 fitted to images of stars, all images of a batch at once.

model = B + A / (1 + Q)**4 with Q the quadratic form of an ellipse of half-widths sx, sy turned by theta. Levenberg-Marquardt
steps run on stacks of normal equations; an image whose fit has ended leaves the stack.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

FIT = "struct<status:int,background:double,amplitude:double,cx:double,cy:double,sx:double,sy:double,theta:double,fwhm_x:double,fwhm_y:double,flux:double,eccentricity:double,residual:double,iterations:int>"
# How a fit ended.
DONE, LIMIT, NO_CONVERGENCE, INVALID = 0, 3, 1, 2
FWHM = 2 * np.sqrt(2) * np.sqrt(2**0.25 - 1)  # full width at half maximum of a profile of half-width 1


def _parts(q: np.ndarray, dx: np.ndarray, dy: np.ndarray):
    """Of parameters (fit, 7) and places (pixel,): the turned places, their squares over 2 s**2, and 1 + Q."""
    u, v = dx[None, :] - q[:, 2:3], dy[None, :] - q[:, 3:4]
    c, s = np.cos(q[:, 6:7]), np.sin(q[:, 6:7])
    a, b = c * u + s * v, c * v - s * u
    fa, fb = a * a / (2 * q[:, 4:5] ** 2), b * b / (2 * q[:, 5:6] ** 2)
    return a, b, c, s, fa, fb, 1 + fa + fb


def model(q: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    return q[:, :1] + q[:, 1:2] / (_parts(q, dx, dy)[-1] ** 2) ** 2  # squares: powers take several times longer


def _slopes(q: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """Derivatives of the model by its parameters: (fit, 7, pixel)."""
    a, b, c, s, fa, fb, one = _parts(q, dx, dy)
    peak = 1 / (one**2) ** 2
    fall = -4 * q[:, 1:2] * peak / one  # by Q
    qa, qb = a / q[:, 4:5] ** 2, b / q[:, 5:6] ** 2
    return np.stack([np.ones_like(peak), peak, fall * (-qa * c + qb * s), fall * (-qa * s - qb * c), fall * (-2 * fa / q[:, 4:5]), fall * (-2 * fb / q[:, 5:6]), fall * (qa * b - qb * a)], axis=1)


def _masked_median(v: np.ndarray, mask: np.ndarray) -> np.ndarray:
    s = np.sort(np.where(mask, v, np.inf), axis=1)
    n = mask.sum(axis=1)
    row = np.arange(len(v))
    return (s[row, np.maximum(n - 1, 0) // 2] + s[row, np.minimum(n // 2, v.shape[1] - 1)]) / 2


def background(v: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The median of the lower half of an image's pixels, without those two robust deviations off."""
    mid = _masked_median(v, there)
    low = there & (v < mid[:, None])
    some = low.any(axis=1)
    low = np.where(some[:, None], low, there & (v == mid[:, None]))
    low_mid = np.where(some, _masked_median(v, low), mid)
    off = np.abs(v - low_mid[:, None])
    near = low & (off <= 2 * 1.4826 * _masked_median(off, low)[:, None])
    return np.where(near.any(axis=1), _masked_median(v, near), low_mid)


def trimmed(off: np.ndarray, there: np.ndarray) -> np.ndarray:
    """The mean of absolute deviations between their 10th and 90th percentile."""
    n = there.sum(axis=1)
    s = np.sort(np.where(there, np.abs(off), np.inf), axis=1)
    at = np.arange(s.shape[1])
    low, high = (n * 0.1).astype(int), (n * 0.9).astype(int)
    kept = (at >= low[:, None]) & (at < high[:, None])
    mean = np.where(kept, s, 0.0).sum(axis=1) / np.maximum(high - low, 1)
    return np.where(high > low, mean, s[np.arange(len(s)), np.minimum(n // 2, s.shape[1] - 1)])


def _descend(q: np.ndarray, v: np.ndarray, there: np.ndarray, dx: np.ndarray, dy: np.ndarray, tolerance: float, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Levenberg-Marquardt from q: parameters, status, steps."""
    q, status, steps = q.copy(), np.full(len(q), LIMIT), np.zeros(len(q), int)
    rows, damp = np.arange(len(q)), np.full(len(q), 1e-3)
    rest = lambda p, r: np.where(there[r], v[r] - model(p, dx, dy), 0.0)
    e = rest(q, rows)
    cost = (e * e).sum(axis=1)
    for _ in range(most):
        if not len(rows):
            break
        p = q[rows]
        j = np.where(there[rows][:, None, :], _slopes(p, dx, dy), 0.0)
        normal = j @ j.transpose(0, 2, 1) + damp[rows][:, None, None] * np.eye(7)
        with np.errstate(all="ignore"):
            good = np.isfinite(normal).all(axis=(1, 2))
            step = np.linalg.solve(np.where(good[:, None, None], normal, np.eye(7)), np.where(good[:, None, None], j @ e[:, :, None], 0.0))[:, :, 0]
            small = good & (np.linalg.norm(step, axis=1) < tolerance * (np.linalg.norm(p, axis=1) + 1e-30))
            new = p + step
            fit = np.isfinite(new).all(axis=1) & (new[:, 4] > 0) & (new[:, 5] > 0) & good
            e2 = rest(np.where(fit[:, None], new, p), rows)
        cost2 = np.where(fit, (e2 * e2).sum(axis=1), np.inf)
        better = (cost2 < cost[rows]) & ~small
        new[:, 4:6] = np.maximum(new[:, 4:6], 0.3)
        new[:, 1] = np.maximum(new[:, 1], 0.0)
        q[rows[better]], cost[rows[better]] = new[better], cost2[better]
        e = np.where(better[:, None], e2, e)
        damp[rows] *= np.where(better, 0.1, 10.0)
        steps[rows] += 1
        status[rows[small]] = DONE
        going = ~small & (damp[rows] < 1e30)
        rows, e = rows[going], e[going]
    return q, status, steps


def fits(images: np.ndarray, width: int, tolerance: float = 1e-8, most: int = 200) -> dict[str, np.ndarray]:
    """Fits of images (image, pixel), each by rows of `width`; missing pixels are NaN. cx, cy are offsets from the middle pixel.

    status: DONE; LIMIT where steps ran out; INVALID for fewer than 9 pixels or no light above the background;
    NO_CONVERGENCE where a parameter isn't finite, a width is at its floor or beyond the image, or the background is off by half.
    """
    height = images.shape[1] // width
    dx, dy = np.tile(np.arange(width) - width // 2, height).astype(float), np.repeat(np.arange(height) - height // 2, width).astype(float)
    there = np.isfinite(images)
    v = np.where(there, images, 0.0)
    base = np.where(there.any(axis=1), background(v, there), 0.0)
    light = np.where(there, v, -np.inf).max(axis=1, initial=-np.inf) - base
    valid = (there.sum(axis=1) >= 9) & (light > 0)
    q = np.zeros((len(v), 7))
    status, steps = np.full(len(v), INVALID), np.zeros(len(v), int)
    start = np.stack([base, light, 0 * base, 0 * base, 0 * base + 0.15 * width, 0 * base + 0.15 * width, 0 * base], axis=1)
    some = np.flatnonzero(valid)
    if len(some):
        q[some], status[some], steps[some] = _descend(start[some], v[some], there[some], dx, dy, tolerance, most)
    with np.errstate(all="ignore"):
        good = np.isfinite(q).all(axis=1) & (q[:, 1] > 0) & (q[:, 4] > 0.3) & (q[:, 5] > 0.3) & (FWHM * q[:, 4] <= width) & (FWHM * q[:, 5] <= height) & (np.abs(q[:, 0] - base) <= 0.5 * np.maximum(base, 0.01))
    status[valid & ~good] = NO_CONVERGENCE
    ok = np.flatnonzero(valid & good)
    turns = np.stack([q[:, 6], np.pi / 2 - q[:, 6], np.pi / 2 + q[:, 6], np.pi - q[:, 6]], axis=1)
    left = np.full((len(v), 4), np.inf)
    for k in range(4):  # which turn it is that leaves least
        left[ok, k] = trimmed(v[ok] - model(np.concatenate([q[ok, :6], turns[ok, k : k + 1]], axis=1), dx, dy), there[ok])
    best = left.argmin(axis=1)
    wide, narrow = np.maximum(q[:, 4], q[:, 5]), np.minimum(q[:, 4], q[:, 5])
    with np.errstate(all="ignore"):
        out = {
            "background": q[:, 0], "amplitude": q[:, 1], "cx": q[:, 2], "cy": q[:, 3], "sx": q[:, 4], "sy": q[:, 5], "theta": turns[np.arange(len(v)), best], "fwhm_x": FWHM * q[:, 4], "fwhm_y": FWHM * q[:, 5],
            "flux": 2 * np.pi * q[:, 1] * q[:, 4] * q[:, 5] / 3, "eccentricity": np.sqrt(1 - (narrow / wide) ** 2), "residual": left[np.arange(len(v)), best]}
    for c in out:
        out[c] = np.where(valid & good, out[c], np.nan)
    return {"status": status, **out, "iterations": steps}


def fitted(cutout: Column, width: int, batch: int = 128) -> Column:
    """FIT of arrays of width * height pixels by rows; null for null arrays and such of another length than whole rows, NaN numbers where the fit failed. So many images as `batch` are fitted at once: their slopes should stay in a core's cache."""

    @F.arrow_udf(FIT)
    def run(column: pa.Array) -> pa.Array:
        off = np.asarray(column.offsets)
        flat = column.values.to_numpy(zero_copy_only=False).astype(float)
        size = np.diff(off)
        usable = (size > 0) & (size % width == 0) & ~np.asarray(column.is_null())
        got: dict[str, np.ndarray] = {}
        for n in np.unique(size[usable]):
            like = np.flatnonzero(usable & (size == n))
            for i in range(0, len(like), batch):
                rows = like[i : i + batch]
                for c, x in fits(flat[off[rows][:, None] + np.arange(n)], width).items():
                    got.setdefault(c, np.full(len(size), -1 if x.dtype.kind == "i" else np.nan, x.dtype))[rows] = x
        kinds = [f.split(":") for f in FIT[len("struct<") : -1].split(",")]
        cols = [pa.array(got.get(c, np.zeros(len(size))), pa.int32() if k == "int" else pa.float64(), mask=~usable) for c, k in kinds]
        return pa.StructArray.from_arrays(cols, [c for c, _ in kinds], mask=pa.array(~usable))

    return run(cutout)
