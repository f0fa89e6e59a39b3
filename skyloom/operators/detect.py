"""Stars in images: frames as tiles with a halo, one row a tile, and everything about a tile in a few array steps.

A tile's core is its own, its halo belongs to its neighbours, so that each peak is found once and the result is the same
for every tile size. Pixels are shuffled once; only those near a border go to more tiles than one. What is decided per
frame (median, noise, brightest value) is aggregated beside it and joined on the frame.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.robust import order_statistics
from skyloom.operators.spatial import plane_join
from skyloom.session import cut, written

HALO = 32
FOUND = "x int, y int, cx double, cy double, sx double, sy double, amplitude double, radius int, saturated boolean, cutout array<double>"


@dataclass(frozen=True)
class Detection:
    """sigma: of the smoothing. height: the threshold above the median, in noises. reach: a peak tops all pixels this near. near: of its 8 neighbours so many are above the threshold. full, flat: shares of the dynamic range that mark a saturated plateau. walk: pixels within which a profile's turning point is sought. cutout: the images of stars reach so far from the peak."""

    sigma: float = 2.0
    height: float = 5.0
    reach: int = 5
    near: int = 3
    ceiling: float = 65535.0
    full: float = 0.7
    flat: float = 0.1
    walk: int = 12
    lopsided: float = 2.0
    cutout: int = 10


def tiles(pixels: DataFrame, by: list[str], side: int = 256, halo: int = HALO, x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """(*by, tx, ty, left, top, wide, values): a row for each tile with pixels in its core, its rows of wide values from (left, top) on in one array; NaN where there is no pixel. Of pixels that are there more than once the greatest value counts."""
    over = lambda c: F.sequence(F.floor((F.col(c) - halo) / side).cast("int"), F.floor((F.col(c) + halo) / side).cast("int"))
    at = pixels.select(*by, F.col(x).cast("int").alias("__x"), F.col(y).cast("int").alias("__y"), F.col(value).cast("double").alias("__v"), F.explode(over(x)).alias("tx"), F.col(y))
    at = at.select(*by, "__x", "__y", "__v", "tx", F.explode(over(y)).alias("ty"))
    wide = side + 2 * halo
    place = (F.col("__y") - F.col("ty") * side + halo) * wide + F.col("__x") - F.col("tx") * side + halo
    core = (F.floor(F.col("__x") / side) == F.col("tx")) & (F.floor(F.col("__y") / side) == F.col("ty"))
    held = at.groupBy(*by, "tx", "ty").agg(F.collect_list(F.struct(place.cast("int").alias("p"), F.col("__v").alias("v"))).alias("__l"), F.max(core).alias("__core")).where("__core")

    @F.arrow_udf("array<double>")
    def filled(listed: pa.Array) -> pa.Array:
        off = np.asarray(listed.offsets)
        flat = listed.values.slice(off[0], off[-1] - off[0])
        n = len(off) - 1
        out = np.full((n, wide * wide), np.nan)
        row = np.repeat(np.arange(n), np.diff(off))
        p, v = flat.field("p").to_numpy(zero_copy_only=False), flat.field("v").to_numpy(zero_copy_only=False).astype(float)
        np.fmax.at(out, (row, p), v)
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * (wide * wide)), pa.array(out.ravel()))

    return held.select(*by, "tx", "ty", (F.col("tx") * side - halo).alias("left"), (F.col("ty") * side - halo).alias("top"), F.lit(wide).alias("wide"), filled("__l").alias("values"))


def smoothed(image: np.ndarray, sigma: float) -> np.ndarray:
    """image by a Gaussian, cut off at four deviations; missing pixels don't count, and a margin without any costs nothing."""
    rows, columns = (np.flatnonzero(np.isfinite(image).any(axis=k)) for k in (1, 0))
    if not len(rows):
        return np.full(image.shape, np.nan)
    inner = slice(rows[0], rows[-1] + 1), slice(columns[0], columns[-1] + 1)
    if image[inner].shape != image.shape:
        whole = np.full(image.shape, np.nan)
        whole[inner] = smoothed(image[inner], sigma)
        return whole
    r = int(np.ceil(4 * sigma))
    k = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    there = np.isfinite(image).astype(float)
    out = [np.where(there > 0, image, 0.0), there]
    for axis in (0, 1):
        for j, a in enumerate(out):
            pad = np.pad(a, [(r, r) if i == axis else (0, 0) for i in (0, 1)])
            out[j] = sum(w * (pad[i : i + a.shape[0]] if axis == 0 else pad[:, i : i + a.shape[1]]) for i, w in enumerate(k))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(there > 0, out[0] / out[1], np.nan)


def median_filtered(image: np.ndarray, reach: int) -> np.ndarray:
    """The median of the square about each pixel; missing pixels don't count."""
    pad = np.pad(image, reach, constant_values=np.nan)
    view = np.lib.stride_tricks.sliding_window_view(pad, (2 * reach + 1, 2 * reach + 1)).reshape(*image.shape, -1)
    with np.errstate(all="ignore"):
        return np.nanmedian(view, axis=-1) if np.isfinite(image).any() else image.copy()


def extreme(image: np.ndarray, reach: int, largest: bool, circle: bool = False) -> np.ndarray:
    """The greatest (dilation) or least (erosion) value about each pixel, in a square or a circle."""
    empty = -np.inf if largest else np.inf
    pad = np.pad(np.where(np.isfinite(image), image, empty), reach, constant_values=empty)
    out = np.full(image.shape, empty)
    for dy in range(-reach, reach + 1):
        for dx in range(-reach, reach + 1):
            if not circle or dx * dx + dy * dy <= reach * reach:
                part = pad[reach + dy : reach + dy + image.shape[0], reach + dx : reach + dx + image.shape[1]]
                out = np.maximum(out, part) if largest else np.minimum(out, part)
    return np.where(np.isfinite(image), out, np.nan)


def wavelet(image: np.ndarray, scales: int) -> np.ndarray:
    """The planes of the a-trous transform with the B3 spline, finest first, the rest last; their sum is the image. Edges repeat."""
    spline, planes, now = np.array([1, 4, 6, 4, 1]) / 16, [], image
    for j in range(scales):
        step, soft = 1 << j, now
        for axis in (0, 1):
            at = np.arange(soft.shape[axis])
            soft = sum(w * np.take(soft, np.clip(at + (i - 2) * step, 0, len(at) - 1), axis=axis) for i, w in enumerate(spline))
        planes.append(now - soft)
        now = soft
    return np.stack([*planes, now])


def peaks(smooth: np.ndarray, reach: int, threshold: float) -> np.ndarray:
    """Places (y, x) above threshold that top all pixels within reach; of equal ones the first in reading order does. A square with a missing pixel has no peak."""
    with np.errstate(invalid="ignore"):
        y, x = np.nonzero(smooth > threshold)
    inside = (y >= reach) & (y < smooth.shape[0] - reach) & (x >= reach) & (x < smooth.shape[1] - reach)
    y, x = y[inside], x[inside]
    for dy in range(-reach, reach + 1):
        for dx in range(-reach, reach + 1):
            if (dx or dy) and len(y):
                other, own = smooth[y + dy, x + dx], smooth[y, x]
                first = dy < 0 or dy == 0 and dx < 0
                keep = own > other if first else own >= other
                y, x = y[keep], x[keep]
    return np.stack([y, x], axis=1)


def _profile(smooth: np.ndarray, y: np.ndarray, x: np.ndarray, dy: int, dx: int, start: np.ndarray, walk: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Along one direction: the distance to the turning point, the slope there, and whether there is one within walk pixels."""
    far = np.arange(-1, walk + 3)
    at = start[:, None] + far
    v = smooth[np.clip(y[:, None] + dy * at, 0, smooth.shape[0] - 1), np.clip(x[:, None] + dx * at, 0, smooth.shape[1] - 1)]
    bend = v[:, 2:] + v[:, :-2] - 2 * v[:, 1:-1]
    with np.errstate(invalid="ignore"):
        turned = bend[:, 1:] >= 0
    k = turned.argmax(axis=1)
    row = np.arange(len(y))
    here, after = bend[row, k], bend[row, k + 1]
    with np.errstate(divide="ignore", invalid="ignore"):
        part = np.where(np.abs(after - here) < 1e-20, 0.0, here / (after - here))
    return start + k - part, v[row, k + 1] - v[row, k], turned.any(axis=1) & np.isfinite(after) & np.isfinite(here)


def found_in(image: np.ndarray, level: float, noise: float, brightest: float, core: tuple[int, int | np.ndarray], p: Detection) -> dict[str, np.ndarray]:
    """Stars whose peak lies in the core, from `core[0]` up to but without `core[1]` in x and y; x and y are places of the array, cx and cy offsets from them."""
    smooth = smoothed(image, p.sigma)
    threshold = level + p.height * noise
    at = peaks(smooth, p.reach, threshold)
    at = at[((at >= core[0]) & (at < core[1])).all(axis=1)]
    y, x = at[:, 0], at[:, 1]
    around = [(dy, dx) for dy in (-1, 0, 1) for dx in (-1, 0, 1) if dy or dx]
    eight = np.stack([image[y + dy, x + dx] for dy, dx in around], axis=1) if len(y) else np.zeros((0, 8))
    with np.errstate(invalid="ignore"):
        high = eight >= threshold
    count = high.sum(axis=1)
    keep = count >= p.near
    y, x, eight, high, count = y[keep], x[keep], eight[keep], high[keep], count[keep]
    span = min(brightest, p.ceiling) - level
    own = image[y, x]
    with np.errstate(invalid="ignore"):
        mean = np.where(high, eight, 0.0).sum(axis=1) / np.maximum(count, 1)
        least = np.where(high, eight, np.inf).min(axis=1, initial=np.inf)
        saturated = (mean - level >= p.full * span) & (own - least <= p.flat * span)
    # a plateau's middle, by the walk along its row and column
    plateau = np.minimum(own, p.ceiling) - p.flat * span
    reach = {}
    for name, dy, dx in (("right", 0, 1), ("left", 0, -1), ("down", 1, 0), ("up", -1, 0)):
        steps = np.arange(p.walk + 1)
        v = smooth[np.clip(y[:, None] + dy * steps, 0, image.shape[0] - 1), np.clip(x[:, None] + dx * steps, 0, image.shape[1] - 1)]
        with np.errstate(invalid="ignore"):
            low = ~(v > plateau[:, None])
        reach[name] = np.where(saturated, np.where(low.any(axis=1), low.argmax(axis=1), p.walk), 0)
    px, py = x, y
    x = x + np.where(saturated, (reach["right"] - reach["left"]) // 2, 0)
    y = y + np.where(saturated, (reach["down"] - reach["up"]) // 2, 0)
    s = lambda dy, dx: smooth[np.clip(y + dy, 0, image.shape[0] - 1), np.clip(x + dx, 0, image.shape[1] - 1)]

    def middle(back, here, ahead):
        bend = ahead - 2 * here + back
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(saturated | (np.abs(bend) < 1e-20), 0.0, -0.5 - (here - back) / bend)

    mx, my = middle(s(0, -1), s(0, 0), s(0, 1)), middle(s(-1, 0), s(0, 0), s(1, 0))
    wing = {}
    for name, dy, dx, off in (("right", 0, 1, mx), ("left", 0, -1, -mx), ("down", 1, 0, my), ("up", -1, 0, -my)):
        far = (dx or dy) * np.where(dx != 0, px - x, py - y) + reach[name]  # from the moved middle to the plateau's edge
        d, slope, good = _profile(smooth, y, x, dy, dx, np.where(saturated, np.maximum(far, 0), 0), p.walk)
        d = d - off
        wing[name] = (d, -slope * d * np.sqrt(np.e), good)
    (r, ar, g1), (le, al, g2), (dn, ad, g3), (up, au, g4) = (wing[k] for k in ("right", "left", "down", "up"))
    sx, sy, ax, ay = (r + le) / 2, (dn + up) / 2, (ar + al) / 2, (ad + au) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        even = lambda a, b: np.maximum(a, b) <= p.lopsided * np.minimum(a, b)
        good = g1 & g2 & g3 & g4 & even(np.abs(ax), np.abs(ay)) & even(r, le) & even(dn, up) & (np.maximum(ax, ay) >= p.height * noise)
        radius = np.clip(np.ceil(np.sqrt(-2 * np.log(0.001)) * np.where(good, np.maximum(sx, sy), 1.0)), p.reach, 200).astype(int)
    y, x, mx, my, sx, sy, own, radius, saturated = (a[good] for a in (y, x, mx, my, sx, sy, own, radius, saturated))
    k = p.cutout
    pad = np.pad(image, k, constant_values=np.nan)
    cut_outs = np.stack([pad[j : j + 2 * k + 1, i : i + 2 * k + 1].ravel() for j, i in zip(y, x, strict=True)]) if len(y) else np.zeros((0, (2 * k + 1) ** 2))
    return {"x": x, "y": y, "cx": mx, "cy": my, "sx": sx, "sy": sy, "amplitude": own - level, "radius": radius, "saturated": saturated, "cutout": cut_outs}


def filtered(pixels: DataFrame, by: list[str], filters: dict[str, object], side: int = 256, halo: int = HALO, value: str = "value") -> DataFrame:
    """(*by, x, y, a column for each of filters) of every pixel with a value. A filter makes an image of the same shape from an image, and must not look farther than halo."""
    held = tiles(pixels, by, side, halo, value=value)
    schema = T.StructType([*held.select(*by).schema.fields, *T._parse_datatype_string("x int, y int, " + ", ".join(f"{c} double" for c in filters)).fields])

    def run(batches):
        for b in batches:
            names = b.schema.names
            col = {c: b.column(names.index(c)) for c in names}
            for i in range(b.num_rows):
                wide = col["wide"][i].as_py()
                image = col["values"].slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(wide, wide)
                own = slice(halo, halo + side)
                y, x = np.nonzero(np.isfinite(image[own, own]))
                made = [pa.array(f(image)[own, own][y, x]) for f in filters.values()]
                yield pa.record_batch([*[pa.repeat(col[c][i], len(x)) for c in by], pa.array((x + halo + col["left"][i].as_py()).astype(np.int32)), pa.array((y + halo + col["top"][i].as_py()).astype(np.int32)), *made], schema.names)

    return held.mapInArrow(run, schema)


def levels(pixels: DataFrame, by: list[str], x: str = "x", y: str = "y", value: str = "value") -> DataFrame:
    """(*by, level, noise, brightest) of each frame: the upper median; the median over rows of the spread of first differences, clipped at five robust deviations three times, over sqrt 2; the greatest value."""
    good = pixels.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    rows = good.groupBy(*by, y).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(x).alias("x"), F.col(value).cast("double").alias("v")))), lambda s: s["v"]).alias("__r"))
    noise = rows.select(*by, _row_noise("__r").alias("__n")).groupBy(*by).agg((F.percentile("__n", F.lit(0.5)) * 0.70710678).alias("noise"))
    top = good.groupBy(*by).agg(F.max(F.col(value).cast("double")).alias("brightest"))
    return order_statistics(good, by, value, {"level": 0.5}).join(noise, by).join(top, by)


@F.arrow_udf(T.DoubleType())
def _row_noise(rows: pa.Array) -> pa.Array:
    out = []
    off, flat = np.asarray(rows.offsets), rows.values.to_numpy(zero_copy_only=False)
    for i, j in zip(off[:-1], off[1:], strict=True):
        d = np.diff(flat[i:j])
        kept = d
        for _ in range(4):
            if len(kept) < 2:
                break
            mid = np.median(kept)
            wide = 5 * 1.4826 * np.median(np.abs(kept - mid))
            last, kept = kept, d[(d >= mid - wide) & (d <= mid + wide)]
            if len(last) == len(kept) and np.array_equal(last, kept):
                break
        out.append(float(kept.std()) if len(kept) > 1 else 0.0)
    return pa.array(out, pa.float64())


def stars(pixels: DataFrame, by: list[str], p: Detection = Detection(), side: int = 256, value: str = "value") -> DataFrame:
    """(*by, x, y, cx, cy, sx, sy, amplitude, radius, saturated, cutout) of each star in frames of pixels (*by, x, y, value).

    x, y: the peak; cx, cy: its middle between pixels; sx, sy: widths from the turning points of the smoothed profiles;
    cutout: the square of 2 * p.cutout + 1 pixels a side about the peak by rows, null where there is no pixel. Pixels
    without a value are missing; a peak needs whole surroundings. The result doesn't depend on side.
    """
    if HALO < int(np.ceil(4 * p.sigma)) + p.walk + max(p.reach, p.cutout):
        raise ValueError("sigma, walk and cutout reach beyond the tiles' halo")
    held = tiles(pixels, by, side, value=value).join(levels(pixels, by, value=value), by)
    schema = T.StructType([*held.select(*by).schema.fields, *T._parse_datatype_string(FOUND).fields])

    def run(batches):
        for b in batches:
            names = b.schema.names
            col = {c: b.column(names.index(c)) for c in names}
            for i in range(b.num_rows):
                wide = col["wide"][i].as_py()
                image = col["values"].slice(i, 1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(wide, wide)
                got = found_in(image, *(col[c][i].as_py() for c in ("level", "noise", "brightest")), (HALO, HALO + side), p)
                yield _found(got, col["left"][i].as_py(), col["top"][i].as_py(), [col[c][i] for c in by], schema.names)

    return held.mapInArrow(run, schema)


def _found(found: dict[str, np.ndarray], left: int, top: int, keys: list[pa.Scalar], names: list[str]) -> pa.RecordBatch:
    """What found_in found, with places of the frame in place of those of an image whose first pixel is at (left, top)."""
    got, n = dict(found), len(found["x"])
    for c, first in (("x", left), ("y", top)):
        got[c] = got[c] + first
        got[f"c{c}"] = got[c] + got[f"c{c}"]
    images = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * got["cutout"].shape[1]), pa.array(got["cutout"].ravel(), from_pandas=True))
    flat = [pa.array(got[c].astype(np.int32)) if c in ("x", "y", "radius") else pa.array(got[c]) for c in ("x", "y", "cx", "cy", "sx", "sy", "amplitude", "radius", "saturated")]
    return pa.record_batch([*[pa.repeat(k, n) for k in keys], *flat, images], names)


def row_noises(image: np.ndarray, rounds: int = 4) -> np.ndarray:
    """_row_noise of the rows of an image that have a pixel, all at once; missing pixels are NaN."""
    there = ~np.isnan(image)
    image, there = image[there.any(axis=1)], there[there.any(axis=1)]
    if not len(image):
        return np.zeros(0)
    left = np.argsort(~there, axis=1, kind="stable")  # a row's pixels side by side
    d = np.diff(np.take_along_axis(image, left, axis=1), axis=1)
    d = np.where(np.arange(d.shape[1]) < there.sum(axis=1)[:, None] - 1, d, np.nan)
    kept = ~np.isnan(d)

    for _ in range(rounds):
        some = kept.sum(axis=1) >= 2
        if not some.any():
            break
        with np.errstate(invalid="ignore"):
            n = np.where(some, kept.sum(axis=1), 1)
            s, row = np.sort(np.where(kept, d, np.inf), axis=1), np.arange(len(d))
            mid = (s[row, (n - 1) // 2] + s[row, np.minimum(n // 2, d.shape[1] - 1)]) / 2
            s = np.sort(np.where(kept, np.abs(d - mid[:, None]), np.inf), axis=1)
            wide = 5 * 1.4826 * (s[row, (n - 1) // 2] + s[row, np.minimum(n // 2, d.shape[1] - 1)]) / 2
            now = np.where(some[:, None], (d >= (mid - wide)[:, None]) & (d <= (mid + wide)[:, None]), kept)
        if np.array_equal(now, kept):
            break
        kept = now
    return np.array([v[k].std() if k.sum() > 1 else 0.0 for v, k in zip(d, kept, strict=True)])


def levels_in(image: np.ndarray) -> tuple[float, float, float] | None:
    """levels of a whole frame; None where it has no pixel."""
    flat = np.sort(image[~np.isnan(image)])
    if not len(flat):
        return None
    noise = np.sort(row_noises(image))
    return float(flat[len(flat) // 2]), float((noise[(len(noise) - 1) // 2] + noise[len(noise) // 2]) / 2 * 0.70710678), float(flat[-1])


def patch_pixels(patches: DataFrame, by: list[str]) -> DataFrame:
    """(*by, x, y, value): the pixels of patches."""
    at = patches.select(*by, "left", "top", "wide", F.posexplode("values").alias("__i", "value"))
    return at.select(*by, (F.col("left") + F.col("__i") % F.col("wide")).alias("x"), (F.col("top") + F.floor(F.col("__i") / F.col("wide"))).cast("int").alias("y"), "value")


def stars_in_patches(patches: DataFrame, by: list[str], p: Detection = Detection(), side: int = 256, whole: int = 1 << 18) -> DataFrame:
    """stars of frames that come as patches (*by, left, top, wide, high, values): rectangles, high rows of wide values each, that don't overlap.

    A frame whose rectangle has up to `whole` pixels is one row: its levels are worked out where its stars are sought, so that
    patches are made and read once, and not shuffled if they are dealt by frames. Larger frames go by pixels, levels and tiles.
    """
    if HALO < int(np.ceil(4 * p.sigma)) + p.walk + max(p.reach, p.cutout):
        raise ValueError("sigma, walk and cutout reach beyond the halo")
    known = F.lit(True)
    for c in by:
        known &= F.col(c).isNotNull()
    patches = patches.where(known)
    low, high = lambda c: F.min(c).cast("long"), lambda c, n: F.max(F.col(c).cast("long") + F.col(n))
    frames = patches.groupBy(*by).agg(((high("left", "wide") - low("left")) * (high("top", "high") - low("top"))).alias("__area"))
    large = written(frames.where(F.col("__area") > whole).select(*by))
    some = not large.isEmpty()
    small = patches.join(large, by, "left_anti") if some else patches
    held = small.groupBy(*by).agg(F.collect_list(F.struct("left", "top", "wide", "high", "values")).alias("__l"))
    schema = T.StructType([*held.select(*by).schema.fields, *T._parse_datatype_string(FOUND).fields])

    def run(batches):
        for b in batches:
            listed = b.column(b.num_columns - 1)
            off, flat = np.asarray(listed.offsets), listed.values
            left, top, wide, high = (np.asarray(flat.field(c)) for c in ("left", "top", "wide", "high"))
            values = flat.field("values")
            at = np.asarray(values.offsets)
            v = values.values.to_numpy(zero_copy_only=False).astype(float, copy=False)
            for i in range(b.num_rows):
                own = range(off[i], off[i + 1])
                x0, y0 = left[own].min(), top[own].min()
                image = np.full((int((top + high)[own].max() - y0) + 2 * HALO, int((left + wide)[own].max() - x0) + 2 * HALO), np.nan)
                for k in own:
                    y, x = top[k] - y0 + HALO, left[k] - x0 + HALO
                    into = image[y : y + high[k], x : x + wide[k]]
                    np.fmax(into, v[at[k] : at[k + 1]].reshape(high[k], wide[k]), out=into)
                level = levels_in(image[HALO:-HALO, HALO:-HALO])
                if level is not None:
                    yield _found(found_in(image, *level, (HALO, np.array(image.shape) - HALO), p), int(x0) - HALO, int(y0) - HALO, [b.column(k)[i] for k in range(len(by))], schema.names)

    got = held.mapInArrow(run, schema)
    return got.unionByName(stars(patch_pixels(patches.join(large, by, "left_semi"), by), by, p, side)) if some else got


def thinned(rows: DataFrame, by: list[str], radius: float, order: list[Column], open_end: bool = False) -> DataFrame:
    """The rows that stay when each is taken in the given order and drops all later ones of its group within radius (open_end: nearer than radius) in (cx, cy). Rounds over pairs decide all rows whose earlier neighbours are decided; a round's table is checkpointed."""
    every = cut(rows.withColumn("__id", F.monotonically_increasing_id()))
    key = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)], F.col("__id"))
    # of rows at one place the first takes the others with it, or falls to what they fall to
    placed = F.col("cx").isNotNull() & F.col("cy").isNotNull() & ~F.isnan("cx") & ~F.isnan("cy")
    first = every.where(placed).groupBy(*by, "cx", "cy").agg(F.min(key).alias("__k")).select("__k.__id")
    named = cut(every.join(first.unionByName(every.where(~placed).select("__id")), "__id", "left_semi"))
    side = lambda name: named.select(*by, F.col("__id").alias(f"__{name}"), key.alias(f"__k{name}"), F.col("cx").alias(f"__x{name}"), F.col("cy").alias(f"__y{name}"))
    a, b = side("a"), side("b").withColumnsRenamed({c: f"__g{i}" for i, c in enumerate(by)})
    near = plane_join(a, b, radius, "__xa", "__ya", "__xb", "__yb", {c: f"__g{i}" for i, c in enumerate(by)}).where("__ka < __kb")
    pairs = cut((near.where(F.col("dist") < radius) if open_end else near).select("__a", "__b"))
    gone = None
    open_pairs = pairs
    while not open_pairs.isEmpty():
        later = open_pairs.select(F.col("__b").alias("__a")).distinct()
        first = open_pairs.select("__a").distinct().join(later, "__a", "left_anti")  # nothing earlier is open: they stay
        dropped = cut(open_pairs.join(first, "__a", "left_semi").select(F.col("__b").alias("__id")).distinct())
        gone = dropped if gone is None else gone.unionByName(dropped)
        out = dropped.withColumnRenamed("__id", "__a")
        left = open_pairs.join(out, "__a", "left_anti").join(out.withColumnRenamed("__a", "__b"), "__b", "left_anti").join(first, "__a", "left_anti")
        open_pairs = cut(left.select("__a", "__b"))
    return (named if gone is None else named.join(gone, "__id", "left_anti")).drop("__id")


def deduplicated(found: DataFrame, by: list[str]) -> DataFrame:
    """Stars without repeats: a saturated star drops unsaturated ones nearer than 2 pixels and, by falling radius, other saturated ones; of unsaturated ones within 1 pixel the first stays, in the order of y and x. Of one pixel's stars the order is that of cy and cx."""
    place = [F.col(c) for c in ("y", "x", "cy", "cx")]
    lit = thinned(found.where("saturated"), by, 2.0, [-F.col("radius"), *place], open_end=True)
    every = found.where("saturated").select(*[F.col(c).alias(f"__g{i}") for i, c in enumerate(by)], F.col("cx").alias("__x"), F.col("cy").alias("__y"))
    plain = found.where("not saturated")
    of = {c: f"__g{i}" for i, c in enumerate(by)}
    met = plane_join(plain.select(*by, "cx", "cy").distinct(), every.distinct(), 2.0, "cx", "cy", "__x", "__y", of).where("dist < 2")
    own = met.select(*[F.col(c).alias(f"__o{c}") for c in (*by, "cx", "cy")]).distinct()
    same = F.lit(True)
    for c in (*by, "cx", "cy"):
        same &= F.col(c).eqNullSafe(F.col(f"__o{c}"))
    alone = plain.join(own, same, "left_anti")
    return lit.unionByName(thinned(alone, by, 1.0, place))
