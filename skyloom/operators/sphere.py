"""Polygons on the sphere in whole batches: cell and pixel outlines, clipping by great circles, and the overlap joins of drizzling.

A batch of polygons is an array (polygon, corner, 3) of unit vectors with the number of corners of each. Cells of the
nested grid and pixels of a tangent-plane image with distortion are traced along their edges, and an edge is split
where its middle leaves the great circle of its ends.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.functions.healpix import nside_for_scale
from skyloom.session import dealt

WCS = ("ra0", "dec0", "px0", "py0", "cd11", "cd12", "cd21", "cd22")  # an image's centre on the sky and in pixels, and degrees a pixel
SIP = 6  # distortion coefficients stand at p * SIP + q for dx**p * dy**q


def unit(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    """Unit vectors of directions in degrees."""
    a, d = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=-1)


def _normal(v: np.ndarray) -> np.ndarray:
    return v / np.linalg.norm(v, axis=-1, keepdims=True)


def area(poly: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Solid angles, by triangles from the first corner; positive where the corners turn left seen from outside.

    Of a triangle a, b, c it is 2 atan2(a . (b - a) x (c - a), 1 + a.b + b.c + c.a), which small ones don't cancel in.
    """
    a, b, c = poly[:, :1], poly[:, 1:-1], poly[:, 2:]
    if not c.shape[1]:
        return np.zeros(len(n))
    up = (a * np.cross(b - a, c - a)).sum(-1)
    down = 1 + (a * b).sum(-1) + (b * c).sum(-1) + (c * a).sum(-1)
    real = np.arange(b.shape[1]) + 2 < n[:, None]
    return np.where(real, 2 * np.arctan2(up, down), 0.0).sum(axis=1)


def _circle(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Normals of the great circles from a to b, to the left; from the difference, which is exact where a and b are close."""
    x, y, z = (b - a)[..., 0], (b - a)[..., 1], (b - a)[..., 2]
    v = np.stack([a[..., 1] * z - a[..., 2] * y, a[..., 2] * x - a[..., 0] * z, a[..., 0] * y - a[..., 1] * x], axis=-1)
    return v / np.maximum(np.sqrt(np.einsum("...i,...i->...", v, v)), 1e-300)[..., None]


def clip(poly: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each polygon's part to the left of its great circle from a to b."""
    normal = _circle(a, b)
    at = np.arange(poly.shape[1])[None, :]
    real = at < n[:, None]
    d = np.where(real, ((poly - a[:, None, :]) * normal[:, None, :]).sum(-1), -1.0)
    inside = (d >= 0).sum(axis=1)
    cut = np.flatnonzero((inside > 0) & (inside < n))  # the others stay or go as they are
    left = np.where(inside == n, n, 0)
    if not len(cut):
        return poly, np.where(left < 3, 0, left)
    part, kept = _crossed(poly[cut], n[cut], d[cut])
    if part.shape[1] > poly.shape[1]:
        poly = np.concatenate([poly, np.zeros((len(n), part.shape[1] - poly.shape[1], 3))], axis=1)
    else:
        poly = poly.copy()
    poly[cut, : part.shape[1]] = part
    left[cut] = kept
    left = np.where(left < 3, 0, left)
    return poly[:, : max(1, int(left.max(initial=0)))], left


def _crossed(poly: np.ndarray, n: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parts with d >= 0 of polygons that the circle of d = 0 crosses."""
    rows, at = np.arange(len(n))[:, None], np.arange(poly.shape[1])[None, :]
    real = at < n[:, None]
    after = np.where(at + 1 < n[:, None], at + 1, 0)
    d2 = d[rows, after]
    keep, cross = real & (d >= 0), real & ((d >= 0) != (d2 >= 0))
    count = keep.astype(int) + cross  # a corner gives itself if inside, then the crossing of its edge
    place = np.cumsum(count, axis=1) - count
    total = count.sum(axis=1)
    out = np.zeros((len(n), max(1, int(total.max(initial=0))), 3))
    row = np.broadcast_to(rows, real.shape)
    out[row[keep], place[keep]] = poly[keep]
    met = poly[cross] * d2[cross][:, None] - poly[row[cross], after[cross]] * d[cross][:, None]
    met *= np.where(d2[cross] >= 0, 1.0, -1.0)[:, None]
    length = np.linalg.norm(met, axis=-1, keepdims=True)
    out[row[cross], (place + keep)[cross]] = met / np.where(length > 0, length, 1.0)
    return out, total


def _padded(item: np.ndarray, v: np.ndarray, items: int) -> tuple[np.ndarray, np.ndarray]:
    """Polygons from corners sorted by item."""
    n = np.bincount(item, minlength=items)
    out = np.zeros((items, max(1, int(n.max(initial=0))), 3))
    out[item, np.arange(len(item)) - (np.cumsum(n) - n)[item]] = v
    return out, n


def traced(point, items: int, tolerance: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Outlines of four edges each. point(item, edge, t) is the direction at share t of an edge; an edge is halved until its middle is within tolerance of the great circle, at most depth times."""
    item, edge = np.repeat(np.arange(items), 4), np.tile(np.arange(4), items)
    low, high = np.zeros(len(item)), np.ones(len(item))
    a = point(item, edge, low)
    b = a.reshape(items, 4, 3)[:, [1, 2, 3, 0]].reshape(-1, 3)
    done: list[tuple[np.ndarray, ...]] = []
    for level in range(depth + 1):
        mid = (low + high) / 2
        m = point(item, edge, mid)
        off = np.abs(np.einsum("ij,ij->i", _circle(a, b), m - a))
        split = (off >= tolerance[item]) & (level < depth)
        done.append((item[~split], edge[~split], low[~split], a[~split]))
        if not split.any():
            break
        item, edge = np.tile(item[split], 2), np.tile(edge[split], 2)
        low, high = np.concatenate([low[split], mid[split]]), np.concatenate([mid[split], high[split]])
        a, b = np.concatenate([a[split], m[split]]), np.concatenate([m[split], b[split]])
    item, edge, low, v = (np.concatenate(c) for c in zip(*done, strict=True))
    order = np.lexsort((low, edge, item))
    return _padded(item[order], v[order], items)


# cells


def _place(pix: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base face and place in it of nested cells."""
    m = pix & ((1 << 2 * order) - 1)
    x, y = np.zeros_like(m), np.zeros_like(m)
    for k in range(order):
        x |= (m >> 2 * k & 1) << k
        y |= (m >> 2 * k + 1 & 1) << k
    return pix >> 2 * order, x, y


def face_point(face: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The direction at shares x, y of a base face (Gorski et al. 2005): between the latitudes of sin 2/3 rows are evenly spaced in z, beyond them they close in on the poles."""
    row = face // 4
    down = row + 2 - x - y  # from the north pole, in faces
    polar = np.where(down < 1, down, np.where(down > 3, 4 - down, 1.0))
    z = np.where(down < 1, 1 - polar**2 / 3, np.where(down > 3, polar**2 / 3 - 1, (2 - down) * (2 / 3)))
    eighths = 2 * (face % 4) + (row != 1)  # of the face's middle
    turn = np.where(polar > 0, (eighths * polar + x - y) / np.where(polar > 0, polar, 1.0), 0.0) * (np.pi / 4)
    # of z near 1 the distance from the axis comes from polar, without cancellation
    away = np.where((down < 1) | (down > 3), polar * np.sqrt((2 - polar**2 / 3) / 3), np.sqrt(np.maximum(0.0, 1 - z * z)))
    return np.stack([away * np.cos(turn), away * np.sin(turn), z], axis=-1)


def cell_centres(pix: np.ndarray, order: int) -> np.ndarray:
    face, x, y = _place(pix, order)
    side = 1 << order
    return face_point(face, (x + 0.5) / side, (y + 0.5) / side)


_CORNERS = np.array([(0, 0), (1, 0), (1, 1), (0, 1)])


def cell_outlines(pix: np.ndarray, order: int, share: float = 1e-6, depth: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Outlines of cells, exact to `share` of a cell's size; with depth 0 their four corners."""
    face, x, y = _place(pix, order)
    side = 1 << order

    def point(item, edge, t):
        start, end = _CORNERS[edge], _CORNERS[(edge + 1) % 4]
        at = start + (end - start) * t[:, None]
        return face_point(face[item], (x[item] + at[:, 0]) / side, (y[item] + at[:, 1]) / side)

    return traced(point, len(pix), np.full(len(pix), share * np.sqrt(np.pi / 3) / side), depth)


def cell_radius(order: int) -> float:
    """No cell reaches farther than this from its centre, in radians."""
    side = 1 << order
    z = 1 - (1 - 1 / side) ** 2 / 3
    a, b = np.array([np.sqrt(5) / 3 * np.cos(np.pi / 4 / side), np.sqrt(5) / 3 * np.sin(np.pi / 4 / side), 2 / 3]), np.array([np.sqrt(1 - z * z), 0, z])
    return 1.01 * float(np.arccos(np.clip(a @ b, -1, 1)))


def disc_cells(centre: np.ndarray, radius: np.ndarray, order: int, touching: bool) -> tuple[np.ndarray, np.ndarray]:
    """(disc, cell) of each disc's cells: whose centres lie within, or, touching, that may reach into it. Cells are halved down from the base faces, those out of reach given up."""
    disc, pix = np.repeat(np.arange(len(centre)), 12), np.tile(np.arange(12, dtype=np.int64), len(centre))
    for k in range(order + 1):
        if k:
            disc, pix = np.repeat(disc, 4), (np.repeat(pix, 4) << 2) + np.tile(np.arange(4), len(pix))
        reach = radius[disc] + (cell_radius(k) if touching or k < order else 0.0)
        gap = np.linalg.norm(cell_centres(pix, k) - centre[disc], axis=-1)
        near = (reach >= np.pi) | (gap <= 2 * np.sin(np.minimum(reach, np.pi) / 2) + 1e-15)
        disc, pix = disc[near], pix[near]
    return disc, pix


# pixels


@dataclass
class Frames:
    """Image geometry, a row for each pixel: WCS columns, and distortion coefficients (or None)."""

    wcs: dict[str, np.ndarray]
    a: np.ndarray | None = None
    b: np.ndarray | None = None

    def take(self, rows: np.ndarray) -> Frames:
        def some(x):  # one distortion for all rows is kept once
            if x is None or not len(x) or x.strides[0] and (x != x[:1]).any():
                return None if x is None else x[rows]
            return np.broadcast_to(x[:1], (len(rows), x.shape[1]))

        return Frames({k: v[rows] for k, v in self.wcs.items()}, some(self.a), some(self.b))

    def _bent(self, c: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
        out = np.zeros(len(dx))
        used = (c if c.strides[0] else c[:1]).any(axis=0).reshape(SIP, SIP)
        for p in range(int(np.flatnonzero(used.any(axis=1)).max(initial=-1)), -1, -1):  # nested in dx, then in dy, from the highest powers that there are
            inner = np.zeros(len(dx))
            for q in range(int(np.flatnonzero(used[p]).max(initial=-1)), -1, -1):
                inner = inner * dy + c[:, p * SIP + q]
            out = out * dx + inner
        return out

    def _plane(self, dx: np.ndarray, dy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.a is None:
            return dx, dy
        return dx + self._bent(self.a, dx, dy), dy + self._bent(self.b, dx, dy)

    def _axes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The centre, and the directions of rising right ascension and declination there."""
        a, d = np.radians(self.wcs["ra0"]), np.radians(self.wcs["dec0"])
        zero = np.zeros_like(a)
        return unit(self.wcs["ra0"], self.wcs["dec0"]), np.stack([-np.sin(a), np.cos(a), zero], -1), np.stack([-np.sin(d) * np.cos(a), -np.sin(d) * np.sin(a), np.cos(d)], -1)

    def sky(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        w = self.wcs
        u, v = self._plane(x - w["px0"], y - w["py0"])
        xi, eta = np.radians(w["cd11"] * u + w["cd12"] * v), np.radians(w["cd21"] * u + w["cd22"] * v)
        c, e, n = self._axes()
        return _normal(c + xi[:, None] * e + eta[:, None] * n)

    def pixel(self, v: np.ndarray, rounds: int = 30, settled: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
        """The place of directions; NaN for those a quarter turn away or more. Distortion is undone by repeated substitution, until no place moves by more than `settled` pixels."""
        w = self.wcs
        c, e, n = self._axes()
        front = (v * c).sum(-1)
        with np.errstate(divide="ignore", invalid="ignore"):
            xi, eta = (np.degrees(np.where(front > 0, (v * k).sum(-1) / front, np.nan)) for k in (e, n))
        det = w["cd11"] * w["cd22"] - w["cd12"] * w["cd21"]
        u, t = (w["cd22"] * xi - w["cd12"] * eta) / det, (w["cd11"] * eta - w["cd21"] * xi) / det
        dx, dy = u, t
        for _ in range(rounds if self.a is not None else 0):
            last, (dx, dy) = (dx, dy), (u - self._bent(self.a, dx, dy), t - self._bent(self.b, dx, dy))
            if not ((np.abs(dx - last[0]) > settled) | (np.abs(dy - last[1]) > settled)).any() and np.array_equal(np.isnan(dx), np.isnan(last[0])):
                break
        return dx + w["px0"], dy + w["py0"]

    def outlines(self, x: np.ndarray, y: np.ndarray, size: float = 1.0, bend: float = 1e-8, depth: int = 12) -> tuple[np.ndarray, np.ndarray]:
        """Outlines of the squares of `size` pixels about (x, y), exact to the share `bend` of a pixel."""
        scale = np.radians(np.sqrt(np.abs(self.wcs["cd11"] * self.wcs["cd22"] - self.wcs["cd12"] * self.wcs["cd21"])))

        def point(item, edge, t):
            start, end = _CORNERS[edge], _CORNERS[(edge + 1) % 4]
            at = (start + (end - start) * t[:, None] - 0.5) * size
            return self.take(item).sky(x[item] + at[:, 0], y[item] + at[:, 1])

        return traced(point, len(x), np.maximum(scale * bend, 1e-15), depth)


def _left_turning(poly: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The polygons with their corners turning left."""
    at = np.arange(poly.shape[1])[None, :]
    back = np.where(at < n[:, None], n[:, None] - 1 - at, at)
    return np.where((area(poly, n) < 0)[:, None, None], np.take_along_axis(poly, back[:, :, None], axis=1), poly)


def _clipped_area(poly: np.ndarray, n: np.ndarray, circles) -> np.ndarray:
    """Solid angles of what is left of polygons to the left of several great circles; circles has functions of rows that give their two places. What is empty is let go at once."""
    out, own = np.zeros(len(n)), np.arange(len(n))
    for circle in circles:
        poly, n = clip(poly, n, *circle(own))
        some = n > 0
        if not some.all():
            poly, n, own = poly[some], n[some], own[some]
    out[own] = np.maximum(0.0, area(poly, n))
    return out


def shared_area(subject: np.ndarray, ns: np.ndarray, shape: np.ndarray, nd: np.ndarray, batch: int = 50_000) -> np.ndarray:
    """Solid angle that each subject shares with its shape. A shape of four corners is convex; one of more is taken by triangles about its middle, `batch` of them at a time."""
    out = np.zeros(len(ns))
    shape, subject = _left_turning(shape, nd), _left_turning(subject, ns)
    whole = nd == 4
    for m in np.unique(nd[whole]):
        like = np.flatnonzero(whole & (nd == m))
        for i in range(0, len(like), batch):
            rows = like[i : i + batch]
            most = max(1, int(ns[rows].max(initial=0)))
            out[rows] = _clipped_area(subject[rows, :most], ns[rows], [lambda own, k=k: (shape[rows[own], k], shape[rows[own], (k + 1) % m]) for k in range(m)])
    rest = np.flatnonzero(~whole & (nd >= 3))
    if len(rest):
        at = np.arange(shape.shape[1])[None, :]
        middle = _normal(np.where((at < nd[rest, None])[:, :, None], shape[rest], 0.0).sum(axis=1))
        pair = np.repeat(np.arange(len(rest)), nd[rest])
        corner = np.arange(len(pair)) - (np.cumsum(nd[rest]) - nd[rest])[pair]
        for i in range(0, len(pair), batch):
            k, own = corner[i : i + batch], pair[i : i + batch]
            a, b, m = shape[rest[own], k], shape[rest[own], (k + 1) % nd[rest][own]], middle[own]
            sides = [lambda r, p=p, q=q: (p[r], q[r]) for p, q in ((a, b), (b, m), (m, a))]
            np.add.at(out, rest[own], _clipped_area(subject[rest[own]], ns[rest[own]], sides))
    return out


def _planes(middle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two directions square to each middle and to one another, turning left seen from outside."""
    axis = np.eye(3)[np.abs(middle).argmin(axis=1)]
    a = _normal(np.cross(axis, middle))
    return a, np.cross(middle, a)


def _cross(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return a[0] * b[1] - a[1] * b[0]


def _wedge(p: tuple[np.ndarray, np.ndarray], q: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Signed solid angles of the triangles of a tangent plane's point of touch with p and q."""
    a, b = np.sqrt(1 + p[0] * p[0] + p[1] * p[1]), np.sqrt(1 + q[0] * q[0] + q[1] * q[1])
    return 2 * np.arctan2(_cross(p, q), a * b + a + b + 1 + p[0] * q[0] + p[1] * q[1])


def shared_areas(subject: np.ndarray, ns: np.ndarray, at: np.ndarray, shape: np.ndarray, nd: np.ndarray, place: np.ndarray, batch: int = 20_000) -> np.ndarray:
    """shared_area of the pairs (at, place) of subjects and shapes, by one walk along each subject's edges.

    In the plane that touches the sphere at a shape's middle its outline is a distance in each direction. What a
    subject's edge sweeps about the middle counts up to the outline: edges are cut at the directions of the shape's corners, what
    lies beyond the line between two corners is drawn back to it; a subject that turns right counts the same. Pairs that reach far from the middle, and shapes
    that their middle doesn't see whole, go by shared_area.
    """
    out, shape = np.zeros(len(at)), _left_turning(shape, nd)
    if not len(at):
        return out
    real = np.arange(shape.shape[1])[None, :] < nd[:, None]
    middle = _normal(np.where(real[:, :, None], shape, 0.0).sum(axis=1))
    a, b = _planes(middle)
    axes = [np.ascontiguousarray(c.T) for c in (a, b, middle)]
    flat = lambda v, of: tuple(v[0] * c[0][of] + v[1] * c[1][of] + v[2] * c[2][of] for c in axes)
    own = np.repeat(np.arange(len(nd)), nd)
    start = np.cumsum(nd) - nd
    x, y, up = flat(np.ascontiguousarray(shape[real].T), own)
    seen = np.bincount(own, up < 0.3, len(nd)) == 0
    with np.errstate(divide="ignore", invalid="ignore"):
        corner = x / up, y / up
        turn = np.arctan2(corner[1], corner[0])
    order = np.lexsort((turn, own))  # of shapes seen whole only their first corner changes
    after = np.arange(len(own)) + 1
    after[start + nd - 1] = start
    seen &= np.bincount(own, (turn[after] < turn), len(nd)) == 1
    corner, turn = tuple(c[order] for c in corner), turn[order]
    side = tuple(c[after] - c for c in corner)
    level = _cross(side, corner)  # of the line between two corners; the middle lies at 0, above it
    seen &= (np.bincount(own, ~(level < 0), len(nd)) == 0) & (nd >= 3)
    whole = np.bincount(own, np.where(seen[own], _wedge(corner, tuple(c[after] for c in corner)), 0.0), len(nd))
    key = own * 8.0 + turn

    real = np.arange(subject.shape[1])[None, :] < ns[:, None]
    edge, first = np.ascontiguousarray(subject[real].T), np.cumsum(ns) - ns
    near = seen[place] & (ns[at] >= 3)
    ends = np.cumsum(np.where(near, ns[at], 0))
    i = 0
    while i < len(at):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + batch, "right")))
        pairs = np.arange(i, j)[near[i:j]]
        i = j
        if not len(pairs):
            continue
        n = ns[at[pairs]]
        pair = np.repeat(np.arange(len(pairs)), n)
        begin = np.cumsum(n) - n
        to = place[pairs][pair]
        x, y, up = flat(edge[:, np.repeat(first[at[pairs]] - begin, n) + np.arange(len(pair))], to)
        far = np.bincount(pair, up < 0.3, len(pairs)) > 0
        near[pairs[far]] = False
        up = np.where(up < 0.3, 1.0, up)
        p = x / up, y / up
        following = np.arange(len(pair)) + 1
        following[begin + n - 1] = begin
        angle = to * 8.0 + np.arctan2(p[1], p[0])
        w = np.searchsorted(key, angle, "right") - 1 - start[to]  # the last corner before, or -1
        m, w2 = nd[to], w[following]
        delta = angle[following] - angle
        back = (delta < 0) != (np.abs(delta) > np.pi)  # against the turn, the shorter way
        steps = np.where(np.abs(delta) > np.pi, m, 0) + np.where(back, w - w2, w2 - w)
        e = np.repeat(np.arange(len(pair)), steps + 1)
        t = np.arange(len(e)) - (np.cumsum(steps + 1) - steps - 1)[e]
        sign = np.where(back, -1, 1)[e]
        wedge = start[to[e]] + (w[e] + sign * t) % m[e]
        ray = start[to[e]] + (w[e] + np.where(back[e], -t, t + 1)) % m[e]  # that the piece ends at, but the last
        v, v2 = tuple(c[e] for c in p), tuple(c[following][e] for c in p)
        r = tuple(c[ray] for c in corner)
        c1, c2 = _cross(v, r), _cross(v2, r)
        with np.errstate(divide="ignore", invalid="ignore"):
            share = np.clip(np.nan_to_num(c1 / (c1 - c2), nan=0.5), 0.0, 1.0)
        last = t == steps[e]
        end = tuple(np.where(last, h, g + share * (h - g)) for g, h in zip(v, v2, strict=True))
        lead = np.concatenate([[0], np.arange(len(e) - 1)])
        begun = tuple(np.where(t == 0, g, c[lead]) for g, c in zip(v, end, strict=True))
        s, low = tuple(c[wedge] for c in side), level[wedge]
        h1, h2 = _cross(s, begun), _cross(s, end)
        in1, in2 = h1 >= low, h2 >= low
        with np.errstate(divide="ignore", invalid="ignore"):
            f1, f2 = np.where(in1, 1.0, low / h1), np.where(in2, 1.0, low / h2)
            u = np.where(in1 != in2, (h1 - low) / (h1 - h2), 0.0)
        p1, p2 = tuple(c * f1 for c in begun), tuple(c * f2 for c in end)
        met = tuple(np.where(in1 != in2, g + u * (h - g), k) for g, h, k in zip(begun, end, p1, strict=True))
        swept = _wedge(met, p2)
        split = np.flatnonzero(in1 != in2)
        swept[split] += _wedge(tuple(c[split] for c in p1), tuple(c[split] for c in met))
        of = pair[e]
        total = np.bincount(of, swept, len(pairs))
        inside = np.bincount(of, in1 | in2, len(pairs)) > 0
        around = np.abs(np.bincount(pair, np.where(back, -1, 1) * np.where(np.abs(delta) > np.pi, 2 * np.pi - np.abs(delta), np.abs(delta)), len(pairs))) > np.pi
        out[pairs] = np.where(inside, np.abs(total), np.where(around, whole[place[pairs]], 0.0))  # no edge within: all of the shape or nothing
    rest = np.flatnonzero(~near)
    for i in range(0, len(rest), 4096):
        k = rest[i : i + 4096]
        out[k] = shared_area(subject[at[k]], ns[at[k]], shape[place[k]], nd[place[k]])
    return out


def _bounds(poly: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Middle and radius of a disc about each polygon."""
    own = np.repeat(np.arange(len(n)), n)
    flat = poly[np.arange(poly.shape[1])[None, :] < n[:, None]]
    middle = _normal(np.stack([np.bincount(own, flat[:, k], len(n)) for k in range(3)], axis=1))
    off = flat - middle[own]
    gap = np.zeros(len(n))
    np.maximum.at(gap, own, np.sqrt(np.einsum("ij,ij->i", off, off)))
    return middle, 2 * np.arcsin(np.minimum(1.0, gap / 2))


def _meeting(poly: np.ndarray, n: np.ndarray, at: np.ndarray, other: np.ndarray, m: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Of pairs (at, place) of polygons whether the discs about them meet."""
    (c, r), (d, s) = _bounds(poly, n), _bounds(other, m)
    reach = np.minimum(np.pi, (r[at] + s[place]) * (1 + 1e-9) + 1e-12)
    return np.linalg.norm(c[at] - d[place], axis=-1) <= 2 * np.sin(reach / 2) + 1e-15


def _frames(b: pa.RecordBatch, names: list[str]) -> Frames:
    get = lambda c: np.asarray(b.column(names.index(c)).to_numpy(zero_copy_only=False), float)
    if "sip_a" not in names:
        return Frames({c: get(c) for c in WCS})

    def grid(c):
        v = b.column(names.index(c))
        if not v.null_count and len(v.flatten()) == len(v) * SIP * SIP:
            return np.asarray(v.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, SIP * SIP)
        return np.array([v if v is not None else [0.0] * SIP * SIP for v in v.to_pylist()], float).reshape(-1, SIP * SIP)

    return Frames({c: get(c) for c in WCS}, grid("sip_a"), grid("sip_b"))


def _joined(df: DataFrame, work, added: str, batch: int = 2048, keep: list[str] | None = None) -> DataFrame:
    """df's rows repeated: work(record batch, names) gives the row of each output row and the added columns. Of df's columns those in keep stay, all by default."""
    names = df.columns
    held = [i for i, c in enumerate(names) if keep is None or c in keep]
    schema = T.StructType([*[df.schema.fields[i] for i in held], *T._parse_datatype_string(added).fields])

    def run(batches):
        for whole in batches:
            for i in range(0, whole.num_rows, batch):
                b = whole.slice(i, batch)
                row, more = work(b, names)
                yield pa.record_batch([*[b.column(c).take(pa.array(row)) for c in held], *[m if isinstance(m, pa.Array) else pa.array(m) for m in more]], schema.names)

    return df.mapInArrow(run, schema)


def _usable(df: DataFrame) -> DataFrame:
    """Rows with a whole geometry of an invertible matrix."""
    good = F.lit(True)
    for c in WCS:
        good &= F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return df.where(good & (F.abs(F.col("cd11") * F.col("cd22") - F.col("cd12") * F.col("cd21")) > 1e-30))


def pixel_overlaps(pixels: DataFrame, order: int, size: float = 1.0, least: float = 1e-20, keep: list[str] | None = None) -> DataFrame:
    """pixels with pix, weight and drop_area, a row for each cell that a pixel's drop covers: weight is the shared part of the drop's solid angle.

    pixels has x, y, the columns of WCS and, for distortion, arrays sip_a and sip_b; a drop is the square of `size` pixels
    about (x, y). Shares of `least` steradian or less are left out, and so are rows without a whole geometry. Each row is
    worked out alone; rows are dealt over all tasks first, as each takes long. Of the columns of pixels only those in keep
    come back, if it is given: an image's geometry is far larger than a cell.
    """

    def work(b: pa.RecordBatch, names: list[str]):
        f = _frames(b, names)
        x, y = (np.asarray(b.column(names.index(c)).to_numpy(zero_copy_only=False), float) for c in "xy")
        poly, n = f.outlines(x, y, size)
        own = np.abs(area(poly, n))
        row, pix = disc_cells(*_bounds(poly, n), order, touching=True)
        each, at = np.unique(pix, return_inverse=True)
        cell, nc = cell_outlines(each, order)
        near = _meeting(cell, nc, at, poly, n, row)
        row, pix, at = row[near], pix[near], at[near]
        shared = shared_areas(cell, nc, at, poly, n, row)
        kept = shared > least
        row, pix, shared = row[kept], pix[kept], shared[kept]
        return row, (pix, shared / own[row], own[row])

    return _joined(dealt(_usable(pixels)), work, "pix long, weight double, drop_area double", keep=keep)


def _cells_on_pixels(f: Frames, image: np.ndarray, pix: np.ndarray, order: int, width: int, height: int, shrink: float, least: float) -> tuple[np.ndarray, ...]:
    """(row, x, y, weight, drop_area, pixel_area): the pixels of images f that the drops of cells pix cover, row by row; image numbers equal images."""
    each, same = np.unique(pix, return_inverse=True)
    poly, n = cell_outlines(each, order)
    if shrink < 1:
        poly = drawn(poly, cell_centres(each, order), shrink)
    own = np.abs(area(poly, n))[same]
    of = np.repeat(np.arange(len(pix)), n[same])  # each cell's corners, for each image that it is met with
    flat, first = poly[np.arange(poly.shape[1])[None, :] < n[:, None]], np.cumsum(n) - n
    corner = np.arange(len(of)) - np.repeat(np.cumsum(n[same]) - n[same] - first[same], n[same])
    px, py = f.take(of).pixel(flat[corner], settled=1e-9)  # for bounds with a pixel to spare
    low, high = np.full((2, len(pix)), np.inf), np.full((2, len(pix)), -np.inf)
    for k, p in enumerate((px, py)):
        seen = np.isfinite(p)
        np.minimum.at(low[k], of[seen], p[seen])
        np.maximum.at(high[k], of[seen], p[seen])
    limit = np.array([[width - 1], [height - 1]])
    met = (low <= high).all(axis=0)
    first = np.where(met, np.maximum(0, np.floor(np.where(met, low, 0.0) - 1)), 1).astype(np.int64)
    last = np.where(met, np.minimum(limit, np.ceil(np.where(met, high, 0.0) + 1)), 0).astype(np.int64)
    span = np.maximum(0, last - first + 1)
    count = span[0] * span[1]
    row = np.repeat(np.arange(len(pix)), count)
    k = np.arange(len(row)) - (np.cumsum(count) - count)[row]
    x, y = first[0][row] + k % np.maximum(span[0], 1)[row], first[1][row] + k // np.maximum(span[0], 1)[row]
    if not len(row):
        return row, x, y, np.zeros(0), np.zeros(0), np.zeros(0)
    _, one, at = np.unique((image[row] * height + y) * width + x, return_index=True, return_inverse=True)  # cells share pixels
    square, ns = f.take(row[one]).outlines(x[one].astype(float), y[one].astype(float))
    near = _meeting(poly, n, same[row], square, ns, at)
    row, x, y, at = row[near], x[near], y[near], at[near]
    shared = shared_areas(poly, n, same[row], square, ns, at)
    kept = shared > least
    row, whole = row[kept], np.abs(area(square, ns))[at][kept]
    return row, x[kept], y[kept], shared[kept] / own[row], own[row], whole


def cell_overlaps(cells: DataFrame, order: int, width: int, height: int, shrink: float = 1.0, least: float = 1e-20) -> DataFrame:
    """cells with x, y, weight, drop_area and pixel_area, a row for each pixel of its image that a cell's drop covers: the reverse of pixel_overlaps.

    cells has pix and the columns of the image's geometry. A drop is the cell, drawn to its centre along great circles to
    the share `shrink`. Pixels are numbered from 0, to width - 1 and height - 1; cells that don't reach the image are left out.
    """

    def work(b: pa.RecordBatch, names: list[str]):
        pix = np.asarray(b.column(names.index("pix")).to_numpy(zero_copy_only=False), np.int64)
        f = _frames(b, names)
        geometry = np.column_stack([*f.wcs.values(), *(c for grid in (f.a, f.b) if grid is not None for c in grid.T)])
        image = np.unique(geometry, axis=0, return_inverse=True)[1].reshape(-1)
        row, *more = _cells_on_pixels(f, image, pix, order, width, height, shrink, least)
        return row, more

    return _joined(_usable(cells.where(F.col("pix").between(0, 12 * 4**order - 1))), work, "x long, y long, weight double, drop_area double, pixel_area double")

def disc_overlaps(images: DataFrame, radius: float, order: int, width: int, height: int, shrink: float = 1.0, least: float = 1e-20, keep: list[str] | None = None) -> DataFrame:
    """cell_overlaps of cells_in_disc(images, radius, order, touching=True), in one step: cells and what they cover are worked out where the image is, and only the columns of images in keep come back, with pix."""

    def work(b: pa.RecordBatch, names: list[str]):
        f = _frames(b, names)
        image, pix = disc_cells(unit(f.wcs["ra0"], f.wcs["dec0"]), np.full(b.num_rows, np.radians(radius)), order, True)
        row, *more = _cells_on_pixels(f.take(image), image, pix, order, width, height, shrink, least)
        return image[row], (pix[row], *more)

    return _joined(dealt(_usable(images)), work, "pix long, x long, y long, weight double, drop_area double, pixel_area double", 32, keep)


def drawn(poly: np.ndarray, centre: np.ndarray, share: float) -> np.ndarray:
    """Corners drawn to a centre along great circles, to a share of their way."""
    gap = 2 * np.arcsin(np.minimum(1.0, np.linalg.norm(poly - centre[:, None], axis=-1, keepdims=True) / 2))
    far = np.sin(gap)
    safe = np.where(far > 0, far, 1.0)
    out = np.where(far > 0, centre[:, None] * np.sin((1 - share) * gap) / safe + poly * np.sin(share * gap) / safe, centre[:, None])
    return _normal(out)


def reverse_drizzled(overlaps: DataFrame, by: list[str], signal: str, support: str) -> DataFrame:
    """(*by, x, y, signal, coverage, n): cells' signals on an image's pixels, and the covered share of each pixel, 1 at most. Signals that aren't finite don't count."""
    w = F.col("weight")
    good = overlaps.where(F.col(signal).isNotNull() & ~F.isnan(F.col(signal)) & (F.abs(F.col(signal)) != float("inf")))
    covered = F.sum(F.col(support) * w * F.col("drop_area") / F.col("pixel_area"))
    return good.groupBy(*by, "x", "y").agg(F.sum(F.col(signal) * w).alias("signal"), F.least(F.lit(1.0), covered).alias("coverage"), F.count("*").alias("n"))


def cells_in_disc(points: DataFrame, radius: float, order: int, ra: str = "ra0", dec: str = "dec0", touching: bool = False) -> DataFrame:
    """points with pix, a row for each cell whose centre is within radius degrees, or, touching, for each that may reach into the disc. Rows with null positions are left out. Points are dealt over all tasks first: cells are many, and what is done with them takes long."""

    def work(b: pa.RecordBatch, names: list[str]):
        a, d = (np.asarray(b.column(names.index(c)).to_numpy(zero_copy_only=False), float) for c in (ra, dec))
        row, pix = disc_cells(unit(a, d), np.full(len(a), np.radians(radius)), order, touching)
        return row, (pix,)

    return _joined(dealt(points.where(F.col(ra).isNotNull() & F.col(dec).isNotNull())), work, "pix long")


def outlined(cells: DataFrame, order: int, share: float = 1e-6) -> DataFrame:
    """cells with outline, its corners as (ra, dec) in degrees, and outline_area, the solid angle within, for the nested cells in pix; rows without a cell are left out."""

    def work(b: pa.RecordBatch, names: list[str]):
        pix = np.asarray(b.column(names.index("pix")).to_numpy(zero_copy_only=False), np.int64)
        poly, n = cell_outlines(pix, order, share)
        corner = np.arange(poly.shape[1])[None, :] < n[:, None]
        v = poly[corner]
        ra, dec = np.degrees(np.arctan2(v[:, 1], v[:, 0])) % 360, np.degrees(np.arcsin(np.clip(v[:, 2], -1, 1)))
        flat = pa.StructArray.from_arrays([pa.array(ra), pa.array(dec)], ["ra", "dec"])
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), flat)
        return np.arange(len(pix)), (lists, area(poly, n))

    return _joined(cells.where(F.col("pix").between(0, 12 * 4**order - 1)), work, "outline array<struct<ra:double,dec:double>>, outline_area double")


# pixel scales


def local_scale(frames: Frames, x: np.ndarray, y: np.ndarray, half: float = 0.5) -> np.ndarray:
    """Arcseconds a pixel in the direction in which pixels are finest, by differences of one pixel in the tangent plane of each place; NaN where there is none."""
    c = frames.sky(x, y)

    def at(dx: float, dy: float) -> np.ndarray:
        v = frames.sky(x + dx, y + dy)
        return v / (v * c).sum(-1)[:, None]

    with np.errstate(all="ignore"):
        along, across = (at(half, 0.0) - at(-half, 0.0)) / (2 * half), (at(0.0, half) - at(0.0, -half)) / (2 * half)
        a, b, d = (along * along).sum(-1), (along * across).sum(-1), (across * across).sum(-1)
        finest = np.degrees(np.sqrt((a * d - b * b) / ((a + d + np.sqrt((a - d) ** 2 + 4 * b * b)) / 2))) * 3600
    return np.where(np.isfinite(finest) & (finest > 0), finest, np.nan)


def sampled_scales(frames: Frames, width: np.ndarray, height: np.ndarray, ratio: float, depth: int, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(finest, coarsest, samples) of each image: cells are sampled at nine places and quartered level by level while their scales differ by more than ratio."""
    finest, coarsest, samples = np.full(len(width), np.inf), np.zeros(len(width)), np.zeros(len(width), np.int64)
    item = np.flatnonzero((width > 0) & (height > 0))
    x0, y0 = np.full(len(item), 0.5), np.full(len(item), 0.5)
    x1, y1 = np.maximum(width[item] - 0.5, 1.5), np.maximum(height[item] - 0.5, 1.5)
    for level in range(depth + 1):
        if not len(item):
            break
        mine, low, high = frames.take(item), np.full(len(item), np.inf), np.zeros(len(item))
        for i in (0.0, 0.5, 1.0):
            for j in (0.0, 0.5, 1.0):
                s = local_scale(mine, x0 + (x1 - x0) * i, y0 + (y1 - y0) * j)
                low, high = np.fmin(low, s), np.fmax(high, s)
                np.add.at(samples, item, ~np.isnan(s))
        np.minimum.at(finest, item, low)
        np.maximum.at(coarsest, item, high)
        split = (high > 0) & (high > low * ratio) & (x1 - x0 >= least) & (y1 - y0 >= least) & (level < depth)
        item, xm, ym = item[split], (x0 + x1)[split] / 2, (y0 + y1)[split] / 2
        left, low_y, right, high_y = x0[split], y0[split], x1[split], y1[split]
        x0, x1 = np.concatenate([left, xm, left, xm]), np.concatenate([xm, right, xm, right])
        y0, y1 = np.concatenate([low_y, low_y, ym, ym]), np.concatenate([ym, ym, high_y, high_y])
        item = np.tile(item, 4)
    return finest, coarsest, samples


def finest_scales(images: DataFrame, ratio: float = 1.25, depth: int = 5, least: float = 4.0, batch: int = 32) -> DataFrame:
    """images with finest and coarsest (arcseconds a pixel), samples, and nside, the smallest power of two from 16 to 2**22 whose cells are as fine as the finest pixel.

    images has width, height, the columns of WCS and, for distortion, sip_a and sip_b. A row is an image; the places
    sampled in it are followed by distortion, at most 4**depth cells, in batches of images and without any shuffle.
    An image without a size, or without a usable geometry anywhere, has null scales and nside.
    """

    side = float(np.degrees(np.sqrt(np.pi / 3)) * 3600)  # of a cell at nside 1, by its area

    def work(b, names):
        size = lambda c: np.nan_to_num(np.asarray(b.column(names.index(c)).to_numpy(zero_copy_only=False), float))
        fine, coarse, n = sampled_scales(_frames(b, names), size("width"), size("height"), ratio, depth, least)
        return np.arange(b.num_rows), [pa.array(fine, mask=n == 0), pa.array(coarse, mask=n == 0), n]

    return _joined(images, work, "finest double, coarsest double, samples long", batch).withColumn("nside", F.when(F.col("finest").isNotNull(), nside_for_scale(F.col("finest"), side)))
