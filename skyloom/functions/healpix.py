"""HEALPix nested indexing as column expressions (Gorski et al. 2005): no UDF, so plans stay inside code generation."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def _and(a: Column, mask: int) -> Column:
    return a.bitwiseAND(F.lit(mask).cast("long"))


# Reading binary digits as digits of base 4 spreads them; x stands once in the expression, so nested uses stay small.


def spread(x: Column) -> Column:
    """The bits of x, up to 31, each followed by a 0 bit."""
    return F.conv(F.bin(x.cast("long")), 4, 10).cast("long")


def compact(x: Column) -> Column:
    """The even bits of x, together."""
    return F.conv(F.conv(_and(x.cast("long"), 0x1555555555555555).cast("string"), 10, 4), 2, 10).cast("long")


def morton(x: Column, y: Column) -> Column:
    """x on even bits, y on odd ones."""
    return spread(x).bitwiseOR(F.shiftleft(spread(y), 1))


def unmorton(m: Column) -> tuple[Column, Column]:
    return compact(m), compact(F.shiftright(m.cast("long"), 1))


def ang2pix(order: int, ra: Column, dec: Column) -> Column:
    """The nested pixel of (ra, dec) in degrees; null where either is null or not a number."""
    nside = 1 << order
    z = F.sin(F.radians(dec))
    za = F.abs(z)
    t = F.pmod(ra / F.lit(90.0), F.lit(4.0))
    a, b = F.lit(float(nside)) * (F.lit(0.5) + t), F.lit(nside * 0.75) * z
    jp, jm = F.floor(a - b), F.floor(a + b)
    fp, fm = F.shiftright(jp, order), F.shiftright(jm, order)
    face = F.when(fp == fm, _and(fp, 3) + 4).when(fp < fm, _and(fp, 3)).otherwise(_and(fm, 3) + 8)
    flat = F.struct(face.alias("face"), _and(jm, nside - 1).alias("x"), (F.lit(nside - 1) - _and(jp, nside - 1)).alias("y"))
    quarter = F.least(F.floor(t), F.lit(3).cast("long"))
    part = t - quarter
    r = F.lit(float(nside)) * F.sqrt(F.lit(3.0) * (F.lit(1.0) - za))
    top = F.lit(nside - 1).cast("long")
    kp, km = F.least(F.floor(part * r), top), F.least(F.floor((F.lit(1.0) - part) * r), top)
    north = z >= 0
    cap = F.struct(F.when(north, quarter).otherwise(quarter + 8).alias("face"), F.when(north, top - km).otherwise(kp).alias("x"), F.when(north, top - kp).otherwise(km).alias("y"))
    at = F.when(za <= F.lit(2.0 / 3.0), flat).otherwise(cap)
    good = ra.isNotNull() & dec.isNotNull() & ~F.isnan(ra) & ~F.isnan(dec)
    return F.when(good, at["face"] * F.lit(nside * nside) + morton(at["x"], at["y"])).cast("long")


def with_centre(df: DataFrame, order: int, pix: str = "pix", ra: str = "ra", dec: str = "dec") -> DataFrame:
    """df with the direction of each pixel's centre in degrees. The steps are columns, so that none is computed twice."""
    nside = 1 << order
    p, own = F.col(pix).cast("long"), ["__f", "__x", "__y", "__jr", "__nr", "__ks", "__jp"]
    f, x, y, jr, nr, ks, jp = (F.col(c) for c in own)
    cx, cy = unmorton(_and(p, nside * nside - 1))
    north, south = jr < nside, jr > 3 * nside
    cap = nr * nr / F.lit(3.0 * nside * nside)
    z = F.when(north, F.lit(1.0) - cap).when(south, cap - F.lit(1.0)).otherwise((F.lit(2 * nside) - jr) * F.lit(2.0 / (3.0 * nside)))
    # the column of a base face in units of eighths of a turn: 1, 3, 5, 7 for faces 0-3 and 8-11, 0, 2, 4, 6 for 4-7
    base = 2 * _and(f, 3) + F.when(F.floor(f / 4) == 1, 0).otherwise(1)
    out = df.withColumns({"__f": F.shiftright(p, 2 * order), "__x": cx, "__y": cy}).withColumn("__jr", (F.floor(f / 4) + 2) * nside - x - y - 1)
    out = out.withColumns({"__nr": F.when(north, jr).when(south, 4 * nside - jr).otherwise(F.lit(nside)), "__ks": F.when(north | south, F.lit(0)).otherwise(_and(jr - nside, 1))})
    out = out.withColumn("__jp", F.floor((base * nr + x - y + 1 + ks) / 2))
    turned = F.when(jp > 4 * nr, jp - 4 * nr).when(jp < 1, jp + 4 * nr).otherwise(jp)
    return out.withColumns({ra: (turned - (ks + 1) * F.lit(0.5)) * (F.lit(90.0) / nr), dec: F.degrees(F.asin(z))}).drop(*own)


def parent(pix: Column, levels: int) -> Column:
    return F.shiftright(pix.cast("long"), 2 * levels)


def first_child(pix: Column, levels: int) -> Column:
    return F.shiftleft(pix.cast("long"), 2 * levels)


def uniq(order: Column | int, pix: Column) -> Column:
    """4 * 4**order + pix."""
    o = F.lit(order) if isinstance(order, int) else order
    return (F.lit(4) * F.pow(F.lit(4.0), o).cast("long") + pix).cast("long")


def uniq_order(u: Column) -> Column:
    """The order of a UNIQ number, from its highest bit; null below 4."""
    bits = F.length(F.bin(u))
    return F.when(u >= 4, F.floor((bits - 1) / 2) - 1).cast("int")


def uniq_pix(u: Column) -> Column:
    return (u - F.lit(4) * F.pow(F.lit(4.0), uniq_order(u)).cast("long")).cast("long")


def angular_distance(ra1: Column, dec1: Column, ra2: Column, dec2: Column) -> Column:
    """Degrees between two directions, by the clamped cosine."""
    c = F.sin(F.radians(dec1)) * F.sin(F.radians(dec2)) + F.cos(F.radians(dec1)) * F.cos(F.radians(dec2)) * F.cos(F.radians(ra2 - ra1))
    return F.degrees(F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), c))))


def resolution_arcsec(order: int) -> float:
    return math.sqrt(4 * math.pi / (12 * 4**order)) * 180 * 3600 / math.pi


def npix(order: int) -> int:
    return 12 * 4**order


def fits_index(local: Column, shift: int) -> Column:
    """Row-major place in a tile image of 2**shift pixels a side: row width-1-x, column y."""
    x, y = unmorton(local)
    return ((1 << shift) - 1 - x) * (1 << shift) + y


def fits_local(index: Column, shift: int) -> Column:
    """The pixel within a tile that fits_index puts at index."""
    width = 1 << shift
    return morton(F.lit(width - 1) - F.shiftright(index.cast("long"), shift), _and(index.cast("long"), width - 1))


def pixel_scale(cd11: Column, cd12: Column, cd21: Column, cd22: Column) -> Column:
    """Arcseconds a pixel: the root of the matrix' determinant."""
    return F.sqrt(F.abs(cd11 * cd22 - cd12 * cd21)) * 3600


def nside_for_scale(arcsec: Column, side: float = 211034.6) -> Column:
    """The smallest power of two whose pixels, `side` arcseconds over nside, are as fine, between 16 and 2**22."""
    return F.least(F.lit(1 << 22), F.greatest(F.lit(16), F.pow(F.lit(2.0), F.ceil(F.log2(F.lit(side) / arcsec))))).cast("long")


# Of each base face the one beyond its (x, y) border, x and y each -1, 0 or 1; none where three faces meet.
_BESIDE = {
    (-1, -1): [8, 9, 10, 11, None, None, None, None, 10, 11, 8, 9],
    (0, -1): [5, 6, 7, 4, 8, 9, 10, 11, 9, 10, 11, 8],
    (1, -1): [None, None, None, None, 5, 6, 7, 4, None, None, None, None],
    (-1, 0): [4, 5, 6, 7, 11, 8, 9, 10, 11, 8, 9, 10],
    (0, 0): [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11],
    (1, 0): [1, 2, 3, 0, 0, 1, 2, 3, 5, 6, 7, 4],
    (-1, 1): [None, None, None, None, 7, 4, 5, 6, None, None, None, None],
    (0, 1): [3, 0, 1, 2, 3, 0, 1, 2, 4, 5, 6, 7],
    (1, 1): [2, 3, 0, 1, None, None, None, None, 0, 1, 2, 3],
}


def neighbours(pixels: DataFrame, order: int, pix: str = "pix") -> DataFrame:
    """A row for each row and each neighbour of its pixel: those that share an edge or a corner, 8, or 7 where three base faces meet.

    A step over a border of a base face goes to the face beside it. Between two polar faces of a hemisphere the axes
    change places and one of them turns round; elsewhere they keep their direction.
    """
    size, n = 4**order, 1 << order
    p = F.col(pix).cast("long")
    x, y = unmorton(_and(p, size - 1))
    steps = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j])
    at = pixels.withColumns({"__f": F.shiftright(p, 2 * order).cast("int"), "__x": x, "__y": y}).withColumn("__s", F.explode(steps))
    at = at.withColumns({"__u": F.col("__x") + F.col("__s.dx"), "__v": F.col("__y") + F.col("__s.dy")})
    side = lambda c: F.when(F.col(c) < 0, -1).when(F.col(c) >= n, 1).otherwise(0)
    at = at.withColumns({"__i": side("__u"), "__j": side("__v")})
    faces = F.array(*[F.array(*[F.lit(v).cast("int") for v in _BESIDE[i, j]]) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    at = at.withColumn("__g", F.get(F.get(faces, (F.col("__i") + 1) * 3 + F.col("__j") + 1), F.col("__f"))).where(F.col("__g").isNotNull())
    u, v, i, j = F.pmod(F.col("__u"), F.lit(n)), F.pmod(F.col("__v"), F.lit(n)), F.col("__i"), F.col("__j")
    north, south = F.col("__f") < 4, F.col("__f") >= 8
    # over a polar edge: the coordinate along the edge becomes the other axis, at its far (north) or near (south) end
    top, low = n - 1, 0
    g_x = F.when(north & (i == 1) & (j == 0), v).when(north & (i == 0) & (j == 1), F.lit(top)).when(north & (i == 1) & (j == 1), F.lit(top)).when(south & (i == -1) & (j == 0), v).when(south & (i == 0) & (j == -1), F.lit(low)).when(south & (i == -1) & (j == -1), F.lit(low)).otherwise(u)
    g_y = F.when(north & (i == 1) & (j == 0), F.lit(top)).when(north & (i == 0) & (j == 1), u).when(north & (i == 1) & (j == 1), F.lit(top)).when(south & (i == -1) & (j == 0), F.lit(low)).when(south & (i == 0) & (j == -1), u).when(south & (i == -1) & (j == -1), F.lit(low)).otherwise(v)
    return at.withColumn("neighbor", F.col("__g") * F.lit(size).cast("long") + morton(g_x, g_y)).select(*pixels.columns, "neighbor")
