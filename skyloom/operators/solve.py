"""Matching two lists of stars by their patterns, and the transforms between them, frame by frame.

Triangles, votes and normal equations are rows and sums; what is solved for a frame is a matrix of a few dozen numbers.
Hypotheses are scored where a frame's pairs are one row. Stars of a list should be its brightest few dozen: triangles
grow with the third power of their number.
"""

from __future__ import annotations

from functools import reduce
from operator import add, mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.operators.robust import medians
from skyloom.session import cut, dealt, written


def triangles(stars: DataFrame, by: list[str], star: str = "id", x: str = "x", y: str = "y", flat: float = 0.9, least: float = 1e-6) -> DataFrame:
    """(*by, a, b, c, length, ba, ca) of all triples of a list: the stars opposite the longest, middle and shortest side, the longest side, and the other two as shares of it. Triangles whose middle side is more than `flat` of the longest are left out: their order is uncertain."""
    one = lambda k: stars.select(*by, F.col(star).alias(f"s{k}"), F.col(x).cast("double").alias(f"x{k}"), F.col(y).cast("double").alias(f"y{k}"))
    three = one(1).join(one(2).hint("merge"), by).where("s1 < s2").join(one(3).hint("merge"), by).where("s2 < s3")  # merged: a table that looks small may have many rows once it is read
    side = lambda i, j, k: F.struct(F.sqrt((F.col(f"x{i}") - F.col(f"x{j}")) ** 2 + (F.col(f"y{i}") - F.col(f"y{j}")) ** 2).alias("d"), F.col(f"s{k}").alias("s"))
    sides = three.select(*by, F.array_sort(F.array(side(1, 2, 3), side(1, 3, 2), side(2, 3, 1))).alias("o"))
    out = sides.select(*by, F.col("o")[2]["s"].alias("a"), F.col("o")[1]["s"].alias("b"), F.col("o")[0]["s"].alias("c"), F.col("o")[2]["d"].alias("length"), F.col("o")[1]["d"].alias("mid"), F.col("o")[0]["d"].alias("short"))
    out = out.where(F.col("length") >= least).select(*by, "a", "b", "c", "length", (F.col("mid") / F.col("length")).alias("ba"), (F.col("short") / F.col("length")).alias("ca"))
    return out.where(F.col("ba") <= flat)


def votes(left: DataFrame, right: DataFrame, by: list[str], tolerance: float = 0.002, scale: tuple[float, float] | None = None) -> DataFrame:
    """(*by, u, w, votes): how many pairs of like triangles set star u of the left list beside star w of the right one. Shapes are like within tolerance, and, with scale, where the ratio of their longest sides lies in it. The join is on cells of shapes eight tolerances wide; on the left side a shape near a border takes the cell beyond it too."""
    wide, reach = 8 * tolerance, tolerance * (1 + 1e-9)
    cell = lambda c, off=0.0: F.floor((F.col(c) + off) / wide)
    near = lambda c: F.explode(F.sequence(cell(c, -reach), cell(c, reach)))
    a = left.withColumn("__p", near("ba")).withColumn("__q", near("ca"))
    b = right.withColumns({"__p": cell("ba"), "__q": cell("ca")}).withColumnsRenamed({c: f"{c}2" for c in ("a", "b", "c", "length", "ba", "ca")})
    met = a.join(b, [*by, "__p", "__q"]).where((F.col("ba") - F.col("ba2")) ** 2 + (F.col("ca") - F.col("ca2")) ** 2 < tolerance**2)
    if scale:
        met = met.where((F.col("length") / F.col("length2")).between(*scale))
    pair = lambda c: F.struct(F.col(c).alias("u"), F.col(f"{c}2").alias("w"))
    return met.select(*by, F.explode(F.array(pair("a"), pair("b"), pair("c"))).alias("p")).groupBy(*by, "p.u", "p.w").agg(F.count("*").alias("votes"))


def consensus(voted: DataFrame, by: list[str], least: int = 2) -> DataFrame:
    """The pairs of at least `least` votes of which each star is the other's first choice; equal votes go to the smaller star."""
    best = voted.where(F.col("votes") >= least)
    for key, other in (("u", "w"), ("w", "u")):
        best = best.withColumn(f"__r{key}", F.row_number().over(Window.partitionBy(*by, key).orderBy(F.desc("votes"), other)))
    return best.where("__ru = 1 and __rw = 1").drop("__ru", "__rw")


def likely(voted: DataFrame, by: list[str], least: int = 2, share: float = 0.5) -> DataFrame:
    """The pairs of at least `least` votes that have `share` of both stars' most votes. In a list that looks alike when turned, a star's true pair and its mirrored one have about equal votes, and first choices would mix both."""
    best = lambda key: F.max("votes").over(Window.partitionBy(*by, key))
    return voted.where(F.col("votes") >= least).withColumns({"__u": best("u"), "__w": best("w")}).where(F.col("votes") >= share * F.greatest("__u", "__w")).drop("__u", "__w")


def similarity(pairs: DataFrame, by: list[str], x: str = "x", y: str = "y", x2: str = "x2", y2: str = "y2") -> DataFrame:
    """(*by, scale, theta, tx, ty, n): the least-squares turn, scale and shift from (x, y) to (x2, y2) of each frame, by centred sums; null for fewer than two pairs or pairs at one place."""
    dot = F.covar_pop(x, x2) + F.covar_pop(y, y2)
    cross = F.covar_pop(x, y2) - F.covar_pop(y, x2)
    sums = pairs.groupBy(*by).agg(dot.alias("__d"), cross.alias("__c"), (F.var_pop(x) + F.var_pop(y)).alias("__v"), *[F.avg(c).alias(f"__{c}") for c in (x, y, x2, y2)], F.count("*").alias("n"))
    good = (F.col("n") >= 2) & (F.col("__v") >= 1e-15)
    size = F.when(good, F.col("__v"))
    a, b = F.col("__d") / size, F.col("__c") / size
    put = lambda v: F.when(good, v)
    return sums.select(
        *by, put(F.hypot(a, b)).alias("scale"), put(F.atan2(b, a)).alias("theta"), put(F.col(f"__{x2}") - a * F.col(f"__{x}") + b * F.col(f"__{y}")).alias("tx"),
        put(F.col(f"__{y2}") - b * F.col(f"__{x}") - a * F.col(f"__{y}")).alias("ty"), "n")


def residual(a: Column, b: Column, tx: Column, ty: Column) -> Column:
    """How far (x, y) lands from (x2, y2) under x2 = a x - b y + tx, y2 = b x + a y + ty."""
    return F.hypot(a * F.col("x") - b * F.col("y") + tx - F.col("x2"), b * F.col("x") + a * F.col("y") + ty - F.col("y2"))


def _draws(n: int):
    """draw(k, m) of the hypotheses k to k + m of n pairs, in an order that depends on n alone: all of them once, or of very long lists any two pairs."""
    rng = np.random.default_rng(n)
    if n > 1500:
        return lambda k, m: (i := rng.integers(n, size=m), (i + 1 + rng.integers(n - 1, size=m)) % n)
    order = rng.permutation(n * (n - 1) // 2)
    i, j = (c[order] for c in np.triu_indices(n, 1))
    return lambda k, m: (i[k : k + m], j[k : k + m])


def _best(x: np.ndarray, y: np.ndarray, x2: np.ndarray, y2: np.ndarray, tau: float, tries: int, apart: float, missed: float) -> tuple[float, ...] | None:
    """(a, b, tx, ty) of the hypothesis with most pairs within tau, the least residual, the least turn. Hypotheses are drawn until one with more pairs has gone by with a chance of `missed` at most, or there is none left."""
    n, k, best, found = len(x), 0, None, None
    need = every = n * (n - 1) // 2
    draw = _draws(n) if every else None
    while k < need:
        m = min(need - k, max(1, (1 << 18) // n))
        i, j = draw(k, m)
        dx, dy, dx2, dy2 = x[j] - x[i], y[j] - y[i], x2[j] - x2[i], y2[j] - y2[i]
        far = np.flatnonzero((np.hypot(dx, dy) >= apart) & (np.hypot(dx2, dy2) >= apart))
        i, dx, dy, dx2, dy2 = i[far], dx[far], dy[far], dx2[far], dy2[far]
        size = dx * dx + dy * dy
        a, b = (dx * dx2 + dy * dy2) / size, (dx * dy2 - dy * dx2) / size
        tx, ty = x2[i] - a * x[i] + b * y[i], y2[i] - b * x[i] - a * y[i]
        square = (a[:, None] * x - b[:, None] * y + tx[:, None] - x2) ** 2 + (b[:, None] * x + a[:, None] * y + ty[:, None] - y2) ** 2
        near = square < tau * tau
        count = near.sum(axis=1)
        most = int(count.max(initial=0))
        if most and (best is None or most >= -best[0]):
            top = np.flatnonzero(count == most)
            rest, turn = np.round(np.where(near[top], square[top], 0.0).sum(axis=1), 9), np.round(np.abs(np.arctan2(b[top], a[top])), 6)
            first = np.lexsort((far[top], turn, rest))[0]
            own = (-most, float(rest[first]), float(turn[first]), k + int(far[top[first]]))
            if best is None or own < best:
                best, found = own, tuple(float(c[top[first]]) for c in (a, b, tx, ty))
        k += m
        if best is not None and every > tries:
            share = max(most, -best[0]) * (max(most, -best[0]) - 1) / (n * (n - 1))
            need = every if share <= 0 else tries if share >= 1 else min(every, max(tries, int(np.ceil(np.log(missed) / np.log1p(-share)))))
    return found


def consistent(pairs: DataFrame, by: list[str], tau: float, tries: int = 100, refits: int = 3, least: int = 4, apart: float = 1e-6, missed: float = 1e-9) -> tuple[DataFrame, DataFrame]:
    """(transforms as similarity gives them, with rms; the pairs within tau of them) of frames with wrong pairs among (*by, u, w, x, y, x2, y2).

    Two pairs make a hypothesis; a frame's are scored in one task, where its pairs are a row, at least `tries` of them and as
    many as it takes: all, or so many that one with more pairs is missed with a chance of `missed` at most. The one with
    most pairs within tau, of these the least residual, and of these the least turn, is refitted on its pairs.
    Frames with fewer than `least` such pairs are left out. Results don't depend on how rows were dealt.
    """
    rows = cut(pairs)
    held = rows.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("u", "w", *[F.col(c).cast("double").alias(c) for c in ("x", "y", "x2", "y2")]))).alias("__p")).where(F.size("__p") >= 2)
    held = held.select(*by, *[F.col(f"__p.{c}").alias(f"__{c}") for c in ("x", "y", "x2", "y2")])

    def run(batches):
        for b in batches:
            lists = [b.column(len(by) + k) for k in range(4)]
            off = lists[0].offsets.to_numpy()
            flat = [c.values.to_numpy(zero_copy_only=False) for c in lists]
            got = [_best(*[c[i:j] for c in flat], tau, tries, apart, missed) for i, j in zip(off[:-1], off[1:], strict=True)]
            own = pa.array([k for k, t in enumerate(got) if t is not None], pa.int64())
            yield pa.record_batch([*[b.column(k).take(own) for k in range(len(by))], *[pa.array([t[k] for t in got if t is not None], pa.float64()) for k in range(4)]], names)

    names = [*by, "__a", "__b", "__tx", "__ty"]
    a, b = F.col("__a"), F.col("__b")
    now = cut(held.mapInArrow(run, T.StructType([*held.schema.fields[: len(by)], *[T.StructField(c, T.DoubleType()) for c in names[len(by) :]]])))
    for _ in range(refits):
        near = rows.join(now, by).where(residual(a, b, F.col("__tx"), F.col("__ty")) < tau)
        fit = similarity(near, by).where(F.col("scale").isNotNull() & (F.col("n") >= least))
        now = cut(fit.select(*by, (F.col("scale") * F.cos("theta")).alias("__a"), (F.col("scale") * F.sin("theta")).alias("__b"), F.col("tx").alias("__tx"), F.col("ty").alias("__ty")))
    kept = cut(rows.join(now, by).withColumn("residual", residual(a, b, F.col("__tx"), F.col("__ty"))).where(F.col("residual") < tau).drop("__a", "__b", "__tx", "__ty"))
    rms = kept.groupBy(*by).agg(F.sqrt(F.avg(F.col("residual") ** 2)).alias("rms"))
    return similarity(kept, by).where(F.col("n") >= least).join(rms, by), kept


def polynomial_terms(order: int) -> list[tuple[int, int]]:
    """Powers (p, q) of x and y up to p + q = order."""
    return [(p, n - p) for n in range(order + 1) for p in range(n, -1, -1)]


def polynomial_fit(rows: DataFrame, by: list[str], targets: list[str], order: int, rounds: int = 5, delta: float = 1.345, x: str = "x", y: str = "y") -> DataFrame:
    """(*by, target, coefficients, sigma, n): for each of targets the polynomial in x and y whose coefficients stand in the order of polynomial_terms, fitted by Huber-weighted least squares.

    Each round sums the weighted products of all pairs of terms over a frame's rows, and solves one small system a frame.
    The scale of residuals is 1.4826 times their median absolute value. Coordinates count in units of their greatest
    absolute value meanwhile. Frames with fewer rows than terms are left out, and so are rows with a null.
    Rows are dealt over all tasks and written once, without their terms, and not shuffled again: what is known of frames is small enough to go to them.
    """
    terms = polynomial_terms(order)
    t = len(terms)
    good = rows.where(F.col(x).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(x).cast("double").alias("__x"), F.col(y).cast("double").alias("__y"), *[F.col(c).cast("double").alias(f"__t{k}") for k, c in enumerate(targets)])
    good = written(dealt(good))
    unit = written(good.groupBy(*by).agg(F.greatest(F.max(F.abs("__x")), F.max(F.abs("__y")), F.lit(1e-300)).alias("__u")))
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("target"), F.col(f"__t{k}").alias("v")) for k, c in enumerate(targets)]))
    at = good.join(unit, by).select(*by, "__u", (F.col("__x") / F.col("__u")).alias("__x"), (F.col("__y") / F.col("__u")).alias("__y"), each.alias("__t"))
    power = lambda c, n: reduce(mul, [F.col(c)] * n, F.lit(1.0))
    at = at.where(F.col("__t.v").isNotNull()).select(*by, "__u", F.col("__t.target").alias("target"), F.col("__t.v").alias("__v"), *[(power("__x", p) * power("__y", q)).alias(f"__m{i}") for i, (p, q) in enumerate(terms)])
    key, weighted, m = [*by, "target"], at.withColumn("__w", F.lit(1.0)), [F.col(f"__m{i}") for i in range(t)]

    @F.arrow_udf("array<double>")
    def solved(normal: pa.Array, right: pa.Array) -> pa.Array:
        a = normal.flatten().to_numpy(zero_copy_only=False).reshape(-1, t * (t + 1) // 2)
        whole = np.zeros((len(a), t, t))
        i, j = np.triu_indices(t)
        whole[:, i, j] = whole[:, j, i] = a
        r = right.flatten().to_numpy(zero_copy_only=False).reshape(-1, t)
        out = np.stack([np.linalg.lstsq(m, v, rcond=1e-14)[0] for m, v in zip(whole, r, strict=True)]) if len(a) else np.zeros((0, t))
        return pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1, dtype=np.int32) * t), pa.array(out.ravel()))

    for k in range(rounds + 1):
        w = F.col("__w")
        sums = weighted.groupBy(*key).agg(F.array(*[F.sum(w * m[i] * m[j]) for i in range(t) for j in range(i, t)]).alias("__n"), F.array(*[F.sum(w * m[i] * F.col("__v")) for i in range(t)]).alias("__r"), F.count("*").alias("n"), F.first("__u").alias("__u")).where(F.col("n") >= t)
        found = written(sums.select(*key, "n", "__u", solved("__n", "__r").alias("__c")))
        rest = at.join(found.drop("n", "__u"), key).withColumn("__e", F.col("__v") - reduce(add, [m[i] * F.col("__c")[i] for i in range(t)]))
        spread = written(medians(rest.select(*key, F.abs("__e").alias("__e")), key, "__e", "sigma").withColumn("sigma", F.col("sigma") * 1.4826))
        if k < rounds:
            z = F.abs("__e") / F.col("sigma")
            weighted = rest.join(spread, key).withColumn("__w", F.when((F.col("sigma") <= 1e-12) | (z <= delta), 1.0).otherwise(delta / z))
    back = F.zip_with("__c", F.array(*[F.lit(p + q) for p, q in terms]), lambda c, n: c / F.pow(F.col("__u"), n))
    return found.join(spread, key).select(*key, back.alias("coefficients"), "sigma", "n")
