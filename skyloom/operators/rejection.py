"""Outlier rejection in stacks of samples, one stack for each sky pixel.

A stack is array<struct<ord, v>>, sorted by ord, so results don't depend on how rows were dealt. Methods without
iteration are column expressions. The iterative ones work on whole Arrow batches: stacks are laid into one matrix of
samples with a mask, and each round of all stacks is a few numpy calls.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.operators.chauvenet import survivors

# Fixed values.
ACCEPTED, LOW, HIGH, UNDERDETERMINED = 0, 1, 2, 3
OK, MIN_SAMPLES, ALL_REJECTED, INVALID_INPUT, SHALLOW = "ok", "min_samples", "all_rejected", "invalid_input", "underdetermined"
INVALID_METHOD, INVALID_CONFIGURATION = "invalid_method", "invalid_configuration"
CENTRE, SCALE, RAW = "median_center", "median_scale", "none"
MINIMUM = {"none": 0, "percentile": 2, "linear": 4, "sigma": 3, "winsorized": 3, "averaged": 3, "esd": 3, "median_sigma": 3, "minmax": 3, "rcr": 3}
DECISION = "struct<reasons:array<tinyint>,accepted:int,rejected_low:int,rejected_high:int,iterations:int,status:string>"
_DECISION_ARROW = pa.struct([("reasons", pa.list_(pa.int8())), ("accepted", pa.int32()), ("rejected_low", pa.int32()), ("rejected_high", pa.int32()), ("iterations", pa.int32()), ("status", pa.string())])


def stacks(samples: DataFrame, by: list[str], order: list[str], value: str, **carried: str) -> DataFrame:
    """(*by, stack): samples of each pixel in a total order, as array<struct<ord, v, …>>. A stack is as deep as the pixel has frames."""
    extra = [F.col(c).alias(n) for n, c in carried.items()]
    row = F.struct(F.struct(*order).alias("o"), F.col(value).alias("v"), *extra)
    listed = samples.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("s"))
    names = ["v", *carried]
    return listed.select(*by, F.transform("s", lambda x, i: F.struct((i + 1).alias("ord"), *[x[n].alias(n) for n in names])).alias("stack"))


def bags(samples: DataFrame, by: list[str], value: str, **carried: str) -> DataFrame:
    """(*by, stack): as stacks, but in the order of values, for what doesn't depend on the samples' order; only these columns are shuffled."""
    row = F.struct(F.col(value).alias("v"), *[F.col(c).alias(n) for n, c in carried.items()])
    return samples.groupBy(*by).agg(F.array_sort(F.collect_list(row)).alias("stack"))


def let(value: Column, body) -> Column:
    """body(value), with value computed once a row."""
    return F.get(F.transform(F.array(value), body), 0)


def middle(s: Column) -> Column:
    """The median of a sorted array; 0 of an empty one."""
    n = F.size(s)
    low, high = F.get(s, F.floor((n - 1) / 2).cast("int")), F.get(s, F.floor(n / 2).cast("int"))
    return F.when(n == 0, F.lit(0.0)).otherwise((low + high) / 2)


def median(values: Column) -> Column:
    """Of an array; the mean of the two middle values at even size, 0 of an empty one."""
    return let(F.array_sort(values), middle)


def upper_median(values: Column) -> Column:
    return F.get(F.array_sort(values), F.floor(F.size(values) / 2).cast("int"))


def contract(values: Column, reasons: Column, minimum: int) -> Column:
    """reasons as a stack may give them: all UNDERDETERMINED, which counts as accepted, for a sample that isn't finite, for two samples or fewer, for fewer than minimum, and where all of up to four would go."""
    from skyloom.functions.frames import finite

    n = F.size(values)
    none_left = F.forall(reasons, lambda r: (r == LOW) | (r == HIGH))
    spared = (n <= 2) | (n < minimum) | ((n <= 4) & none_left) | F.exists(values, lambda v: ~finite(v))
    return F.when(spared, F.transform(reasons, lambda _: F.lit(UNDERDETERMINED).cast("tinyint"))).otherwise(reasons)


def percentile_reasons(stack: Column, low: float = 0.2, high: float = 0.1, in_order: bool = False) -> Column:
    """Single pass about the median, in shares of its absolute value. in_order: the stack is sorted by value."""

    def of(values: Column, mid: Column) -> Column:
        code = lambda m: lambda v: F.when(v - m < -F.abs(m) * low, LOW).when(v - m > F.abs(m) * high, HIGH).otherwise(ACCEPTED).cast("tinyint")
        return let(mid, lambda m: let(F.transform(values, code(m)), lambda r: contract(values, r, MINIMUM["percentile"])))

    return let(F.transform(stack, lambda x: x["v"]), lambda v: of(v, middle(v) if in_order else median(v)))


def minmax_reasons(stack: Column, low: int = 1, high: int = 1, min_kept: int = 4) -> Column:
    """Drop the `low` lowest and `high` highest by rank; equal values rank by ord. Underdetermined where fewer than min_kept would stay."""
    n = F.size(stack)
    ranked = F.transform(F.array_sort(F.transform(stack, lambda x: F.struct(x["v"].alias("v"), x["ord"].alias("ord")))), lambda x: x["ord"])
    bottom, top = F.slice(ranked, 1, low), F.slice(ranked, F.greatest(n - high + 1, F.lit(1)), high)
    reason = F.transform(stack, lambda x: F.when(F.array_contains(bottom, x["ord"]), LOW).when(F.array_contains(top, x["ord"]), HIGH).otherwise(ACCEPTED).cast("tinyint"))
    fewer = F.when(n - low - high < min_kept, F.transform(stack, lambda x: F.lit(UNDERDETERMINED).cast("tinyint"))).otherwise(reason)
    return contract(F.transform(stack, lambda x: x["v"]), fewer, MINIMUM["minmax"])


def auto_method(depth: Column) -> Column:
    return F.when(depth < 6, "percentile").when(depth <= 15, "winsorized").otherwise("linear")


class _Batch:
    """Samples of stacks as a matrix; `alive` marks those that are still accepted."""

    def __init__(self, lengths: np.ndarray, flat: np.ndarray):
        self.n = lengths
        self.v = np.full((len(lengths), max(1, int(lengths.max(initial=0)))), np.nan)
        self.there = np.arange(self.v.shape[1]) < lengths[:, None]
        self.v[self.there] = flat
        self.alive = self.there.copy()
        self.centre = np.zeros(len(lengths))
        self.iterations = np.zeros(len(lengths), np.int32)
        self.open = np.ones(len(lengths), bool)

    def median(self, of: np.ndarray, mask: np.ndarray) -> np.ndarray:
        s = np.sort(np.where(mask, of, np.inf), axis=1)
        k = np.maximum(mask.sum(axis=1), 1)
        row = np.arange(len(s))
        return (s[row, (k - 1) // 2] + s[row, k // 2]) / 2

    def sums(self, of: np.ndarray) -> np.ndarray:
        return np.where(self.alive, of, 0.0).sum(axis=1)

    def drop(self, out: np.ndarray, room: np.ndarray | None = None) -> None:
        """Reject `out` in open stacks, of each at most `room` in the order of columns; stacks without change close."""
        out = out & self.alive & self.open[:, None]
        if room is not None:
            out &= np.cumsum(out, axis=1) <= room[:, None]
        changed = out.any(axis=1)
        self.alive &= ~out
        self.iterations += changed
        self.open &= changed

    def close(self, where: np.ndarray) -> None:
        self.open &= ~where


def _clip(b: _Batch, spread, centre, guard: bool, lower: float, upper: float, rounds: int) -> None:
    removed = np.zeros(len(b.n), np.int64)
    for _ in range(rounds):
        count = b.alive.sum(axis=1)
        b.close(count < 2)
        if not b.open.any():
            return
        c = centre(b, count)
        b.centre = np.where(b.open, c, b.centre)
        s, usable = spread(b, c, count)
        b.close(~usable)
        with np.errstate(invalid="ignore", divide="ignore"):
            z = (b.v - c[:, None]) / s[:, None]
        before = b.alive.sum(axis=1)
        b.drop((z < -lower) | (z > upper), np.maximum(0, count - 4 - removed) if guard else None)
        removed += before - b.alive.sum(axis=1)


def _mean(b: _Batch, count: np.ndarray) -> np.ndarray:
    return b.sums(b.v) / np.maximum(count, 1)


def _about(b: _Batch, c: np.ndarray, count: np.ndarray, v: np.ndarray | None = None) -> np.ndarray:
    with np.errstate(invalid="ignore"):  # samples that have gone may be infinite
        d = (b.v if v is None else v) - c[:, None]
    return np.sqrt(b.sums(d * d) / np.maximum(count - 1, 1))


def _winsorized_spread(b: _Batch, c: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sigma = _about(b, c, count)
    usable, moving = sigma > 1e-12, np.ones(len(sigma), bool)
    for _ in range(64):
        inside = np.clip(b.v, (c - 1.5 * sigma)[:, None], (c + 1.5 * sigma)[:, None])
        new = 1.134 * _about(b, c, count, inside)
        near = np.abs(new - sigma) <= 5e-4 * sigma
        sigma = np.where(moving, new, sigma)
        moving &= ~near
        if not moving.any():
            break
    return sigma, usable  # the first spread decides; one that has collapsed since leaves the centre alone


def _wide(spread):
    """A spread that is usable from 1e-12 on."""

    def of(b: _Batch, c: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        s = spread(b, c, count)
        return s, s > 1e-12

    return of


def _by_side(b: _Batch, centre: np.ndarray) -> np.ndarray:
    return np.where(b.alive | ~b.there, ACCEPTED, np.where(b.v < centre[:, None], LOW, HIGH))


def _linear(b: _Batch, lower: float = 5.0, upper: float = 3.5, rounds: int = 8) -> np.ndarray:
    """Values against ranks. The moments of the ranks stay those of the whole stack after samples have gone."""
    order = np.argsort(np.where(b.there, b.v, np.inf), axis=1, kind="stable")
    v = np.take_along_axis(b.v, order, axis=1)
    alive, reason = np.take_along_axis(b.there, order, axis=1), np.zeros(v.shape, np.int8)
    mx, dx2 = (b.n - 1) / 2, (b.n.astype(float) ** 2 - 1) / 12
    removed = np.zeros(len(b.n), np.int64)
    for _ in range(rounds):
        count = alive.sum(axis=1)
        b.close(count < 4)
        if not b.open.any():
            break
        rank = np.cumsum(alive, axis=1) - 1
        some = np.maximum(count, 1)
        my = np.where(alive, v, 0.0).sum(axis=1) / some
        slope = np.where(alive, (rank - mx[:, None]) * (v - my[:, None]), 0.0).sum(axis=1) / some / np.where(dx2 > 0, dx2, 1.0)
        rest = v - (slope[:, None] * rank + (my - mx * slope)[:, None])
        sigma = np.where(alive, np.abs(rest), 0.0).sum(axis=1) / some
        low, high = -rest > (sigma * lower)[:, None], rest > (sigma * upper)[:, None]
        out = (low | high) & alive & b.open[:, None]
        out &= np.cumsum(out, axis=1) <= np.maximum(0, count - removed - 4)[:, None]
        reason[out & low], reason[out & ~low] = LOW, HIGH
        alive &= ~out
        removed += out.sum(axis=1)
        changed = out.any(axis=1)
        b.iterations += changed
        b.open &= changed
    back = np.zeros_like(reason)
    np.put_along_axis(back, order, reason, axis=1)
    return back


def _incomplete_beta(a: float, b: float, x: float) -> float:
    """Regularised, by Lentz's continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _incomplete_beta(b, a, 1 - x)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d, f = 1.0, 0.0, 1.0
    for i in range(400):
        m = i // 2
        num = 1.0 if i == 0 else m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)) if i % 2 == 0 else -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        d = 1 / ((1 + num * d) or 1e-300)
        c = (1 + num / c) or 1e-300
        f *= c * d
        if abs(1 - c * d) < 1e-14:
            break
    return front * (f - 1)


def t_cdf(t: float, nu: float) -> float:
    tail = 0.5 * _incomplete_beta(nu / 2, 0.5, nu / (nu + t * t))
    return 1 - tail if t > 0 else tail


def t_quantile(p: float, nu: float) -> float:
    """For p of at least a half, by bisection on 0..40."""
    if p <= 0:
        return 0.0
    if p >= 1:
        return 40.0
    low, high = 0.0, 40.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if t_cdf(mid, nu) < p else (low, mid)
    return (low + high) / 2


@lru_cache(maxsize=4096)
def esd_critical(n: int, i: int, alpha: float = 0.05) -> float:
    """The bound of the i-th deviation, from 1, of n samples."""
    left, nu = n - i, n - i - 1
    t = t_quantile(1 - alpha / (2 * (left + 1)), nu)
    return t * left / math.sqrt((nu + t * t) * (left + 1))


def _esd(b: _Batch, most: int = 10, alpha: float = 0.05) -> np.ndarray:
    """Generalised extreme studentized deviate; of equal deviations the earlier sample counts."""
    row = np.arange(len(b.n))
    turn = np.full(b.v.shape, most + 1)
    passed = np.zeros(len(b.n), np.int64)
    for i in range(1, most + 1):
        count = b.alive.sum(axis=1)
        b.close(count < 3)
        c = _mean(b, count)
        s = _about(b, c, count)
        b.close(~(s > 1e-12))
        if not b.open.any():
            break
        r = np.where(b.alive, np.abs(b.v - c[:, None]) / np.where(s > 1e-12, s, 1.0)[:, None], -1.0)
        worst = (r >= r.max(axis=1, keepdims=True) - 1e-15).argmax(axis=1)
        bound = np.array([esd_critical(int(n), i, alpha) if o else np.inf for n, o in zip(b.n, b.open, strict=True)])
        passed = np.where(b.open & (r[row, worst] > bound), i, passed)
        turn[row[b.open], worst[b.open]] = i
        b.alive[row[b.open], worst[b.open]] = False
    b.iterations = passed.astype(np.int32)
    b.alive = b.there & (turn > passed[:, None])
    return _by_side(b, b.median(b.v, b.there))


def _auto(lengths: np.ndarray, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """decide by the method that suits each stack's depth."""
    owner = np.repeat(np.arange(len(lengths)), lengths)
    kind = np.where(lengths < 6, 0, np.where(lengths <= 15, 1, 2))
    reasons, iterations, status = np.zeros(len(flat), np.int8), np.zeros(len(lengths), np.int32), np.full(len(lengths), OK, object)
    for k, method in enumerate(("percentile", "winsorized", "linear")):
        if (kind == k).any():
            r, i, s = decide(method, lengths[kind == k], flat[kind[owner] == k])
            reasons[kind[owner] == k], iterations[kind == k], status[kind == k] = r, i, s
    return reasons, iterations, status.tolist()


def _percentile(b: _Batch, centre: np.ndarray, low: float = 0.2, high: float = 0.1) -> np.ndarray:
    """b holds values less their median, centre the medians."""
    m = np.abs(centre)[:, None]
    return np.where(b.v < -m * low, LOW, np.where(b.v > m * high, HIGH, ACCEPTED))


def decide(method: str, lengths: np.ndarray, flat: np.ndarray, lower: float = 4.0, upper: float = 3.0, rounds: int = 8, normalization: str = CENTRE, scale_floor: float = 1e-12) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Reasons of all samples, iterations and status of each stack; "auto" takes the method by the stack's depth.

    Nothing is rejected, and all reasons are UNDERDETERMINED, for an unknown method, a sample that isn't finite, a
    percentile rule without centring or a Chauvenet one with normalization, two samples or fewer or fewer than the method needs, and where all of up to four
    samples would go. Decisions are made on the values less their median, over its absolute value, or as they are.
    """
    if method == "auto":
        return _auto(lengths, flat)
    spared = INVALID_METHOD if method not in MINIMUM or normalization not in (CENTRE, SCALE, RAW) else None
    bad = np.zeros(len(lengths), bool)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    bad[owner[~np.isfinite(flat)]] = True
    if method == "percentile" and normalization != CENTRE or method == "rcr" and normalization != RAW:
        spared = INVALID_CONFIGURATION
    if spared:
        first = (lambda x, n: MIN_SAMPLES if n == 0 else INVALID_INPUT if x else spared) if spared == INVALID_CONFIGURATION else (lambda x, n: spared)
        return np.full(len(flat), UNDERDETERMINED, np.int8), np.zeros(len(lengths), np.int32), [first(x, n) for x, n in zip(bad, lengths, strict=True)]
    shallow = (lengths <= 2) | (lengths < MINIMUM[method])
    b = _Batch(lengths, np.where(bad[owner], 0.0, flat))
    centre = np.where(lengths > 0, b.median(b.v, b.there), 0.0)
    if normalization == CENTRE:
        b.v -= centre[:, None]
    elif normalization == SCALE:
        b.v /= np.maximum(np.abs(centre), scale_floor)[:, None]
    b.v[~b.there] = 0.0
    b.close(bad | shallow)
    if method == "sigma":
        _clip(b, _wide(lambda x, c, n: 1.4826 * x.median(np.abs(x.v - c[:, None]), x.alive)), lambda x, n: x.median(x.v, x.alive), False, lower, upper, rounds)
    elif method == "averaged":
        _clip(b, _wide(lambda x, c, n: x.sums(np.abs(x.v - c[:, None])) / np.maximum(n, 1) * math.sqrt(math.pi / 2)), _mean, False, lower, upper, rounds)
    elif method == "median_sigma":
        _clip(b, _wide(_about), lambda x, n: x.median(x.v, x.alive), True, lower, upper, rounds)
    elif method == "winsorized":
        _clip(b, _winsorized_spread, lambda x, n: x.median(x.v, x.alive), True, lower, upper, rounds)
    if method == "linear":
        reason = _linear(b)
    elif method == "esd":
        reason = _esd(b)
    elif method == "percentile":
        reason = _percentile(b, centre)
    elif method == "minmax":
        reason = _minmax(b, lengths, flat)
    elif method == "rcr":
        reason = _rcr(b)
    else:
        reason = _by_side(b, b.centre)
    some = (reason == UNDERDETERMINED).any(axis=1)
    left = np.isin(reason, (ACCEPTED, UNDERDETERMINED)) & b.there
    none = ~left.any(axis=1) & (lengths > 0)
    flip = none & (lengths <= 4)
    reason = np.where((bad | shallow | flip)[:, None], UNDERDETERMINED, reason)
    status = [MIN_SAMPLES if n == 0 else INVALID_INPUT if x else SHALLOW if s or f else ALL_REJECTED if r else OK for x, n, s, f, r in zip(bad, lengths, shallow | some, flip, none, strict=True)]
    return reason[b.there].astype(np.int8), b.iterations, status


def _rcr(b: _Batch) -> np.ndarray:
    """Sequential robust Chauvenet; the three passes count as iterations."""
    b.alive = np.where(b.open[:, None], survivors(b.v, b.there & b.open[:, None]), b.there)
    b.iterations = np.where(b.open, 3, 0).astype(np.int32)
    return _by_side(b, b.median(b.v, b.there))


def _minmax(b: _Batch, lengths: np.ndarray, flat: np.ndarray, low: int = 1, high: int = 1, min_kept: int = 4) -> np.ndarray:
    """By rank of the values as they came; equal ones rank by their place."""
    raw = np.full(b.v.shape, np.inf)
    raw[b.there] = np.where(np.isfinite(flat), flat, 0.0)
    rank = np.argsort(np.argsort(raw, axis=1, kind="stable"), axis=1)
    out = np.where(rank < low, LOW, np.where(rank >= (lengths - high)[:, None], HIGH, ACCEPTED))
    return np.where((lengths - low - high < min_kept)[:, None], UNDERDETERMINED, out)


def rejection(method: str, values: Column, normalization: str | None = None) -> Column:
    """DECISION of an array of doubles in sample order, by any method or "auto". normalization: none for rcr, the median's else."""
    chosen = normalization or (RAW if method == "rcr" else CENTRE)

    @F.arrow_udf(DECISION)
    def run(column: pa.Array) -> pa.Array:
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        offsets = np.asarray(column.offsets)
        flat = column.values.slice(offsets[0], offsets[-1] - offsets[0]).to_numpy(zero_copy_only=False).astype(float)
        n = np.diff(offsets).astype(np.int64)
        reason, iterations, status = decide(method, n, flat, normalization=chosen)
        owner = np.repeat(np.arange(len(n)), n)
        count = lambda codes: pa.array(np.bincount(owner, np.isin(reason, codes), len(n)).astype(np.int32))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(reason))
        parts = [lists, count([ACCEPTED, UNDERDETERMINED]), count([LOW]), count([HIGH]), pa.array(iterations.astype(np.int32)), pa.array(status)]
        return pa.StructArray.from_arrays(parts, fields=list(_DECISION_ARROW))

    return run(F.coalesce(values, F.array().cast("array<double>")))


def integrate(stack: Column, reasons: Column) -> Column:
    """struct(signal, support, n_used, n_candidates, n_accepted, status) of array<struct<ord, v, w, sup>> and its reasons.

    status: 1 no samples; 4 an accepted sample has a value that isn't finite, a support that isn't positive or a weight
    that isn't finite or is negative; 2 none accepted; 3 no positive weight; 0 else. Only then there is a signal.
    """
    from skyloom.functions.frames import finite

    zero = F.struct(F.lit(False).alias("bad"), F.lit(0).alias("good"), F.lit(0).alias("used"), F.lit(0.0).alias("w"), F.lit(0.0).alias("wv"), F.lit(float("-inf")).alias("sup"))

    def add(a: Column, x: Column) -> Column:
        wrong = ~finite(x["v"]) | ~finite(x["sup"]) | (x["sup"] <= 0) | ~finite(x["w"]) | (x["w"] < 0)
        counts = x["w"] > 0
        some = F.struct(
            (a["bad"] | wrong).alias("bad"), (a["good"] + 1).alias("good"), (a["used"] + counts.cast("int")).alias("used"), F.when(counts, a["w"] + x["w"]).otherwise(a["w"]).alias("w"),
            F.when(counts, a["wv"] + x["w"] * x["v"]).otherwise(a["wv"]).alias("wv"), F.greatest(a["sup"], x["sup"]).alias("sup"))
        return F.when(x["r"].isin(ACCEPTED, UNDERDETERMINED), some).otherwise(a)

    def told(a: Column) -> Column:
        status = F.when(F.size(stack) == 0, 1).when(a["bad"], 4).when(a["used"] > 0, 0).when(a["good"] == 0, 2).otherwise(3)
        ok = status == 0
        return F.struct(
            F.when(ok, a["wv"] / a["w"]).alias("signal"), F.when(ok, a["sup"]).alias("support"), F.when(ok, a["used"]).otherwise(0).alias("n_used"),
            F.size(stack).alias("n_candidates"), a["good"].alias("n_accepted"), status.alias("status"))

    one = lambda s, r: F.struct(s["v"].cast("double").alias("v"), s["w"].cast("double").alias("w"), s["sup"].cast("double").alias("sup"), r.alias("r"))
    return let(F.aggregate(F.zip_with(stack, reasons, one), zero, add), told)
