"""Sequential robust Chauvenet rejection (Maples et al. 2018, arXiv:1807.05276), for whole batches of stacks.

Three passes go from robust to precise: median and the slope of a broken line, median and the 68th percentile, mean and
standard deviation. A pass rejects one sample a step, the one farthest from the centre, while a sample so far out is
expected less than half a time. All stacks of a batch step together; those that have ended leave the matrix.

The line fits sorted deviations against the deviates that a normal distribution would give them; its break separates the
core from the outskirts. Scales are divided by what they give on normal samples of that size, and a break counts only
beyond the improvement that it brings on normal samples; both were found by simulation, `simulated`.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

CORE = 0.682689  # the share of a normal distribution within one standard deviation
PASSES = (("median", "line"), ("median", "percentile"), ("mean", "deviation"))

# Found by simulated(range(2, 41), seed=1, draws=100_000): the mean scale of normal samples of n = 2 ... 8, and the improvement
# by a break for n = 4 ... 40. The laws fit sizes beyond, up to 300; that of the scale fits even sizes, and serves odd ones too.
UNITY = (0.5637, 0.5132, 0.5635, 0.5424, 0.6415, 0.6898, 0.6968)
BREAK = (
    2.208, 8.414, 2.71, 3.456, 2.333, 2.905, 2.431, 2.774, 2.347, 2.497, 2.306, 2.407, 2.208, 2.323, 2.19, 2.217, 2.154, 2.205, 2.1,
    2.14, 2.091, 2.125, 2.048, 2.106, 2.047, 2.064, 2.027, 2.054, 1.999, 2.031, 1.995, 2.034, 1.994, 2.032, 1.967, 2.005, 1.976)


def unity(n: int) -> float:
    """What the scale gives on normal samples of deviation 1."""
    return UNITY[n - 2] if 2 <= n < 2 + len(UNITY) else 1 - 1.5715 * n**-0.7414 if n > 1 else 1.0


def break_gain(n: int) -> float:
    """The improvement beyond which a break counts."""
    return BREAK[n - 4] if 4 <= n < 4 + len(BREAK) else 1.87 + 4 / n


def deviates(n: int) -> np.ndarray:
    """The deviate below which (i + CORE) / n of a normal distribution's absolute values lie, for i < n, by Winitzki's approximation."""
    a = 8 * (np.pi - 3) / (3 * np.pi * (4 - np.pi))
    log = np.log(1 - ((np.arange(n) + CORE) / n) ** 2)
    mid = 2 / (np.pi * a) + log / 2
    return np.sqrt(2) * np.sqrt(np.sqrt(mid**2 - log / a) - mid)


def tail(z: np.ndarray) -> np.ndarray:
    """The share of a normal distribution beyond z on both sides (Abramowitz and Stegun 7.1.28)."""
    x = z / np.sqrt(2)
    # Fixed values.
    p = 1 + x * (0.0705230784 + x * (0.0422820123 + x * (0.0092705272 + x * (0.0001520143 + x * (0.0002765672 + x * 0.0000430638)))))
    with np.errstate(over="ignore"):
        return 1 / p**16


@lru_cache(maxsize=4096)
def _grid(n: int) -> tuple[np.ndarray, int]:
    """The deviates of n samples, and how many of them come before the first that is not under 1."""
    x = deviates(n)
    under = int(np.argmax(x >= 1)) if (x >= 1).any() else n
    x.setflags(write=False)
    return x, under


def _single(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slopes through the origin."""
    return y @ x / (x @ x)


def _broken(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every break m of the core and every row of y: the first slope and the squared error of the line that breaks at x[m].

    Rows are y, columns m. Sums before and behind a break are differences of running sums.
    """
    xx, xy, yy = np.cumsum(x * x), np.cumsum(x * y, axis=1), (y * y).sum(axis=1, keepdims=True)
    behind = len(x) - 1 - np.arange(len(x))
    sx, sy = x.sum() - np.cumsum(x), y.sum(axis=1, keepdims=True) - np.cumsum(y, axis=1)
    sxx, sxy = xx[-1] - xx, xy[:, -1:] - xy
    dx, dxx, dxy = sx - behind * x, sxx - 2 * x * sx + behind * x * x, sxy - x * sy  # of x - x[m]
    a, b, e = xx + behind * x * x, x * dx, xy + x * sy
    with np.errstate(divide="ignore", invalid="ignore"):
        bend = (dxy - e * b / a) / (dxx - b * b / a)
        slope = (e - bend * b) / a
        error = yy - slope * e - bend * dxy
    return slope, np.where(np.isfinite(bend), np.maximum(error, 0.0), np.inf), bend


def _best_break(error: np.ndarray, n: int) -> np.ndarray:
    """The break of least error in each row: breaks a step apart first, then closer ones about the best."""
    rows, last = error.shape[0], error.shape[1] - 1
    m = np.arange(error.shape[1])
    low, high, step = np.full(rows, 1), np.full(rows, last), np.full(rows, max(int(n / 6.36), 1))
    best, moving = np.full(rows, 1), np.ones(rows, bool)
    while moving.any():
        tried = (m >= low[:, None]) & (m < high[:, None]) & ((m - low[:, None]) % step[:, None] == 0)
        found = np.where(tried, error, np.inf).argmin(axis=1)
        best = np.where(moving & tried.any(axis=1), found, best)
        next_low, next_high = np.maximum(best - step - 1, 1), np.minimum(best + step + 1, last)
        going = moving & (step > 1)
        low, high = np.where(going, next_low, low), np.where(going, next_high, high)
        step = np.where(going, np.maximum((next_high - next_low) // 6.36, 1).astype(int), step)
        moving = going
    return best


def line_fit(y: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted deviations, n a row: the single slope, the broken line's first slope, and the improvement that the break brings."""
    x, under = _grid(n)
    x, y = x[:under], y[:, :under]
    single = _single(x, y)
    slope, error, _ = _broken(x, y)
    m = _best_break(error, n)
    at = np.arange(len(y))
    plain = ((single[:, None] * x - y) ** 2).sum(axis=1)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (plain - error[at, m]) / error[at, m]
    return single, np.where(slope[at, m] < 0, 1e-10, slope[at, m]), np.nan_to_num(gain, nan=0.0)


def percentile(y: np.ndarray, n: int) -> np.ndarray:
    """The 68th percentile of n sorted deviations a row."""
    if n == 1:
        return y[:, 0]
    place = CORE * (n - 1)
    k = int(np.ceil(place - 1e-12))
    return y[:, 0] if k == 0 else y[:, k - 1] + (place - (k - 1)) * (y[:, k] - y[:, k - 1])


def simulated(sizes, seed: int = 1, draws: int = 20_000) -> dict[int, tuple[float, float]]:
    """(unity, break) of each sample size, from normal samples: the mean scale, and the improvement that a share of CORE stays under.

    Up to 8 samples the mean is that of the scale as used, beyond that of the broken line's slope alone.
    """
    rng, out = np.random.default_rng(seed), {}
    for n in sizes:
        scales, gains = [], []
        for at in range(0, draws, 20_000):
            v = rng.normal(size=(min(20_000, draws - at), n))
            y = np.sort(np.abs(v - np.median(v, axis=1, keepdims=True)), axis=1)
            x, under = _grid(n)
            if under > 2:
                single, slope, gain = line_fit(y, n)
                if n <= 8:
                    slope = np.where(gain < np.quantile(gain, CORE), single, slope)
                scales.append(slope)
                gains.append(gain)
            else:
                scales.append(_single(x[:2], y[:, :2]) if under == 2 else percentile(y, n))
        out[n] = (float(np.concatenate(scales).mean()), float(np.quantile(np.concatenate(gains), CORE)) if gains else 0.0)
    return out


def _scale(kind: str, y: np.ndarray, n: int) -> np.ndarray:
    """The spread of n sorted deviations a row, before its division by unity(n)."""
    if kind == "deviation":
        return np.sqrt((y * y).sum(axis=1) / (n - 1))
    x, under = _grid(n)
    if kind == "percentile" or under < 2:
        return percentile(y, n)
    if under == 2 or n < 4:
        return _single(x[:under], y[:, :under])
    single, slope, gain = line_fit(y, n)
    return np.where(gain < break_gain(n), single, slope)


def _same(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    d = np.abs(a - b)
    return d <= 1e-8 * np.maximum(np.abs(a), np.abs(b))


def three_values(v: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """Whether at least three values of a row that are alive differ, by more than a share of 1e-8."""
    row = np.arange(len(v))
    first = v[row, alive.argmax(axis=1)][:, None]
    other = alive & ~_same(v, first)
    second = v[row, other.argmax(axis=1)][:, None]
    return (other & ~_same(v, second)).any(axis=1)


def survivors(v: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Which samples stay: v holds a stack a row, there marks its samples. Of equal deviations the first goes."""
    alive = there.copy()
    for centre, kind in PASSES:
        rows = np.flatnonzero(alive.sum(axis=1) > 1)
        while len(rows):
            a, w = alive[rows], v[rows]
            count = a.sum(axis=1)
            at = np.arange(len(rows))
            if centre == "median":
                s = np.sort(np.where(a, w, np.inf), axis=1)
                c = (s[at, (count - 1) // 2] + s[at, count // 2]) / 2
            else:
                c = np.where(a, w, 0.0).sum(axis=1) / count
            far = np.where(a, np.abs(w - c[:, None]), -1.0)
            worst = far.argmax(axis=1)
            y = np.sort(np.where(a, far, np.inf), axis=1)
            scale = np.empty(len(rows))
            for n in np.unique(count):
                like = count == n
                scale[like] = _scale(kind, y[like, :n], int(n)) / unity(int(n))
            with np.errstate(divide="ignore", invalid="ignore"):
                gone = three_values(w, a) & (count * tail(far[at, worst] / scale) < 0.5)
            alive[rows[gone], worst[gone]] = False
            rows = rows[gone]
    return alive
