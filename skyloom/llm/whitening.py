"""Whitening of embeddings by a one-sided Jacobi SVD.

Entries are put on a grid of whole numbers, so that counts and sums over the distinct vectors are exact. Every task
reduces its centred vectors, block by block, to a triangular factor; factors are stacked and reduced again, `fan` at a
time, until one is left (TSQR). Its covariance is that of all vectors. Plane rotations of its columns, in rounds of
disjoint pairs, make them orthogonal: the accumulated rotations are the components, the columns' lengths over sqrt(n)
the standard deviations, small ones as accurate as large ones, since nothing is squared before it is rotated.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import cut


@dataclass(frozen=True)
class Whitening:
    """components: how many are returned. scale, shift: of the grid, floor(scale * entry) + shift. fan: factors that one task reduces. tiny: a standard deviation under this share of the largest is zero. max_dims bounds the factor that reaches the driver."""

    components: int = 16
    scale: float = 64.0
    shift: int = 1_000_000
    fan: int = 32
    tiny: float = 1e-12
    sweeps: int = 60
    max_dims: int = 4096


@dataclass(frozen=True)
class Model:
    """n vectors of dims entries with these sums; vectors: dims x k components, deviations: theirs, explained: their shares of the trace; identity_error: of the whitened vectors' covariance."""

    dims: int
    n: int
    sums: np.ndarray
    vectors: np.ndarray
    deviations: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def gridded(vec: Column, p: Whitening) -> Column:
    return F.transform(vec, lambda c: F.floor(c.cast("double") * p.scale) + F.lit(p.shift).cast("long"))


def usable(vec: Column) -> Column:
    """A vector without null or non-finite entries."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return vec.isNotNull() & F.forall(vec, lambda c: F.coalesce(finite(c.cast("double")), F.lit(False)))


def grid_rows(df: DataFrame, p: Whitening = Whitening(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, x) of the rows with a usable vector of the usual length: the most frequent one, of equally frequent ones the greatest."""
    rows = df.where(usable(F.col(vec_col))).select(F.col(id_col).alias("vec_id"), gridded(F.col(vec_col), p).alias("x"))
    sizes = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == (sizes["d"] if sizes else 0))


def _matrix(col: pa.Array, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n. The whole part of the mean goes first, without rounding."""
    q, rest = np.divmod(sums, n)
    return (x - q).astype(float) - rest / n


def _reduced(parts: DataFrame, merge, fan: int) -> bytes | None:
    """One state of all rows (k, state), merged fan at a time in the order of k."""

    def of(key, t):
        t = t.sort_by("k")
        return pa.table({"k": pa.array([key[0].as_py()], pa.int64()), "state": pa.array([merge(t.column("state").to_pylist())], pa.binary())})

    parts = cut(parts, "states")
    last = parts.agg(F.max("k")).first()[0]
    if last is None:
        return None
    while True:
        parts = parts.groupBy((F.col("k") / fan).cast("long").alias("g")).applyInArrow(of, "k long, state binary")
        last //= fan
        if last == 0:
            return bytes(parts.first()["state"])


def _states(fit: DataFrame, step, zero):
    """(k, state) of each task with rows: step(state, matrix) over its batches."""

    def run(batches):
        state = None
        for b in batches:
            if b.num_rows:
                state = step(zero() if state is None else state, b.column(0))
        if state is not None:
            yield pa.record_batch([pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([state.tobytes()], pa.binary())], ["k", "state"])

    return fit.select("x").mapInArrow(run, "k long, state binary")


def factor(fit: DataFrame, dims: int, n: int, sums: np.ndarray, fan: int) -> np.ndarray:
    """The triangular factor of all centred rows."""
    joined = lambda states: np.linalg.qr(np.concatenate([np.frombuffer(s).reshape(-1, dims) for s in states]), mode="r").tobytes()
    step = lambda r, col: np.linalg.qr(np.concatenate([r, _centred(_matrix(col, dims), n, sums)]), mode="r")
    return np.frombuffer(_reduced(_states(fit, step, lambda: np.zeros((0, dims))), joined, fan)).reshape(-1, dims)


def jacobi(r: np.ndarray, sweeps: int = 60, tolerance: float = 1e-15) -> tuple[np.ndarray, np.ndarray]:
    """Right singular vectors and singular values of r, falling. A sweep rotates every pair of columns once, disjoint pairs together."""
    a, d = r.astype(float), r.shape[1]
    v, order = np.eye(d), np.arange(d + d % 2)
    half = len(order) // 2
    for _ in range(sweeps):
        turned = False
        for _ in range(len(order) - 1):
            p, q = order[:half], order[half:][::-1]
            real = (p < d) & (q < d)
            p, q = p[real], q[real]
            x, y = a[:, p], a[:, q]
            xx, yy, xy = (x * x).sum(0), (y * y).sum(0), (x * y).sum(0)
            turn = np.abs(xy) > tolerance * np.sqrt(xx) * np.sqrt(yy)
            if turn.any():
                turned = True
                p, q, x, y = p[turn], q[turn], x[:, turn], y[:, turn]
                zeta = (yy[turn] - xx[turn]) / (2 * xy[turn])
                t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1 / np.hypot(1.0, t)
                s = c * t
                a[:, p], a[:, q] = c * x - s * y, s * x + c * y
                v[:, p], v[:, q] = c * v[:, p] - s * v[:, q], s * v[:, p] + c * v[:, q]
            order = np.concatenate([order[:1], order[-1:], order[1:-1]])
        if not turned:
            break
    length = np.sqrt((a * a).sum(0))
    fall = np.argsort(-length, kind="stable")
    return v[:, fall], length[fall]


def _project(x: np.ndarray, m: Model) -> np.ndarray:
    """Whitened rows; NaN where a component has no deviation."""
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(m.deviations > 0, _centred(x, m.n, m.sums) @ m.vectors / m.deviations, np.nan)


def _moments(a: np.ndarray, b: np.ndarray, k: int) -> np.ndarray:
    """Count, mean and centred products of two sets together, from those of each."""
    n = a[0] + b[0]
    apart = b[1 : k + 1] - a[1 : k + 1]
    both = a[k + 1 :] + b[k + 1 :] + np.outer(apart, apart).ravel() * (a[0] * b[0] / n)
    return np.concatenate([[n], a[1 : k + 1] + apart * (b[0] / n), both])


def identity_error(fit: DataFrame, m: Model, fan: int) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance less the identity, over components with a deviation."""
    live = np.flatnonzero(m.deviations > 0)
    k = len(live)
    if not k:
        return None

    def step(state: np.ndarray, col: pa.Array) -> np.ndarray:
        z = _project(_matrix(col, m.dims), m)[:, live]
        mid = z.mean(0)
        own = np.concatenate([[len(z)], mid, ((z - mid).T @ (z - mid)).ravel()])
        return own if state is None or state[0] == 0 else _moments(state, own, k)

    def merge(states: list[bytes]) -> bytes:
        total, *others = [np.frombuffer(s) for s in states]
        for o in others:
            total = _moments(total, o, k)
        return total.tobytes()

    got = np.frombuffer(_reduced(_states(fit, step, lambda: np.zeros(1)), merge, fan))
    return float(np.abs(got[k + 1 :].reshape(k, k) / got[0] - np.eye(k)).max())


def fit(rows: DataFrame, p: Whitening = Whitening()) -> Model | None:
    """The model of the distinct vectors of rows (x); None without any."""
    table = cut(rows.select("x").distinct(), "vectors")
    head = table.select(F.size("x").alias("d")).first()
    if head is None or head["d"] == 0:
        return None
    dims = head["d"]
    if dims > p.max_dims:
        raise ValueError(f"{dims} dimensions: the factor of more than max_dims = {p.max_dims} must not reach the driver")

    def add(batches):
        n, total = 0, np.zeros(dims, np.int64)
        for b in batches:
            x = _matrix(b.column(0), dims)
            n, total = n + len(x), total + x.sum(0)
        if n:
            yield pa.record_batch([pa.array([n], pa.int64()), pa.array([total.tolist()], pa.list_(pa.int64()))], ["n", "sums"])

    partial = cut(table.mapInArrow(add, "n long, sums array<long>"), "sums")
    n = partial.agg(F.sum("n")).first()[0]
    totals = partial.select(F.posexplode("sums").alias("d", "s")).groupBy("d").agg(F.sum("s").alias("s")).orderBy("d").collect()  # dims rows
    sums = np.array([r["s"] for r in totals], np.int64)
    vectors, length = jacobi(factor(table, dims, n, sums, p.fan), p.sweeps)
    deviation = np.where(length > p.tiny * length[0], length, 0.0) / np.sqrt(n)
    trace, k = float((length**2).sum() / n), min(p.components, dims)
    explained = deviation[:k] ** 2 / trace if trace > 0 else np.full(k, np.nan)
    m = Model(dims, n, sums, vectors[:, :k], deviation[:k], explained, None)
    return Model(dims, n, sums, m.vectors, m.deviations, explained, identity_error(table, m, p.fan))


def _deviation(x: np.ndarray, m: Model) -> list[int | None]:
    """Sums of squares of n * x - sums; None where one doesn't fit into 63 bits."""
    q, rest = np.divmod(m.sums, m.n)
    far = int(np.abs(x - q).max(initial=0)) + 1
    if m.dims * (m.n * far) ** 2 < 1 << 63:
        e = m.n * (x - q) - rest
        return (e * e).sum(1).tolist()
    exact = [sum((m.n * int(a) - int(s)) ** 2 for a, s in zip(row, m.sums, strict=True)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def transform(rows: DataFrame, m: Model) -> DataFrame:
    """(vec_id, deviation, whitened): for each row of (vec_id, x) the sum over dimensions of (n * x - sums)^2, null beyond 63 bits, and the whitened components, null where one has no deviation."""
    held = rows.sparkSession.sparkContext.broadcast(m)  # dims x components numbers

    def run(batches):
        model = held.value
        k = len(model.deviations)
        for b in batches:
            x = _matrix(b.column(1), model.dims)
            z = _project(x, model)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(z.ravel(), from_pandas=True))
            yield pa.record_batch([b.column(0), pa.array(_deviation(x, model), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, deviation long, whitened array<double>")


def whiten(df: DataFrame, p: Whitening = Whitening(), id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each usable row and component.

    Rows with a null vector, null or non-finite entries, or another than the usual length are left out. Repeated rows
    stay and repeated vectors count once in the model. Where all vectors agree along a component, whitened is null;
    where they agree in all, explained and identity_error are null too. An empty table gives an empty result.
    """
    rows = grid_rows(df, p, id_col, vec_col)
    m = fit(rows, p)
    number = lambda v: F.lit(None if v is None or np.isnan(v) else float(v)).cast("double")
    if m is None:
        flat = rows.limit(0).select("vec_id", F.lit(1).alias("component"), F.lit(0).cast("long").alias("deviation"), F.lit(0.0).alias("whitened"))
        return flat.select("vec_id", "component", F.lit(0).cast("long").alias("n"), "deviation", "whitened", number(None).alias("explained"), number(None).alias("identity_error"))
    flat = transform(rows, m).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    explained = F.get(F.array(*[number(v) for v in m.explained]), F.col("at"))
    return flat.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(m.n).cast("long").alias("n"), "deviation", "whitened", explained.alias("explained"), number(m.identity_error).alias("identity_error"))
