"""The joint additive model of frames and controls: value = M(control) + C(frame, control), by robust alternation."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.functions.frames import huber_rho, huber_weight
from skyloom.operators.robust import components
from skyloom.session import cut

FRAME_BASE = 1 << 40


def gauge(obs: DataFrame) -> DataFrame:
    """(frame, reference): the least frame of each frame's component in the graph of frames and controls."""
    edges = obs.select("frame", (F.col("control") + FRAME_BASE).alias("node")).distinct()
    return components(edges, "frame", "node").where(F.col("id") < FRAME_BASE).select(F.col("id").alias("frame"), F.col("root").alias("reference"))


def normalised(obs: DataFrame, raw: str = "raw", reliability: float = 1.0) -> DataFrame:
    """obs with w, the share of its control's raw weights; 0 where they sum to 1e-12 or less."""
    total = obs.groupBy("control").agg(F.sum(raw).alias("__t"))
    return obs.join(total, "control").withColumn("w", F.when(F.col("__t") > 1e-12, F.col(raw) / F.col("__t") * reliability).otherwise(0.0)).drop("__t")


def _residual(floor: float) -> Column:
    return (F.col("v") - F.col("m") - F.col("c")) / F.greatest(F.abs(F.col("unc")), F.lit(floor))


def _rounds(t: pa.Table, rounds: int, anchor: float, delta: float, floor: float):
    """Rounds over one control's observations: its frames, m, their c, and how far m or a c moved in each round."""
    col = lambda c: np.asarray(t.column(c).to_numpy(), np.float64)
    v, unc, w = col("v"), np.maximum(np.abs(col("unc")), floor), col("w")
    null = np.zeros(len(v), bool)
    for c in ("v", "unc", "w"):
        null |= t.column(c).is_null().to_numpy()
    v, unc, w = np.where(null, 0.0, v), np.where(null, 1.0, unc), np.where(null, 0.0, w)
    frames, at = np.unique(t.column("frame").to_numpy(), return_inverse=True)
    own = (t.column("frame").to_numpy() == t.column("reference").to_numpy())
    held = np.zeros(len(frames), bool)
    held[at[own]] = True
    m, c, moved = float((w * v).sum() / w.sum()) if w.sum() != 0 else 0.0, np.zeros(len(frames)), np.zeros(rounds)
    for k in range(rounds):
        off = np.abs((v - m - c[at]) / unc)
        h = w * np.where(off <= delta, 1.0, delta / np.maximum(off, delta))
        hv = h * (v - c[at])
        m_new = next((float(hv[s].sum() / h[s].sum()) for s in (own, slice(None)) if h[s].sum() > 1e-12), m)
        down = np.bincount(at, h, len(frames)) + anchor
        free = ~held & (down > 0)
        c_new = np.where(free, np.bincount(at, h * (v - m_new), len(frames)) / np.where(free, down, 1.0), 0.0)
        moved[k] = max(abs(m_new - m), np.abs(c_new - c).max())
        m, c = m_new, c_new
        if moved[k] == 0:
            break
    return frames, m, c, moved


def fit(obs: DataFrame, rounds: int = 100, tolerance: float = 1e-6, anchor: float = 1e-3, delta: float = 1.345, floor: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """(control, m) and (frame, control, c) of obs (frame, control, v, unc, w), without smoothing between controls.

    A round weighs residuals by Huber's function, takes m from the reference frame where it has weight and from all
    frames otherwise, then c from the new m; the reference frame's c is 0, and so is c without weight and anchor. It
    ends when no m or c of any control moves by tolerance or more. An observation with a null weighs nothing.

    Without smoothing a control's rounds need its own observations alone, one a frame or a few; so each control is
    solved in one group, first to learn how far it moves in each round, then for as many rounds as the slowest needs.
    """
    obs = cut(obs.join(gauge(obs), "frame").select("frame", "control", "reference", *[F.col(x).cast("double").alias(x) for x in ("v", "unc", "w")]))
    kind = {f.name: f.dataType.simpleString() for f in obs.schema}
    by_control = obs.groupBy("control")
    if tolerance > 0:

        def moves(t):
            moved = _rounds(t, rounds, anchor, delta, floor)[3]
            return pa.table({"round": pa.array(np.arange(1, rounds + 1), pa.int32()), "moved": pa.array(moved)})

        still = by_control.applyInArrow(moves, "round int, moved double").groupBy("round").agg(F.max("moved").alias("moved")).where(F.col("moved") < tolerance)
        first = still.agg(F.min("round")).first()[0]
        rounds = first if first is not None else rounds

    def solve(t):
        frames, m, c, _ = _rounds(t, rounds, anchor, delta, floor)
        control = t.column("control")[0].as_py()
        return pa.table({"frame": pa.array(frames, t.schema.field("frame").type), "control": pa.array([control] * len(frames), t.schema.field("control").type), "m": pa.array(np.full(len(frames), m)), "c": pa.array(c)})

    solved = cut(by_control.applyInArrow(solve, f"frame {kind['frame']}, control {kind['control']}, m double, c double"))
    return solved.select("control", "m").distinct(), solved.select("frame", "control", "c")


def fit_smoothed(obs: DataFrame, links: DataFrame, smoothing: float, rounds: int = 100, tolerance: float = 1e-6, anchor: float = 1e-3, delta: float = 1.345, floor: float = 1e-3) -> tuple[DataFrame, DataFrame]:
    """(control, m) and (frame, control, c) as fit gives them, with a pull of weight `smoothing` between the c of linked controls (a, b) in each frame.

    Here a control's rounds need its neighbours', so a round is sums over (frame, control), combined before they are
    shuffled, m from them, and c by conjugate gradients; controls that a frame has no observation of get their c from
    their neighbours. A round's tables are checkpointed. With smoothing 0 the result is that of fit.
    """
    obs = cut(obs.join(gauge(obs), "frame").select("frame", "control", "reference", *[F.col(x).cast("double").alias(x) for x in ("v", "unc", "w")]))
    good = obs.where(F.col("v").isNotNull() & F.col("unc").isNotNull() & F.col("w").isNotNull())
    links = cut(links)
    parts = cut(components(links, "a", "b")).withColumnsRenamed({"id": "control", "root": "part"})
    start = good.groupBy("control").agg((F.sum(F.col("w") * F.col("v")) / F.sum("w")).alias("m"))
    m = cut(obs.select("control").distinct().join(start, "control", "left").select("control", F.coalesce(F.nanvl("m", F.lit(0.0)), F.lit(0.0)).alias("m")))
    c = cut(obs.select("frame", "control").distinct().withColumn("c", F.lit(0.0)))
    for _ in range(rounds):
        at = good.join(m, "control").join(c, ["frame", "control"], "left").withColumn("c", F.coalesce("c", F.lit(0.0)))
        h = F.col("w") * huber_weight(_residual(floor), delta)
        sums = cut(at.groupBy("frame", "control", (F.col("frame") == F.col("reference")).alias("own")).agg(F.sum(h).alias("weight"), F.sum(h * F.col("v")).alias("hv"), F.sum(h * (F.col("v") - F.col("c"))).alias("hr")))
        mine = lambda x: F.sum(F.when(F.col("own"), F.col(x)))
        told = sums.groupBy("control").agg(F.when(mine("weight") > 1e-12, mine("hr") / mine("weight")).when(F.sum("weight") > 1e-12, F.sum("hr") / F.sum("weight")).alias("new"))
        m_new = cut(m.join(told, "control", "left").select("control", F.coalesce("new", "m").alias("m"), F.col("m").alias("old")))
        nodes = sums.where("not own").join(m_new, "control").select("frame", "control", "weight", (F.col("hv") - F.col("weight") * F.col("m")).alias("rhs"))
        zero = sums.where("own").select("frame", "control", F.lit(0.0).alias("c"))
        c_new = cut(_smoothed(nodes, links, parts, smoothing, anchor).unionByName(zero))
        moved = c_new.withColumnRenamed("c", "new").join(c, ["frame", "control"], "full").agg(F.max(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("c", F.lit(0.0))))).first()[0]
        moved = max(moved or 0.0, m_new.agg(F.max(F.abs(F.col("m") - F.col("old")))).first()[0] or 0.0)
        m, c = m_new.select("control", "m"), c_new
        if moved < tolerance:
            break
    return m, c


def smoothed(nodes: DataFrame, links: DataFrame, smoothing: float, anchor: float, steps: int = 200) -> DataFrame:
    """(frame, control, c): (W + smoothing * L + anchor) c = rhs for each frame, by conjugate gradients from zero.

    nodes (frame, control, weight, rhs) are a frame's sums; L is the Laplacian of links (a, b). A component that a frame
    doesn't touch stays zero and isn't solved; frames and components are solved apart, each in one task: of a million
    controls that is some 150 MB.
    """
    return _smoothed(nodes, links, cut(components(links, "a", "b")).withColumnsRenamed({"id": "control", "root": "part"}), smoothing, anchor, steps)


def _smoothed(nodes: DataFrame, links: DataFrame, part: DataFrame, smoothing: float, anchor: float, steps: int = 200) -> DataFrame:
    own = nodes.join(part, "control", "left").withColumn("part", F.coalesce("part", "control"))
    touched = own.select("frame", "part").distinct()
    edges = touched.join(links.join(part.withColumnRenamed("control", "a"), "a"), "part").select("frame", "part", "a", "b")

    def solve(left, right):
        names = np.unique(np.concatenate([left.column("control").to_numpy(), right.column("a").to_numpy(), right.column("b").to_numpy()]))
        w, rhs = np.zeros(len(names)), np.zeros(len(names))
        at = np.searchsorted(names, left.column("control").to_numpy())
        w[at], rhs[at] = left.column("weight").to_numpy(), left.column("rhs").to_numpy()
        a, b = (np.searchsorted(names, right.column(c).to_numpy()) for c in "ab")

        def times(v):
            d = smoothing * (v[a] - v[b])
            return (w + anchor) * v + np.bincount(a, d, len(v)) - np.bincount(b, d, len(v))

        x, r = np.zeros(len(names)), rhs.copy()
        p, rr = r.copy(), float(r @ r)
        for _ in range(steps):
            ap = times(p)
            down = float(p @ ap)
            if down <= 1e-30:
                break
            x, r = x + rr / down * p, r - rr / down * ap
            new = float(r @ r)
            if new < 1e-24:
                break
            p, rr = r + new / rr * p, new
        frame = left.column("frame")[0] if left.num_rows else right.column("frame")[0]
        return pa.table({"frame": pa.array([frame.as_py()] * len(names), pa.int64()), "control": pa.array(names), "c": pa.array(x)})

    longs = own.select(F.col("frame").cast("long").alias("frame"), F.col("part").cast("long").alias("part"), F.col("control").cast("long").alias("control"), F.col("weight").cast("double").alias("weight"), F.col("rhs").cast("double").alias("rhs"))
    ends = edges.select(*[F.col(c).cast("long").alias(c) for c in ("frame", "part", "a", "b")])
    return longs.groupBy("frame", "part").cogroup(ends.groupBy("frame", "part")).applyInArrow(solve, "frame long, control long, c double")


def model_hash(c: DataFrame, scale: int = 10_000) -> DataFrame:
    """(hash, frames) of (frame, control, c), whatever the order of rows: of each frame's sorted rows, then of all frames; c counts in units of 1 / scale."""
    row = F.concat_ws(",", "control", F.round(F.col("c") * scale).cast("long"))
    frames = c.groupBy("frame").agg(F.sha2(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("control", row.alias("t")))), lambda x: x["t"]), ";"), 256).alias("h"))
    each = F.transform(F.sort_array(F.collect_list(F.struct("frame", "h"))), lambda x: F.concat_ws(",", x["frame"], x["h"]))
    return frames.agg(F.sha2(F.array_join(each, ";"), 256).alias("hash"), F.count("*").alias("frames"))  # a line a frame


def save(c: DataFrame, path: str) -> None:
    """The non-zero rows of (frame, control, c) under path, with their hash and numbers beside them."""
    rows = c.where("c <> 0")
    rows.write.mode("errorifexists").parquet(f"{path}/c")
    saved = c.sparkSession.read.parquet(f"{path}/c")
    model_hash(saved).crossJoin(saved.agg(F.count("*").alias("rows"))).write.parquet(f"{path}/manifest")  # one row each


def open_model(spark, path: str) -> DataFrame:
    """The rows that save wrote. A model with other rows than its manifest says, or with a (frame, control) twice, is an error."""
    c, said = spark.read.parquet(f"{path}/c"), spark.read.parquet(f"{path}/manifest").first()
    if said is None or c.count() != said["rows"] or model_hash(c).first()["hash"] != said["hash"]:
        raise ValueError(f"{path}: the model is not what its manifest says")
    if not c.groupBy("frame", "control").count().where("count > 1").isEmpty():
        raise ValueError(f"{path}: a control stands twice in a frame")
    return c


def objective(obs: DataFrame, m: DataFrame, c: DataFrame, delta: float = 1.345, floor: float = 1e-3) -> DataFrame:
    rows = obs.join(m, "control").join(c, ["frame", "control"])
    return rows.agg(F.sum(F.col("w") * huber_rho(_residual(floor), delta)).alias("objective"))


def _segment(v: Column, low: Column, high: Column, cell: int) -> tuple[Column, Column]:
    """The two node columns whose line holds v; outside the covered nodes the two at the edge."""
    a, b = low * cell + cell // 2, high * cell + cell // 2
    at = F.greatest(low, F.least(high, F.floor(v / cell))) * cell + cell // 2
    first = F.when(low == high, a).when(v <= a, a).when(v >= b, b - cell).when(v <= at, at - cell).otherwise(at)
    return first, F.when(low == high, a).otherwise(first + cell)


SIDE = 8  # nodes a tile on each axis


def _grids(nodes: DataFrame) -> DataFrame:
    """(frame, tile, __grid, __gx0, __gx1, __gy0, __gy1): a frame's nodes of a tile by gx * SIDE + gy, 0 where there is none, and what nodes the tile has in any frame."""
    bounds = nodes.groupBy("tile").agg(F.min("gx").alias("__gx0"), F.max("gx").alias("__gx1"), F.min("gy").alias("__gy0"), F.max("gy").alias("__gy1"))
    held = nodes.groupBy("frame", "tile").agg(F.map_from_entries(F.collect_list(F.struct((F.col("gx") * SIDE + F.col("gy")).cast("int").alias("k"), F.col("c").cast("double").alias("c")))).alias("__m"))  # SIDE * SIDE nodes at most
    grid = F.transform(F.sequence(F.lit(0), F.lit(SIDE * SIDE - 1)), lambda k: F.coalesce(F.try_element_at("__m", k), F.lit(0.0)))
    return held.select("frame", "tile", grid.alias("__grid")).join(bounds, "tile")


def evaluate(pixels: DataFrame, nodes: DataFrame, cell: int = 64) -> DataFrame:
    """pixels (frame, tile, x, y, …) with c, bilinear in nodes (frame, tile, gx, gy, c); beyond the covered nodes the outermost lines go on. A missing node counts as 0, a tile without nodes gives 0; a frame that the model doesn't know is an error."""
    known = nodes.select("frame", F.lit(True).alias("__known")).distinct()
    at = pixels.join(known, "frame", "left").join(_grids(nodes), ["frame", "tile"], "left")
    for axis in "xy":
        lo, hi = _segment(F.col(axis), F.col(f"__g{axis}0"), F.col(f"__g{axis}1"), cell)
        at = at.withColumns({f"__{axis}0": lo, f"__{axis}1": hi})
        at = at.withColumn(f"__t{axis}", F.when(F.col(f"__{axis}1") != F.col(f"__{axis}0"), (F.col(axis) - F.col(f"__{axis}0")) / (F.col(f"__{axis}1") - F.col(f"__{axis}0"))).otherwise(0.0))
        for k in (0, 1):
            g = F.floor(F.col(f"__{axis}{k}") / cell).cast("int")
            at = at.withColumn(f"__{axis}{k}", F.when((g >= 0) & (g < SIDE), g))
    node = lambda i, j: F.coalesce(F.get("__grid", F.col(f"__x{i}") * SIDE + F.col(f"__y{j}")), F.lit(0.0))
    top = node(0, 0) + F.col("__tx") * (node(1, 0) - node(0, 0))
    low = node(0, 1) + F.col("__tx") * (node(1, 1) - node(0, 1))
    unknown = F.raise_error(F.concat(F.lit("the model has no frame "), F.col("frame").cast("string"))).cast("double")
    return at.withColumn("c", F.when(F.col("__known").isNull(), unknown).otherwise(F.coalesce(top + F.col("__ty") * (low - top), F.lit(0.0)))).select(*pixels.columns, "c")


def linked(nodes: DataFrame, order: int, reach: float = 1.6) -> DataFrame:
    """(a, b) of controls (control, tile, gx, gy), each pair once: neighbours along gx or gy in a tile, and, across the borders of tiles, nodes whose cells touch and whose centres are within reach times a cell's size. tile is a nested cell of this order."""
    deep = order + 3
    cells = nodes.select("control", "tile", (F.col("tile") * (SIDE * SIDE) + hp.morton(F.col("gx"), F.col("gy"))).cast("long").alias("pix"), "gx", "gy")
    near = hp.with_centre(hp.neighbours(cells, deep), deep, ra="__ra", dec="__dec")
    other = hp.with_centre(cells.select(F.col("control").alias("b"), F.col("tile").alias("__tile"), F.col("gx").alias("__gx"), F.col("gy").alias("__gy"), F.col("pix").alias("neighbor")), deep, pix="neighbor", ra="__ra2", dec="__dec2")
    met = near.withColumnRenamed("control", "a").join(other, "neighbor").where("a < b")
    within = (F.col("tile") == F.col("__tile")) & (F.abs(F.col("gx") - F.col("__gx")) + F.abs(F.col("gy") - F.col("__gy")) == 1)
    across = (F.col("tile") != F.col("__tile")) & (hp.angular_distance(F.col("__ra"), F.col("__dec"), F.col("__ra2"), F.col("__dec2")) < reach * hp.resolution_arcsec(deep) / 3600)
    return met.where(within | across).select("a", "b").distinct()


def dense(nodes: DataFrame, cell: int = 64) -> DataFrame:
    """(frame, tile, field): c at every pixel of each tile that a frame has nodes in, an array by x * side + y with side = SIDE * cell. A row is a tile: 2 MB at the usual 512 pixels."""
    side = SIDE * cell

    @F.arrow_udf("array<double>")
    def field(grid: pa.Array, x0: pa.Array, x1: pa.Array, y0: pa.Array, y1: pa.Array) -> pa.Array:
        out = []
        value = grid.flatten().to_numpy(zero_copy_only=False).reshape(-1, SIDE, SIDE)
        for g, *bounds in zip(value, *(np.asarray(b).astype(int) for b in (x0, x1, y0, y1)), strict=True):
            ends = []
            for low, high in (bounds[:2], bounds[2:]):
                v = np.arange(side)
                first = np.clip((v - cell // 2 - 1) // cell if low != high else 0 * v + low, low, max(low, high - 1))
                ends.append((first, np.minimum(first + 1, high), (v - (first * cell + cell // 2)) / cell if low != high else np.zeros(side)))
            (a, b, s), (p, q, t) = ends
            left, right = (g[i][:, p] * (1 - t) + g[i][:, q] * t for i in (a, b))
            out.append((left * (1 - s[:, None]) + right * s[:, None]).ravel())
        flat = np.concatenate([np.zeros(0), *out])
        return pa.ListArray.from_arrays(pa.array(np.arange(len(value) + 1, dtype=np.int32) * side * side), pa.array(flat))

    return _grids(nodes).select("frame", "tile", field("__grid", "__gx0", "__gx1", "__gy0", "__gy1").alias("field"))
