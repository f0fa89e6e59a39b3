"""Robust statistics of groups: medians, spreads and clipping as aggregates and windows, never a group in one Python task."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyloom.session import cut, written


def beside(df: DataFrame, keys: list[str], **aggregates: Column) -> DataFrame:
    """df with the aggregates of its group on every row."""
    return df.join(df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggregates.items()]), keys) if keys else df.crossJoin(df.agg(*[a.alias(n) for n, a in aggregates.items()]))  # one row


def median(value: Column) -> Column:
    return F.percentile(value, F.lit(0.5))


def stack_upper_medians(df: DataFrame, keys: list[str], value: str, name: str = "med") -> DataFrame:
    """upper_medians of many small groups, such as the stacks of pixels: each is ranked in one window."""
    w = Window.partitionBy(*keys)
    ranked = df.where(F.col(value).isNotNull()).withColumn("__r", F.row_number().over(w.orderBy(value))).withColumn("__n", F.count("*").over(w))
    return ranked.where(F.col("__r") == F.floor(F.col("__n") / 2) + 1).select(*keys, F.col(value).alias(name))


def upper_medians(df: DataFrame, keys: list[str], value: str, name: str = "med") -> DataFrame:
    """(*keys, name): the value at place n // 2, from 0, of each group, however large; null values and keys don't count, NaN is the greatest."""
    return order_statistics(df, keys, value, {name: 0.5})


def medians(df: DataFrame, keys: list[str], value: str, name: str = "med") -> DataFrame:
    """(*keys, name): the mean of the two middle values of each group, however large; null values and keys don't count."""
    both = order_statistics(df, keys, value, {"__lo": 0.5, "__hi": 0.5}, before={"__lo"})
    return both.select(*keys, ((F.col("__lo") + F.col("__hi")) / 2).alias(name))


def order_statistics(df: DataFrame, keys: list[str], value: str, shares: dict[str, float], before: Collection[str] = ()) -> DataFrame:
    """(*keys, a column for each of shares): the value at place floor(n * share), from 0 and n - 1 at most, of each group; null values and keys don't count, NaN is the greatest.

    For names in `before` the place is floor((n - 1) * share).

    Groups may be whole frames: a sketch of each, combined on the map side, gives two values close around each place, an
    exact count of what lies below and between them tells whether they hold it, and only distinct values between them
    are ranked. A group whose sketch missed is ranked whole. Sketches and counts are written, a row a group, so that the
    planner knows whether they are small enough to be broadcast and rows needn't be shuffled.
    """
    v, every = F.col("__v"), list(enumerate(shares.items()))
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).alias("__v"))
    around = F.array(*[F.lit(min(1.0, max(0.0, s + d))) for s in shares.values() for d in (-0.001, 0.001)])
    near = written(rows.groupBy(*keys).agg(F.percentile_approx(F.nanvl(v.cast("double"), F.lit(float("inf"))), around, F.lit(10_000)).alias("__q")))
    side = lambda k: F.when(v < F.col("__q")[2 * k], -1).when(v > F.col("__q")[2 * k + 1], 1).otherwise(0)
    at = rows.join(near, keys)
    place = lambda name, s: F.floor((F.count("*") - 1) * F.lit(s)) if name in before else F.least(F.count("*") - 1, F.floor(F.count("*") * F.lit(s)))
    held = written(at.groupBy(*keys).agg(*[F.struct(place(name, s).alias("place"), F.count_if(side(k) < 0).alias("below"), F.count_if(side(k) == 0).alias("n")).alias(f"__h{k}") for k, (name, s) in every]))
    parts = []
    for k, _ in every:
        h = F.col(f"__h{k}")
        hit = (h["place"] >= h["below"]) & (h["place"] < h["below"] + h["n"])
        parts.append(F.when(~hit | (side(k) == 0), F.struct(F.lit(k).alias("k"), F.when(hit, h["place"] - h["below"]).otherwise(h["place"]).alias("place"))))
    some = at.join(held, keys).select(*keys, "__v", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("__p"))
    counts = some.groupBy(*keys, F.col("__p.k").alias("__k"), "__v").agg(F.count("*").alias("__c"), F.first("__p.place").alias("__place"))
    run = counts.withColumn("__to", F.sum("__c").over(Window.partitionBy(*keys, "__k").orderBy("__v")))
    found = run.where((F.col("__place") < F.col("__to")) & (F.col("__place") >= F.col("__to") - F.col("__c")))
    return found.groupBy(*keys).agg(*[F.max(F.when(F.col("__k") == k, v)).alias(name) for k, (name, _) in every])


def spreads(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(*keys, med, dev): the median, and the median absolute deviation from it without any factor."""
    at = beside(df.select(*keys, value), keys, med=median(F.col(value)))
    return at.groupBy(*keys).agg(F.first("med").alias("med"), median(F.abs(F.col(value) - F.col("med"))).alias("dev"))


def weighted_medians(df: DataFrame, keys: list[str], value: str, weight: str, order: list[str], name: str = "med") -> DataFrame:
    """(*keys, name): the first value, ascending, at which the weight so far reaches half of all; order breaks ties. Groups without positive weight give the value at n // 2."""
    w = Window.partitionBy(*keys)
    o = w.orderBy(value, *order)
    run = df.withColumn("__c", F.sum(weight).over(o.rowsBetween(Window.unboundedPreceding, 0))).withColumn("__t", F.sum(weight).over(w)).withColumn("__r", F.row_number().over(o)).withColumn("__n", F.count("*").over(w))
    hit = F.when(F.col("__t") > 0, F.col("__c") >= F.col("__t") / 2).otherwise(F.col("__r") >= F.floor(F.col("__n") / 2) + 1)
    return run.where(hit).groupBy(*keys).agg(F.min_by(value, "__r").alias(name))


def clipped(df: DataFrame, keys: list[str], value: str, low: float, high: float, rounds: int, factor: float = 1.4826, least: int = 1) -> DataFrame:
    """Rows within median - low * s and median + high * s, s being factor * MAD, in rounds; a group stops at s <= 1e-12 or where fewer than `least` rows would stay.

    All windows are over the same groups, so the rows are dealt once for all rounds. Groups are pixels or patches: small.
    """
    w = Window.partitionBy(*keys)
    for _ in range(rounds):
        df = df.withColumn("__med", median(F.col(value)).over(w))
        df = df.withColumn("__s", median(F.abs(F.col(value) - F.col("__med"))).over(w) * factor)
        df = df.withColumn("__in", (F.col("__s") <= 1e-12) | F.col(value).between(F.col("__med") - low * F.col("__s"), F.col("__med") + high * F.col("__s")))
        df = df.withColumn("__left", F.sum(F.col("__in").cast("int")).over(w)).where(F.col("__in") | (F.col("__left") < least)).drop("__med", "__s", "__in", "__left")
    return df


def hierarchy(cells: DataFrame, tile: str, levels: int, cell_area: float, signal: str = "signal", support: str = "support") -> DataFrame:
    """(level, tile, signal, support) of every coarser level: signal is flux over covered area, NaN where nothing is covered, support the covered share of the cell, at most 1.

    One explode and one aggregate with map-side combine make all levels.
    """
    area = F.col(support) * cell_area
    at = cells.select(F.explode(F.sequence(F.lit(1), F.lit(levels))).alias("level"), F.col(tile).alias("t"), (F.col(signal) * area).alias("flux"), area.alias("area"))
    up = at.groupBy("level", F.expr("shiftright(t, 2 * level)").alias(tile)).agg(F.sum("flux").alias("flux"), F.sum("area").alias("area"))
    return up.select("level", tile, F.when(F.col("area") > 0, F.col("flux") / F.col("area")).otherwise(F.lit(float("nan"))).alias(signal), F.least(F.lit(1.0), F.col("area") / (F.pow(F.lit(4.0), "level") * cell_area)).alias(support))


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(id, root): the smallest id reachable over edges, by rounds of neighbour minima and pointer jumping. Each round's table is checkpointed, so lineage stays short and survives lost executors."""
    both = cut(edges.select(F.col(a).alias("id"), F.col(b).alias("to")).unionByName(edges.select(F.col(b).alias("id"), F.col(a).alias("to"))).distinct())
    roots = cut(both.groupBy("id").agg(F.least(F.col("id"), F.min("to")).alias("root")))
    while True:
        near = both.join(roots.withColumnRenamed("id", "to"), "to").groupBy("id").agg(F.min("root").alias("near"))
        step = roots.join(near, "id").select("id", F.least("root", "near").alias("next"), "root")
        jump = step.select(F.col("id").alias("next"), F.col("next").alias("up"))
        moved = cut(step.join(jump, "next").select("id", F.least("next", "up").alias("new"), "root"))
        roots = moved.select("id", F.col("new").alias("root"))
        if moved.where("new <> root").isEmpty():
            return roots


def regression_clip(df: DataFrame, keys: list[str], x: str, y: str, spreads_kept: float = 3.0, factor: float = 1.4826) -> DataFrame:
    """Rows of groups within spreads_kept * factor * MAD of the least-squares line of y over x; a group without spread stays whole. Groups may be whole frames: lines and medians are written, a row a group, so rows needn't be shuffled."""
    lines = written(df.groupBy(*keys).agg(F.regr_slope(y, x).alias("__k"), F.regr_intercept(y, x).alias("__c")))
    line = df.join(lines, keys).withColumn("__e", F.col(y) - F.col("__c") - F.col("__k") * F.col(x))
    at = line.join(written(medians(line, keys, "__e", "__m")), keys)
    off = at.select(*keys, F.abs(F.col("__e") - F.col("__m")).alias("__o"))
    at = at.join(written(medians(off, keys, "__o", "__d")), keys)
    return at.where((F.col("__d") <= 0) | (F.abs(F.col("__e") - F.col("__m")) <= F.col("__d") * (factor * spreads_kept))).select(*df.columns)
