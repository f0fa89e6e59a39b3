"""What keeps the work of queries in step with their input."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from skyloom.functions import frames as fr


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_curve_is_sorted_once(spark):
    df = spark.range(1).select(F.array(*[F.struct(F.lit(w).alias("wl"), F.lit(float(i)).alias("val")) for i, w in enumerate([3, 1, None, 2, 1, 3])]).alias("p")).where("size(p) > 0")
    got = df.repartition(2).select(fr.prepared_curve(F.col("p")).alias("c"))
    assert [tuple(x) for x in got.first().c] == [(1, 1.0), (2, 3.0), (3, 0.0)]
    assert _plan(got).count("sort_array(") + _plan(got).count("array_sort(") == 1


def test_pairs_in_a_plane_are_compared_once(spark):
    from skyloom.operators import spatial

    r = random.Random(3)
    rows = [(i, r.randrange(-40, 40) / 4, r.randrange(-40, 40) / 4) for i in range(400)] + [(1000 + i, 0.25, 0.5) for i in range(20)] + [(2000, None, 1.0)]
    df = spark.createDataFrame(rows, "id long, x double, y double")
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and None not in (a[1], b[1]) and ((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) ** 0.5 <= 1.5)
    for fine, most in ((2, 512), (1, 7), (3, 3)):
        assert sorted(tuple(x) for x in spatial.plane_pairs(df, 1.5, "id", fine=fine, most=most).collect()) == want


def test_pair_distances_are_worked_out_once(spark):
    from skyloom.operators import spatial

    r = random.Random(4)
    rows = [(i, r.randrange(-40, 40) / 4, r.randrange(-40, 40) / 4) for i in range(300)] + [(1000 + i, 0.25, 0.5) for i in range(20)] + [(2000, None, 1.0), (None, 1.0, 1.0)]
    held = [a for a in rows if None not in a]
    want = sorted((a[0], b[0], d) for a in held for b in held if a[0] < b[0] and (d := ((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) ** 0.5) <= 1.5)
    df = spark.createDataFrame(rows, "id long, x double, y double")
    for fine, most in ((2, 256), (1, 7), (3, 3)):
        assert sorted(tuple(x) for x in spatial.plane_distances(df, 1.5, "id", fine=fine, most=most).collect()) == want


def test_equal_ranges_are_looked_up_once(spark):
    from skyloom.operators import spatial

    values = [(i, i * 7 % 50 / 10) for i in range(80)] + [(90, None), (91, float("nan")), (92, -0.05), (93, 0.305)]
    ranges = [(q, q % 6 / 10, q % 6 / 10 + 0.105) for q in range(60)] + [(70, -0.2, 3.0), (71, 1.0, 0.5), (72, None, 1.0), (73, 0.3, 0.3)]
    v, g = spark.createDataFrame(values, "id long, v double"), spark.createDataFrame(ranges, "q long, low double, high double")
    want = sorted((q, i, d) for i, d in values for q, lo, hi in ranges if None not in (d, lo, hi) and lo <= d <= hi)
    for most in (4096, 4):
        got = spatial.in_ranges(v, g, "v", "q", 0.1, most=most)
        assert sorted(tuple(x) for x in got.collect()) == want


def test_pairs_meet_ranges_and_not_each_key_that_asks_for_one(spark, tmp_path):
    from skyloom import catalog

    spark.range(60).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(60).select(F.col("id").alias("p_partkey")).write.parquet(f"{tmp_path}/part.parquet")
    spark.range(200).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    df = catalog.queries()["j_kvector"](spark, str(tmp_path))
    made = _plan(df).split("MapInArrow")
    assert len(made) == 2 and "explode(__keys" in made[0].split("Join")[0]  # the join with the ranges stands above, that of the cells below
    assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[1].split("Exchange")[0]


def test_shapes_meet_in_wide_cells_and_frames_are_dealt(spark, tmp_path):
    from skyloom.operators import solve
    from skyloom.plans.solve import _lists

    r = random.Random(5)
    shape = lambda v: (v, v + 1, v + 2, 1.0, 0.5 + r.random() * 0.1, 0.5 + r.random() * 0.1)
    rows = [[(1, *shape(10 * i + k)) for i in range(300)] for k in (0, 5)]
    left, right = (spark.createDataFrame(x, "f int, a int, b int, c int, length double, ba double, ca double") for x in rows)
    want = sorted((p[1 + k], q[1 + k], 1) for p in rows[0] for q in rows[1] if (p[5] - q[5]) ** 2 + (p[6] - q[6]) ** 2 < 4e-6 for k in range(3))
    assert sorted((x.u, x.w, x.votes) for x in solve.votes(left, right, ["f"]).collect()) == want
    spark.range(40).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    plan = _plan(_lists(spark, str(tmp_path))[0])
    assert "RepartitionByExpression" in plan and "frame" in plan


def test_clipping_holds_no_group_of_values(spark):
    from skyloom.operators import robust

    rows = [(k, float(i), 2.0 * i + (i * 7 % 5) / 10 + (50 if i == 11 else 0)) for k in range(2) for i in range(40)]
    got = robust.regression_clip(spark.createDataFrame(rows, "k int, x double, y double"), ["k"], "x", "y")
    assert sorted(tuple(r) for r in got.collect()) == [r for r in rows if r[1] != 11]
    assert "percentile(" not in _plan(got)


def test_fit_writes_rows_once_and_shuffles_sums(spark, monkeypatch):
    from skyloom.operators import robust, solve

    rows = spark.range(400).select((F.col("id") % 2).alias("f"), (F.col("id") * 37 % 41 - 20.0).alias("x"), (F.col("id") * 53 % 43 - 21.0).alias("y"))
    rows = rows.withColumns({"a": 3 + F.col("x") * F.col("y") * 0.01, "b": F.when(F.col("x") > 18, None).otherwise(F.col("y") - 2)})
    kept = []
    for module in (solve, robust):
        monkeypatch.setattr(module, "written", lambda df, to=module.written: kept.append(_plan(df)) or to(df))
        monkeypatch.setattr(module, "cut", lambda df: pytest.fail("a checkpoint of rows with their terms"))
    got = {(r.f, r.target): r for r in solve.polynomial_fit(rows, ["f"], ["a", "b"], 2, rounds=1).collect()}
    assert all(abs(c - e) < 1e-9 for f in (0, 1) for k, want in (("a", [3, 0, 0, 0, 0.01, 0]), ("b", [-2, 0, 1, 0, 0, 0])) for c, e in zip(got[f, k].coefficients, want, strict=True))
    assert got[0, "a"].n == 200 and not any("percentile(" in p for p in kept)
    assert sum("Aggregate" not in p for p in kept) == 1  # all else is a row a frame


def test_lists_of_stars_are_not_broadcast(spark, tmp_path):
    """A file of keys is small, and the planner would send all of its stars to the driver, once for each side of a join."""
    from skyloom.plans import solve

    spark.range(70).withColumnRenamed("id", "c_custkey").write.parquet(f"{tmp_path}/customer.parquet")
    plan = solve._pairs(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan and "SortMergeJoin" in plan
