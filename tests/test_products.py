"""Variance tiles and leaf cells in written product sets."""

from __future__ import annotations

import math

import pytest

from skyloom.sources import products

CELLS = "tile long, local long, var_num double, area double"


def test_variance_tiles_come_back_as_written(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    rows = [(5, 0, 2.0, 2.0), (5, 1, 0.0, 2.0), (5, 2, 1.0, 0.0), (5, 3, None, 1.0), (5, 4, 1.0, float("inf")), (2000, 7, 8.0, 4.0)]
    products.write_variance(spark.createDataFrame(rows, CELLS), path)
    got = {(r.tile, r.local): (r.variance, r.ivar) for r in products.read_tiles(spark, path).collect()}
    assert got[5, 0] == (0.5, 2.0) and got[2000, 7] == (0.5, 2.0)
    assert len(got) == 6 and all(math.isnan(x) for k in range(1, 5) for x in got[5, k])


def test_a_tile_without_variance_is_refused(spark, tmp_path):
    path = f"file://{tmp_path}/v"
    rows = [(1, 0, 2.0, 2.0), (2, 0, 0.0, 2.0), (2, 1, float("nan"), 2.0)]
    with pytest.raises(ValueError, match=r"without valid variance: \[2\]"):
        products.write_variance(spark.createDataFrame(rows, CELLS), path)
    assert not (tmp_path / "v").exists()


@pytest.fixture(scope="module")
def signal(spark, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('signal')}/s"
    products.write_pixels(spark.range(40 * 16).selectExpr("id div 16 * 100 AS tile", "id % 16 AS local", "id * 0.5D AS signal"), path)
    return path


def test_a_leaf_opens_its_tile_alone(spark, signal):
    one = products.read_leaf(spark, signal, 700 * 16 + 3, depth=2)
    assert [tuple(r) for r in one.collect()] == [(700, 3, (7 * 16 + 3) * 0.5)]
    assert products.read_leaf(spark, signal, 701 * 16, depth=2).isEmpty() and products.read_leaf(spark, signal, 10**9, depth=2).isEmpty()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(region" in plan and "EqualTo(tile,700)" in plan and "EqualTo(local,3)" in plan


def test_many_leaves_keep_those_not_there(spark, signal):
    wanted = [(k, leaf) for k, leaf in enumerate([0, 15, 16, 1600, 1601, 3900 * 16 + 15, 3900 * 16 + 16, None, 1600])]
    got = {r.id: r.signal for r in products.read_leaves(spark, signal, spark.createDataFrame(wanted, "id long, leaf long"), depth=2).collect()}
    assert got == {0: 0.0, 1: 7.5, 2: None, 3: 8.0, 4: 8.5, 5: (39 * 16 + 15) * 0.5, 6: None, 7: None, 8: 8.0}
