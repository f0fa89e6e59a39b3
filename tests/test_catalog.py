"""The catalog of cells: cones equal a plain scan, folders and row groups are pruned."""

from __future__ import annotations

import glob
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.sources import catalog as sc


@pytest.fixture(scope="module")
def stars(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    z, ra = rng.uniform(-1, 1, 20000), rng.uniform(0, 360, 20000)
    rows = [(i, float(a), float(np.degrees(np.arcsin(s)))) for i, (a, s) in enumerate(zip(ra, z, strict=True))] + [(90001, None, 1.0), (90002, 0.0, 90.0), (90003, 359.9999, -90.0), (90004, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "source_id long, ra double, dec double").repartition(3)
    path = f"{tmp_path_factory.mktemp('catalog')}/c"
    sc.write_catalog(df, path)
    return rows, path


def _gap(a, d, ra, dec):
    c = math.sin(math.radians(d)) * math.sin(math.radians(dec)) + math.cos(math.radians(d)) * math.cos(math.radians(dec)) * math.cos(math.radians(a - ra))
    return math.degrees(math.acos(max(-1, min(1, c))))


CONES = [(0.0, 0.0, 3.0), (359.0, 89.5, 2.0), (12.0, -90.0, 5.0), (200.0, 41.8, 0.5), (77.0, -30.0, 60.0), (10.0, 10.0, 1e-6)]


def test_cones_are_those_of_a_scan(spark, stars):
    rows, path = stars
    good = [r for r in rows if r[1] is not None and not math.isnan(r[1])]
    for ra, dec, radius in CONES:
        got = {r.source_id for r in sc.read_cone(spark, path, ra, dec, radius).collect()}
        assert got == {i for i, a, d in good if _gap(a, d, ra, dec) <= radius}
    points = spark.createDataFrame([(k, *c[:2]) for k, c in enumerate(CONES)], "k int, ra0 double, dec0 double")
    many = {(r.k, r.source_id) for r in sc.read_cones(spark, path, points, 2.5).collect()}
    assert many == {(k, i) for k, c in enumerate(CONES) for i, a, d in good if _gap(a, d, *c[:2]) <= 2.5}


def test_a_small_cone_reads_a_small_share(spark, stars):
    _, path = stars
    near = sc.read_cone(spark, path, 200.0, 41.8, 0.5)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "region" in plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "GreaterThanOrEqual(cell" in plan
    read = near.select(F.input_file_name().alias("f")).distinct().collect()
    assert len({r.f.rsplit("/", 2)[1] for r in read}) <= 4
    assert len(glob.glob(f"{path}/region=*")) > 700


def test_ranges_hold_all_cells():
    rng = np.random.default_rng(2)
    cells = rng.integers(0, 10**6, 500)
    for most in (1, 7, 1000):
        got = sc._ranges(cells, most)
        assert len(got) <= most and all(any(a <= c <= b for a, b in got) for c in cells)


def test_cones_of_stars_at_one_place_are_compared_once(spark, tmp_path):
    from skyloom.sources.catalog import cone_places

    rows = [(i, float(i % 5), 10.0) for i in range(40)]
    path = f"{tmp_path}/c"
    sc.write_catalog(spark.createDataFrame(rows, "source_id long, ra double, dec double"), path)
    points = spark.createDataFrame([(k, 2.0, 10.0) for k in range(3)] + [(9, None, 1.0)], "k int, ra0 double, dec0 double")
    near = cone_places(spark, path, points, 1.5, F.col("source_id"), F.col("k")).collect()
    assert sorted((sorted(r.points), sorted(r.stars)) for r in near) == [([0, 1, 2], list(range(f, 40, 5))) for f in (1, 2, 3)]
    got = sc.read_cones(spark, path, points, 1.5)
    assert sorted((r.k, r.source_id) for r in got.collect()) == [(k, i) for k in range(3) for i in range(40) if i % 5 in (1, 2, 3)]
    assert set(got.columns) == {"k", "ra0", "dec0", "source_id", "ra", "dec", "dist"}


def test_a_catalog_is_written_by_many_tasks(spark, tmp_path):
    star = spark.range(2000).select(F.col("id").alias("source_id"), (F.col("id") % 360).cast("double").alias("ra"), (F.col("id") % 170 - 85).cast("double").alias("dec"))
    sc.write_catalog(star, f"{tmp_path}/c")
    tasks = {f.rsplit("/part-", 1)[1][:5] for f in glob.glob(f"{tmp_path}/c/region=*/*.parquet")}
    assert len(tasks) >= 12  # of the 16 on four cores; adaptive execution would make them one
