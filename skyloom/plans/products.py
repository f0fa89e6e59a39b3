"""Queries of sources, sinks and streams; each writes under the shared folder and reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from skyloom.functions import healpix as hp
from skyloom.plans.geometry import ang2pix_sql, distance_sql
from skyloom.plans.registry import query
from skyloom.plans.roles import CATALOG, IMAGE, POINTINGS, catalog, image, pointings, table
from skyloom.session import shared_base
from skyloom.sources import catalog as star_catalog
from skyloom.sources import fits, products, text
from skyloom.streaming import incremental

C = F.col


def _folder(spark, name):
    return f"{shared_base(spark)}/skyloom/{name}-{uuid.uuid4().hex}"


_TILES = f"WITH {CATALOG}, {ang2pix_sql(6, 'cat', 'source_id, mag')}, t AS (SELECT pix AS tile, avg(mag) AS signal, least(1, count(*) / 3.0::DOUBLE) AS support FROM px GROUP BY pix)"


def _tiles(spark, sf):
    p = catalog(spark, sf).withColumn("tile", hp.ang2pix(6, C("ra"), C("dec")))
    return p.groupBy("tile").agg(F.avg("mag").alias("signal"), F.least(F.lit(1.0), F.count("*") / 3).alias("support"))


@query("snk_hips_image", f"{_TILES} SELECT tile, round(signal, 9) AS signal, round(support, 9) AS support FROM t")
def tiles_round_trip(spark, sf):
    path = _folder(spark, "tiles")
    products.write_tiles(_tiles(spark, sf), path)
    return products.read_tiles(spark, path).select("tile", F.round("signal", 9).alias("signal"), F.round("support", 9).alias("support"))


@query("src_hips_tile", f"{_TILES} SELECT tile, round(signal, 9) AS signal FROM t WHERE tile IN (SELECT tile FROM t ORDER BY tile LIMIT 5)")
def some_tiles(spark, sf):
    path = _folder(spark, "tiles")
    products.write_tiles(_tiles(spark, sf), path)
    wanted = [r.tile for r in products.read_tiles(spark, path).select("tile").orderBy("tile").limit(5).collect()]
    return products.read_tiles(spark, path, wanted).select("tile", F.round("signal", 9).alias("signal"))


@query("snk_props", f"{_TILES} SELECT count(*) AS tiles, round(avg(support), 9) AS mean_support, round(min(signal), 9) AS data_min, round(max(signal), 9) AS data_max, round(count(*) / 49152.0, 9) AS sky_fraction, 6 AS hips_order FROM t")
def props(spark, sf):
    m = products.metadata(_tiles(spark, sf), 6)
    return m.select("tiles", *[F.round(c, 9).alias(c) for c in ("mean_support", "data_min", "data_max", "sky_fraction")], "hips_order")


@query("snk_moc", f"{_TILES} SELECT tile, 16384 + tile AS uniq FROM t")
def moc(spark, sf):
    return _tiles(spark, sf).select("tile", hp.uniq(6, C("tile")).alias("uniq"))


@query("snk_hips_snr", f"WITH {CATALOG}, {ang2pix_sql(3, 'cat', 'source_id, mag')} SELECT pix AS tile, count(*) AS stars, round(max(mag), 6) AS best FROM px GROUP BY pix")
def snr_tiles(spark, sf):
    path = _folder(spark, "snr")
    p = catalog(spark, sf).withColumn("tile", hp.ang2pix(3, C("ra"), C("dec")))
    products.write_tiles(p, path, levels=1)
    return products.read_tiles(spark, path).groupBy("tile").agg(F.count("*").alias("stars"), F.round(F.max("mag"), 6).alias("best"))


@query("src_fits", f"WITH {IMAGE} SELECT frame, count(*) AS pixels, round(sum(value), 4) AS total, round(max(value), 4) AS most FROM im GROUP BY frame")
def fits_round_trip(spark, sf):
    """Frames as FITS bytes in a binary column, decoded again."""
    import pyarrow as pa

    def run(batches):
        import numpy as np

        for b in batches:
            for frame, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                v = fits.image(content)
                good = v[np.isfinite(v)]
                yield pa.record_batch([pa.array([int(fits.header(content)[0]["FRAME"])], pa.int64()), pa.array([good.size], pa.int64()), pa.array([good.sum()]), pa.array([good.max()])], ["frame", "pixels", "total", "most"])

    got = fits.encoded_images(image(spark, sf), 64, 64).mapInArrow(run, "frame long, pixels long, total double, most double")
    return got.select("frame", "pixels", F.round("total", 4).alias("total"), F.round("most", 4).alias("most"))


@query("src_hips_props", "SELECT n_name AS key, concat('region ', n_regionkey) AS value FROM nation")
def read_props(spark, sf):
    path = _folder(spark, "properties")
    table(spark, sf, "nation").select(F.concat(C("n_name"), F.lit(" = region "), C("n_regionkey").cast("string")).alias("value")).write.text(path)
    return text.properties(spark, path).select("key", "value")


@query("src_snr_tsv", f"WITH {CATALOG} SELECT CASE WHEN source_id % 50 <> 0 THEN source_id END AS star_id, round(CASE WHEN source_id % 50 <> 0 THEN mag END, 6) AS snr, source_id % 50 = 0 AS bad FROM cat")
def read_snr(spark, sf):
    path = _folder(spark, "snr-tsv")
    line = F.concat_ws("\t", C("source_id").cast("string"), C("ra").cast("string"), C("dec").cast("string"), C("mag").cast("string"), F.lit("1"), F.lit("0"))
    catalog(spark, sf).select(F.when(C("source_id") % 50 == 0, F.lit("broken line")).otherwise(line).alias("value")).write.text(path)
    return text.snr_catalog(spark, path).select("star_id", F.round("snr", 6).alias("snr"), C("malformed").isNotNull().alias("bad"))


@query("src_roman_tsv", "SELECT (n_nationkey % 24)::DOUBLE AS ra_low, (n_nationkey % 24 + 1)::DOUBLE AS ra_up, (n_nationkey - 12)::DOUBLE AS de_low, n_name AS const FROM nation")
def read_bounds(spark, sf):
    path = _folder(spark, "bounds")
    k = C("n_nationkey")
    lines = table(spark, sf, "nation").select(F.concat_ws("\t", (k % 24).cast("string"), (k % 24 + 1).cast("string"), (k - 12).cast("string"), "n_name").alias("value"))
    heads = spark.createDataFrame([("# boundaries",), ("RA_low\tRA_up\tDE_low\tconst",), ("h\th\tdeg\t",), ("---\t---\t---\t---",)], "value string")
    lines.unionByName(heads).write.text(path)
    return text.boundaries(spark, path)


@query("snk_diag", "SELECT count(*) AS samples, count(*) FILTER (WHERE l_discount > 0.05) AS high, count(*) FILTER (WHERE l_tax = 0) AS untaxed, count(DISTINCT l_partkey) AS pixels, count(DISTINCT l_suppkey % 8) AS frames FROM lineitem")
def diagnostics(spark, sf):
    return table(spark, sf, "lineitem").agg(F.count("*").alias("samples"), F.count_if(C("l_discount") > 0.05).alias("high"), F.count_if(C("l_tax") == 0).alias("untaxed"), F.countDistinct("l_partkey").alias("pixels"), F.countDistinct(C("l_suppkey") % 8).alias("frames"))


@query("snk_controls", "SELECT l_partkey % 64 AS control, count(DISTINCT l_suppkey % 8) >= 2 AS accepted FROM lineitem GROUP BY ALL")
def accepted_controls(spark, sf):
    return table(spark, sf, "lineitem").groupBy((C("l_partkey") % 64).alias("control")).agg((F.countDistinct(C("l_suppkey") % 8) >= 2).alias("accepted"))


@query("st_incremental_stack", "SELECT event_id % 512 AS pix, count(*) AS n, round(avg(value), 8) AS mean FROM events GROUP BY ALL")
def incremental_stack(spark, sf):
    """Events arrive as files; each micro-batch adds its sums, and the stack is the sum of all."""
    base = _folder(spark, "stream")
    events = table(spark, sf, "events")
    rows = events.select((C("event_id") % 512).alias("pix"), C("value").alias("v"), F.lit(1.0).alias("w"))
    rows.repartition(3).write.parquet(f"{base}/in")
    incremental.stack_new_files(spark, f"{base}/in", rows.schema, f"{base}/out", f"{base}/checkpoint", "pix").awaitTermination()
    return incremental.stacked(spark, f"{base}/out", "pix").select("pix", "n", F.round("mean", 8).alias("mean"))


@query("src_gaia", f"WITH {CATALOG}, {POINTINGS}, near AS (SELECT *, {distance_sql('ra', 'dec', 'ra0', 'dec0')} AS dist FROM pt CROSS JOIN cat) SELECT point_id, source_id, round(dist, 6) AS dist FROM near WHERE dist <= 6")
def catalog_cones(spark, sf):
    """The stars written as a catalog of cells, and the cones of all pointings read back from it."""
    path = _folder(spark, "catalog")
    star_catalog.write_catalog(catalog(spark, sf), path)
    near = star_catalog.cone_places(spark, path, pointings(spark, sf), 6.0, C("source_id"), C("point_id")).withColumn("dist", F.round("dist", 6))
    return near.select("points", F.explode("stars").alias("source_id"), "dist").select(F.explode("points").alias("point_id"), "source_id", "dist")


@query("src_gaia_cone", f"WITH {CATALOG}, near AS (SELECT *, {distance_sql('ra', 'dec', '123.4::DOUBLE', '41.0::DOUBLE')} AS dist FROM cat) SELECT source_id, round(dist, 6) AS dist FROM near WHERE dist <= 25")
def catalog_cone(spark, sf):
    """One cone of that catalog, by the folders and row groups that it reaches."""
    path = _folder(spark, "catalog")
    star_catalog.write_catalog(catalog(spark, sf), path)
    return star_catalog.read_cone(spark, path, 123.4, 41.0, 25.0).select("source_id", F.round("dist", 6).alias("dist"))
