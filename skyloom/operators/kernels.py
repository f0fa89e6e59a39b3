"""Array kernels over blocks: the two-dimensional Fourier transform, and the product of a sparse matrix and a vector."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_PART = "array<struct<xb:int,re:array<double>,im:array<double>>>"


def fourier(pixels: DataFrame, by: list[str], width: int, height: int, block: int = 64, value: str = "value") -> DataFrame:
    """(*by, u, v, re, im): the discrete Fourier transform of images of width by height pixels (*by, x, y, value); missing and null pixels are 0.

    `block` rows are transformed in one step and cut into blocks of columns; these are exchanged, put together to `block`
    whole columns and transformed along y. No task holds more of an image than a strip of block rows or columns.
    """
    strips = pixels.where(F.col(value).isNotNull() & F.col("x").between(0, width - 1) & F.col("y").between(0, height - 1)).groupBy(*by, F.floor(F.col("y") / block).cast("int").alias("__yb"))
    listed = strips.agg(F.collect_list(F.struct((F.col("y") % block).cast("int").alias("y"), F.col("x").cast("int").alias("x"), F.col(value).cast("double").alias("v"))).alias("__p"))

    @F.arrow_udf(_PART)
    def rows(points: pa.Array) -> pa.Array:
        out = []
        off = np.asarray(points.offsets)
        y, x, v = (points.values.field(c).to_numpy(zero_copy_only=False) for c in ("y", "x", "v"))
        for i, j in zip(off[:-1], off[1:], strict=True):
            strip = np.zeros((block, width))
            np.add.at(strip, (y[i:j], x[i:j]), v[i:j])
            f = np.fft.fft(strip, axis=1)
            out.append([{"xb": k, "re": f[:, a : a + block].real.ravel(), "im": f[:, a : a + block].imag.ravel()} for k, a in enumerate(range(0, width, block))])
        return pa.array(out, pa.list_(pa.struct([("xb", pa.int32()), ("re", pa.list_(pa.float64())), ("im", pa.list_(pa.float64()))])))

    parts = listed.select(*by, "__yb", F.explode(rows("__p")).alias("__s")).groupBy(*by, F.col("__s.xb").alias("__xb")).agg(F.collect_list(F.struct("__yb", "__s.re", "__s.im")).alias("__c"))

    @F.arrow_udf("array<struct<u:int,v:int,re:double,im:double>>")
    def columns(held: pa.Array, place: pa.Array) -> pa.Array:
        out = []
        for strips, k in zip(held, place.to_pylist(), strict=True):
            wide = min(block, width - k * block)
            whole = np.zeros((-(-height // block) * block, wide), complex)
            for s in strips:
                at = s["__yb"].as_py() * block
                whole[at : at + block] = (s["re"].values.to_numpy() + 1j * s["im"].values.to_numpy()).reshape(block, wide)
            f = np.fft.fft(whole[:height], axis=0)
            v, u = np.mgrid[0:height, 0:wide]
            flat = [pa.array((u + k * block).ravel().astype(np.int32)), pa.array(v.ravel().astype(np.int32)), pa.array(f.real.ravel()), pa.array(f.imag.ravel())]
            out.append(pa.StructArray.from_arrays(flat, ["u", "v", "re", "im"]))
        flat = pa.concat_arrays(out) if out else pa.array([], pa.struct([("u", pa.int32()), ("v", pa.int32()), ("re", pa.float64()), ("im", pa.float64())]))
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in out])]).astype(np.int32)), flat)

    return parts.select(*by, F.explode(columns("__c", "__xb")).alias("__f")).select(*by, "__f.*")


def sparse_product(entries: DataFrame, vector: DataFrame, block: int = 1024) -> DataFrame:
    """(row, value): the product of a matrix (row, col, value) and a vector (i, value), for rows with an entry. The vector goes to the entries in blocks of numbers, one row a block; places without a number count as 0, and of a place that stands twice the greater number counts."""
    once = vector.where(F.col("value").isNotNull()).groupBy("i").agg(F.max("value").alias("value"))
    held = once.groupBy(F.floor(F.col("i") / block).alias("__b")).agg(F.map_from_entries(F.collect_list(F.struct(F.pmod("i", F.lit(block)).cast("int").alias("k"), F.col("value").cast("double").alias("v")))).alias("__m"))
    blocks = held.select("__b", F.transform(F.sequence(F.lit(0), F.lit(block - 1)), lambda k: F.coalesce(F.try_element_at("__m", k), F.lit(0.0))).alias("__v"))
    met = entries.withColumn("__b", F.floor(F.col("col") / block)).join(blocks, "__b", "left")
    product = F.col("value") * F.coalesce(F.get("__v", F.pmod("col", F.lit(block)).cast("int")), F.lit(0.0))
    return met.groupBy("row").agg(F.sum(product).alias("value"))
