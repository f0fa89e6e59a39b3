"""Shared helpers: the folder that all executors see, lineage cuts, hashing of UTF-8 batches."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT = "spark.checkpoint.dir"
U64 = np.uint64


def shared_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under spark.checkpoint.dir; where that is unset (tests), under a temporary folder."""
    base = spark.conf.get(CHECKPOINT, None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT} must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="skyloom-")
        spark.conf.set(CHECKPOINT, base)
    return f"{base.rstrip('/')}/skyloom/{label}-{uuid.uuid4().hex}"


_OPEN: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that `cut` writes inside are deleted at the end; a result must be cut after it, or be read by then."""
    _OPEN.append([])
    try:
        yield
    finally:
        for path in _OPEN.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """Write df to the shared folder and read it back: lineage ends there, and no executor's loss undoes it. keep: beyond the enclosing scratch."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    if _OPEN and not keep:
        _OPEN[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """name, with underscores put before it until df has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary Arrow array, without a copy."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type):
        kind = np.int64
    else:
        kind = np.int32
    _, off, data = arr.buffers()
    n = len(arr)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, kind, n + 1 + arr.offset)[arr.offset :].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(offsets: np.ndarray, limit: int):
    """Consecutive ranges of rows whose bytes stay within limit; a longer row is a range of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public-domain splitmix constants)."""
    x = x.astype(U64, copy=True)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream_groups(batches, key: str):
    """Regroup sorted Arrow batches so that no run of equal keys is split between two yielded tables."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(b.schema.get_field_index(key))
        last = keys[-1]
        if held and held[0].column(held[0].schema.get_field_index(key))[0] == last:
            held.append(b)
            continue
        k = np.asarray(keys)
        start = int(np.flatnonzero(k != k[-1])[-1]) + 1 if (k != k[-1]).any() else 0
        ready = [*held, b.slice(0, start)] if start else held
        if ready:
            yield pa.Table.from_batches(ready)
        held = [b.slice(start)]
    if held:
        yield pa.Table.from_batches(held)
