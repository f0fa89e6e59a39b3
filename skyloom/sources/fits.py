"""FITS images and binary tables: headers, pixels and rows, read through binaryFile so that any store works."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK, CARD = 2880, 80
# Fixed values of the format.
KINDS = {8: ">u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}
COLUMNS = {"L": "S1", "B": ">u1", "I": ">i2", "J": ">i4", "K": ">i8", "E": ">f4", "D": ">f8"}


def header(raw: bytes, at: int = 0) -> tuple[dict[str, str], int]:
    """Keywords and values as text, and where the data begins. Strings lose their quotes; comments go."""
    out: dict[str, str] = {}
    while at + CARD <= len(raw):
        card = raw[at : at + CARD].decode("ascii", "replace")
        at += CARD
        key = card[:8].strip()
        if key == "END":
            return out, -(-at // BLOCK) * BLOCK
        if card[8:10] == "= ":
            value = card[10:].strip()
            if value.startswith("'"):
                body, i = "", 1
                while i < len(value):
                    if value[i] == "'":
                        if value[i + 1 : i + 2] != "'":
                            break
                        i += 1
                    body += value[i]
                    i += 1
                out[key] = body.rstrip()
            else:
                out[key] = value.split("/")[0].strip()
    raise ValueError("a FITS header without END")


def data_size(h: dict[str, str]) -> int:
    axes = int(h.get("NAXIS", "0"))
    n = int(np.prod([int(h[f"NAXIS{i + 1}"]) for i in range(axes)])) if axes else 0
    return abs(int(h.get("BITPIX", "8"))) // 8 * n


def image(raw: bytes) -> np.ndarray:
    """The first image of a file as doubles, scaled by BSCALE and BZERO; BLANK is NaN."""
    at = 0
    while at < len(raw):
        h, at = header(raw, at)
        size = data_size(h)
        if int(h.get("NAXIS", "0")) >= 2 and "XTENSION" not in h or h.get("XTENSION") == "IMAGE":
            stored = np.frombuffer(raw, KINDS[int(h["BITPIX"])], size // (abs(int(h["BITPIX"])) // 8), at)
            v = stored.astype(float) * float(h.get("BSCALE", "1")) + float(h.get("BZERO", "0"))
            if "BLANK" in h:
                v[stored == int(h["BLANK"])] = np.nan
            return v.reshape(-1, int(h["NAXIS1"]))
        at += -(-size // BLOCK) * BLOCK
    raise ValueError("no image")


def rows(raw: bytes) -> pa.Table:
    """The first binary table of a file; numbers of one element each, and text."""
    at = 0
    while at < len(raw):
        h, at = header(raw, at)
        if h.get("XTENSION") == "BINTABLE":
            fields = []
            for i in range(1, int(h["TFIELDS"]) + 1):
                form = h[f"TFORM{i}"]
                repeat, code = int(form.rstrip("LABIJKED") or "1"), form[-1]
                fields.append((h.get(f"TTYPE{i}", f"col{i}"), f"S{repeat}" if code == "A" else COLUMNS[code]))
            t = np.frombuffer(raw, np.dtype(fields), int(h["NAXIS2"]), at)
            native = {n: t[n].astype(t[n].dtype.newbyteorder("=")) if t[n].dtype.kind != "S" else [x.decode("ascii", "replace").rstrip(" \0") for x in t[n]] for n in t.dtype.names}
            return pa.table(native)
        at += -(-data_size(h) // BLOCK) * BLOCK
    raise ValueError("no binary table")


def _cards(entries: list[tuple[str, object]]) -> bytes:
    text = "".join(f"{k:<8}= {('T' if v else 'F') if isinstance(v, bool) else repr(v) if isinstance(v, str) else v!s:>20}"[:CARD].ljust(CARD) for k, v in entries) + "END".ljust(CARD)
    return text.encode().ljust(-(-len(text) // BLOCK) * BLOCK)


def encode(v: np.ndarray, keywords: dict[str, object] | None = None) -> bytes:
    """A single-image file of doubles."""
    cards = [("SIMPLE", True), ("BITPIX", -64), ("NAXIS", 2), ("NAXIS1", v.shape[1]), ("NAXIS2", v.shape[0]), *(keywords or {}).items()]
    body = v.astype(">f8").tobytes()
    return _cards(cards) + body.ljust(-(-len(body) // BLOCK) * BLOCK, b"\0")


def read_headers(spark: SparkSession, path: str) -> DataFrame:
    """(path, header): the first header of each file, for metadata scans."""

    def run(batches):
        for b in batches:
            found = [list(header(x.as_py())[0].items()) for x in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(found, pa.map_(pa.string(), pa.string()))], ["path", "header"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, header map<string,string>")


def read_pixels(spark: SparkSession, path: str) -> DataFrame:
    """(path, y, x, value) of each file's first image; a file is decoded in one task and given out row by row."""

    def run(batches):
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                v = image(content.as_py())
                for y0 in range(0, len(v), 64):
                    part = v[y0 : y0 + 64]
                    y, x = np.indices(part.shape)
                    yield pa.record_batch([pa.array([name] * part.size), pa.array((y + y0).ravel().astype(np.int32)), pa.array(x.ravel().astype(np.int32)), pa.array(part.ravel())], ["path", "y", "x", "value"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(run, "path string, y int, x int, value double")


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of each file's first binary table, in the columns of schema."""
    names = spark.createDataFrame([], schema).columns

    def run(batches):
        for b in batches:
            for content in b.column(0):
                yield from rows(content.as_py()).select(names).to_batches()

    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)


def encoded_images(pixels: DataFrame, width: int, height: int, frame: str = "frame") -> DataFrame:
    """(frame, content): the FITS bytes of each frame's pixels; a missing pixel is NaN. One frame is what one task holds."""

    def run(key, t):
        v = np.full((height, width), np.nan)
        v[t.column("y").to_numpy(), t.column("x").to_numpy()] = t.column("value").to_numpy()
        return pa.table({frame: pa.array([key[0].as_py()], pa.int64()), "content": pa.array([encode(v, {"FRAME": key[0].as_py()})], pa.binary())})

    return pixels.select(F.col(frame).cast("long").alias(frame), "y", "x", "value").groupBy(frame).applyInArrow(run, f"{frame} long, content binary")
