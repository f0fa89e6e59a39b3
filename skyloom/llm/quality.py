"""Quality by compression: text is good if a dictionary of good text compresses it better than one of bad text.

Two zstandard dictionaries are built from labelled text. Every text is compressed whole under both, in segments of
`segment` bytes each on its own, so that a dictionary tells as much at a long text's end as at its start. The size under
the bad dictionary less that under the good one, over the text's length, is drawn towards the usual value of good text
as if `pseudo` more bytes had it, which decides short texts; a logistic function makes it a probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyloom.llm.common import text_or_empty


@dataclass(frozen=True)
class Compression:
    """max_class: rows of each label behind a dictionary. max_calibration: rows, of other documents, behind the logistic function. max_chars: longer texts are not fitted on; scoring reads every text whole."""

    segment: int = 1024
    level: int = 3
    dictionary: int = 112_640
    pseudo: float = 200.0
    max_class: int = 2000
    max_calibration: int = 6000
    max_chars: int = 50_000
    ridge: float = 1e-3


@dataclass(frozen=True)
class Model:
    """good, bad: dictionaries, both empty where a label was missing. usual: the difference that good text has. slope, bias: of the logistic function."""

    good: bytes
    bad: bytes
    usual: float
    slope: float
    bias: float
    params: Compression


def dictionary(texts: list[bytes], p: Compression) -> bytes:
    """Trained on the texts' segments; of too few for that, their last bytes."""
    parts = [t[i : i + p.segment] for t in texts for i in range(0, len(t), p.segment)]
    try:
        return zstandard.train_dictionary(p.dictionary, parts, level=p.level).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(parts)[-p.dictionary :]


class _Sizes:
    def __init__(self, held: bytes, p: Compression):
        d = zstandard.ZstdCompressionDict(held)  # without a trained dictionary's magic number it is raw content
        d.precompute_compress(level=p.level)
        self.p, self.compress = p, zstandard.ZstdCompressor(level=p.level, dict_data=d, write_checksum=False, write_content_size=False, write_dict_id=False).compress

    def of(self, text: bytes) -> int:
        view, step = memoryview(text), self.p.segment
        return sum(len(self.compress(view[i : i + step])) for i in range(0, len(text), step))


def _differences(texts, good: _Sizes, bad: _Sizes) -> tuple[np.ndarray, np.ndarray]:
    """Of each text the bytes that the good dictionary saves, and the length."""
    return np.array([bad.of(t) - good.of(t) for t in texts], float), np.array([len(t) for t in texts], float)


def _drawn(saved: np.ndarray, length: np.ndarray, usual: float, p: Compression) -> np.ndarray:
    """The normalised difference; beyond the usual value a larger one says no more."""
    return np.minimum((saved + p.pseudo * usual) / (length + p.pseudo), usual)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[float, float]:
    """Slope and bias by Newton's method, on x in units of its spread."""
    mid, spread = x.mean(), x.std() or 1.0
    a, w = np.stack([(x - mid) / spread, np.ones(len(x))], 1), np.zeros(2)
    for _ in range(60):
        q = 1 / (1 + np.exp(-a @ w))
        step = np.linalg.solve((a * (q * (1 - q))[:, None]).T @ a + ridge * np.eye(2), a.T @ (y - q) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / spread), float(w[1] - w[0] * mid / spread)


def fit(texts: list[bytes], y: np.ndarray, held: np.ndarray, p: Compression = Compression()) -> Model:
    """held marks the rows that calibrate; the others make the dictionaries."""
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    pick = lambda k: [t for t, v, h in zip(texts, y, held, strict=True) if v == k and not h and t]
    good, bad = pick(1), pick(0)
    if not good or not bad:
        return Model(b"", b"", 0.0, 0.0, float(np.log(share / (1 - share))), p)
    good, bad = dictionary(good, p), dictionary(bad, p)
    rows = np.flatnonzero(held) if len(set(y[held])) == 2 else np.arange(len(y))
    saved, length = _differences([texts[i] for i in rows], _Sizes(good, p), _Sizes(bad, p))
    fine = (y[rows] == 1) & (length > 0)
    usual = float(np.median(saved[fine] / length[fine])) if fine.any() else 0.0
    slope, bias = _logistic(_drawn(saved, length, usual, p), y[rows].astype(float), p.ridge)
    return Model(good, bad, usual, slope, bias, p)


def scores(texts, model: Model) -> np.ndarray:
    if not model.good:
        return np.full(len(texts), 1 / (1 + np.exp(-model.bias)))
    x = _drawn(*_differences(texts, _Sizes(model.good, model.params), _Sizes(model.bad, model.params)), model.usual, model.params)
    return 1 / (1 + np.exp(-np.clip(model.slope * x + model.bias, -700, 700)))


def sample(docs: DataFrame, labels: DataFrame, p: Compression = Compression(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """(y, held, text) of the labelled rows to fit on: crc32(id) mod 5 is not 0; half of the ids calibrate. Of equal ids the larger label counts."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and crc32(cast(id as string)) % 5 != 0").groupBy("id").agg(F.max("y").alias("y"))
    known = known.withColumn("held", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 1)
    text = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).where(F.length("text").between(1, p.max_chars))
    known = known.join(text.select("id").distinct(), "id", "left_semi")
    first = lambda rows, n: rows.orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = first(known.where("not held and y = 1"), p.max_class).unionByName(first(known.where("not held and y = 0"), p.max_class)).unionByName(first(known.where("held"), p.max_calibration))
    one = text.join(F.broadcast(chosen), "id").groupBy("id", "y", "held").agg(F.min("text").alias("text"))  # at most 2 * max_class + max_calibration rows
    return one.select("id", "y", "held", "text")


def train(docs: DataFrame, labels: DataFrame, p: Compression = Compression(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """The model of a bounded sample of labelled rows. Rows without id, label or text are left out; where a label is missing, every score is the share of good rows (0.5 without rows)."""
    got = sample(docs, labels, p, id_col, text_col, label_col).orderBy("id").toArrow()  # bounded by the limits of the sample
    return fit([t.encode() for t in got.column("text").to_pylist()], np.array(got.column("y").to_pylist(), int), np.array(got.column("held").to_pylist(), bool), p)


def scorer(spark: SparkSession, model: Model):
    """A function of a text column: the probability of label 1."""
    held = spark.sparkContext.broadcast(model)  # two dictionaries of bounded size

    @F.arrow_udf(returnType="double")
    def score(text: pa.Array) -> pa.Array:
        return pa.array(scores([t.as_buffer() for t in text.cast(pa.large_binary())], held.value))

    return lambda col: score(F.coalesce(col.cast("string"), F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, p: Compression = Compression(), id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row; null and empty texts get the score of a text that says nothing, a null id isn't held out. Equal texts have equal scores."""
    good: Column = scorer(docs.sparkSession, train(docs, labels, p, id_col, text_col))(F.col(text_col))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), good.alias("score"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
