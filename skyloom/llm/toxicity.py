"""Toxicity by multiple-instance learning: a document is toxic if a sentence is.

A sentence's probability is a logistic function of its hashed words and word beginnings; a document's is the
noisy-or of its sentences, 1 - prod(1 - p). The weights are trained on document labels through that noisy-or,
so the sentences that carry a label are found without sentence labels.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.llm.common import spans, text_or_empty, utf8
from skyloom.llm.words import runs, word_hashes

SPANS = "struct<score:double,sentences:array<struct<start:int,stop:int,p:double>>>"
_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[b for b in range(128) if not chr(b).isalnum()]] = True


@dataclass(frozen=True)
class Mil:
    """max_positive, max_negative, max_chars bound the labelled rows that the weights are fitted on; scoring reads every text whole. longest: a sentence of more words counts as several."""

    bits: int = 18
    beginning: int = 5
    longest: int = 64
    max_positive: int = 1000
    max_negative: int = 1600
    max_chars: int = 100_000
    min_docs: int = 4
    min_gain: float = 12.0
    rounds: int = 400
    ridge: float = 1e-3


def features(data: np.ndarray, offsets: np.ndarray, p: Mil) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sentence, feature) for each word and beginning, and each sentence's row; sentences are numbered over the batch."""
    s, e, row = runs(data, offsets, _BREAK)
    if not len(s):
        z = np.zeros(0, np.int64)
        return z, z, z
    ended = np.concatenate([[0], np.cumsum(_ENDS[data])])[s]
    new = np.concatenate([[False], (ended[1:] != ended[:-1]) | (row[1:] != row[:-1])])
    begins = np.concatenate([[0], np.flatnonzero(new)])
    new |= (np.arange(len(s)) - begins[np.cumsum(new)]) % p.longest == 0
    new[0] = False
    sentence = np.cumsum(new)
    whole = (word_hashes(data, s, e) >> np.uint64(64 - p.bits)).astype(np.int64)
    part = (word_hashes(data, s, np.minimum(e, s + p.beginning)) >> np.uint64(64 - p.bits)).astype(np.int64) + (1 << p.bits)
    return np.concatenate([sentence, sentence]), np.concatenate([whole, part]), row[np.concatenate([[0], np.flatnonzero(new)])]


def fit(sent: np.ndarray, feat: np.ndarray, doc: np.ndarray, y: np.ndarray, p: Mil) -> np.ndarray:
    """Weights of the features, the bias last. doc is each sentence's document."""
    size = 2 << p.bits
    pairs = np.unique(doc[sent].astype(np.int64) * size + feat)
    has = lambda rows: np.bincount(pairs[np.isin(pairs // size, rows)] % size, minlength=size).astype(float)
    n1, n0 = max(1, (y == 1).sum()), max(1, (y == 0).sum())
    k1, k0 = has(np.flatnonzero(y == 1)), has(np.flatnonzero(y == 0))
    a, b = (k1 + 0.5) / (n1 + 1), (k0 + 0.5) / (n0 + 1)
    gain = 2 * (k1 * np.log(a / b) + (n1 - k1) * np.log((1 - a) / (1 - b)))
    used = np.flatnonzero((k1 + k0 >= p.min_docs) & (gain > p.min_gain) & (a > b))
    slot = np.full(size, -1)
    slot[used] = np.arange(len(used))
    kept = slot[feat] >= 0
    at, col = np.divmod(np.unique(sent[kept].astype(np.int64) * size + slot[feat[kept]]), size)
    w, bias = np.full(len(used), 2.0), -8.0
    m, v = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
    for r in range(p.rounds):
        z = np.bincount(at, w[col], len(doc)) + bias
        q = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        none = np.exp(-np.bincount(doc, np.logaddexp(0, z), len(y)))
        pull = np.where(y == 1, none / np.maximum(1 - none, 1e-9), -1.0)[doc] * q / len(y)
        g = np.concatenate([np.bincount(col, pull[at], len(used)) - p.ridge * w / len(y), [pull.sum()]])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9 ** (r + 1))) / (np.sqrt(v / (1 - 0.99 ** (r + 1))) + 1e-9)
        w, bias = w + step[:-1], bias + step[-1]
    out = np.zeros(size + 1, np.float32)
    out[used], out[size] = w, bias
    return out


def train(docs: DataFrame, labels: DataFrame, p: Mil = Mil(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> np.ndarray:
    """Weights from labelled rows whose crc32(id) mod 5 is not 0. Rows without id, label or text are left out; without any, all scores are 0."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1) and crc32(cast(id as string)) % 5 != 0").groupBy("id").agg(F.max("y").alias("y"))
    pick = lambda y, n: known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(n)
    chosen = pick(1, p.max_positive).unionByName(pick(0, p.max_negative))

    def run(batches):
        for b in batches:
            data, off = utf8(b.column(1))
            for i, j in spans(off, 1 << 20):
                s, f, row = features(data[off[i] : off[j]], off[i : j + 1] - off[i], p)
                owner = row[s] if len(s) else s
                for k in range(j - i):
                    own = owner == k
                    base = s[own].min() if own.any() else 0
                    yield pa.record_batch([b.column(0).slice(i + k, 1), pa.array([(s[own] - base).astype(np.int32).tobytes()]), pa.array([f[own].astype(np.int32).tobytes()])], ["y", "s", "f"])

    text = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text")).where(F.length("text").between(1, p.max_chars))
    got = text.join(F.broadcast(chosen), "id").select("y", "text").mapInArrow(run, "y int, s binary, f binary").toArrow()  # the limits above bound both
    sent, feat, doc, n = [], [], [], 0
    for k, (s, f) in enumerate(zip(got.column("s").to_pylist(), got.column("f").to_pylist(), strict=True)):
        s = np.frombuffer(s, np.int32)
        count = int(s.max()) + 1 if len(s) else 0
        sent.append(s + np.int32(n))
        feat.append(np.frombuffer(f, np.int32))
        doc.append(np.full(count, k, np.int32))
        n += count
    if not n or len(set(got.column("y").to_pylist())) < 2:
        return np.append(np.zeros(2 << p.bits, np.float32), np.float32(-30))
    return fit(np.concatenate(sent), np.concatenate(feat), np.concatenate(doc), np.array(got.column("y").to_pylist()), p)


def scorer(spark, weights: np.ndarray, p: Mil = Mil()):
    """A function of a text column: struct(score, sentences), the latter those of probability 0.5 or more, as character ranges of the text."""
    held = spark.sparkContext.broadcast(weights)  # 2 << bits numbers, whatever the input

    @F.arrow_udf(returnType=SPANS)
    def score(text: pa.Array) -> pa.Array:
        w, parts = held.value, []
        data, off = utf8(text.cast(pa.string()))
        for i, j in spans(off, 1 << 20):
            raw, o = data[off[i] : off[j]], off[i : j + 1] - off[i]
            s, f, row = features(raw, o, p)
            told = np.flatnonzero(w[f])
            at = np.unique(s[told] * len(w) + f[told])  # of a sentence each feature counts once
            z = np.bincount(at // len(w), w[at % len(w)], len(row)) + w[-1] if len(row) else np.zeros(0)
            none = np.exp(-np.bincount(row, np.logaddexp(0, z), j - i)) if len(row) else np.ones(j - i)
            bad: list[list[dict]] = [[] for _ in range(j - i)]
            if (z >= 0).any():
                starts, stops, _ = runs(raw, o, _BREAK)
                half = len(s) // 2
                chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
                for k in np.flatnonzero(z >= 0):
                    a, b = np.searchsorted(s[:half], [k, k + 1])
                    zero = chars[o[row[k]]]
                    bad[row[k]].append({"start": int(chars[starts[a]] - zero), "stop": int(chars[stops[b - 1]] - zero), "p": float(1 / (1 + np.exp(-z[k])))})
            parts.append(pa.StructArray.from_arrays([pa.array(np.clip(1 - none, 0, 1)), pa.array(bad, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())])))], ["score", "sentences"]))
        return pa.concat_arrays(parts) if parts else pa.array([], T_ARROW)

    return lambda col: score(F.coalesce(col.cast("string"), F.lit("")))


T_ARROW = pa.struct([("score", pa.float64()), ("sentences", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())])))])


def score_documents(docs: DataFrame, labels: DataFrame, p: Mil = Mil(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted, sentences) for every row; null and empty texts score 0, a null id isn't held out."""
    score = scorer(docs.sparkSession, train(docs, labels, p, id_col, text_col), p)
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), score(F.col(text_col)).alias("t"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return out.select("doc_id", held.alias("held_out"), F.col("t.score").alias("score"), (F.col("t.score") >= 0.5).cast("int").alias("predicted"), F.col("t.sentences").alias("sentences"))
