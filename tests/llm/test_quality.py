"""The compression classifier against plain Python: sizes, the logistic function, held-out rows, odd input."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import zstandard

from skyloom.llm import quality

P = quality.Compression(segment=64, dictionary=4096, max_class=60, max_calibration=80)


def _text(rng, good):
    words = ["river", "stone", "garden", "window", "morning", "letter", "quiet", "market"]
    line = [rng.choice(words) + str(rng.randrange(20)) for _ in range(rng.randrange(20, 80))]
    return " ".join(line) if good else " | ".join(w.upper() + "!!" for w in line)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    return [(i, _text(rng, i % 4 > 0), int(i % 4 > 0)) for i in range(400)]


@pytest.fixture(scope="module")
def tables(spark, rows):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "river1"), (902, "x" * 300_000), (3, rows[3][1])], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows[:350]] + [(900, 1, 0), (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def _plain(text, m):
    """The score of one text, segment by segment."""
    raw, saved = text.encode(), 0
    for i in range(0, len(raw), m.params.segment):
        for d, sign in ((m.bad, 1), (m.good, -1)):
            c = zstandard.ZstdCompressor(level=m.params.level, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False)
            saved += sign * len(c.compress(raw[i : i + m.params.segment]))
    x = min((saved + m.params.pseudo * m.usual) / (len(raw) + m.params.pseudo), m.usual)
    return 1 / (1 + math.exp(-(m.slope * x + m.bias)))


def test_scores_are_those_of_a_plain_loop(tables, rows):
    docs, labels = tables
    m = quality.train(docs, labels, P)
    assert m.good and m.bad and m.slope > 0
    got = quality.score_documents(docs, labels, P).collect()
    assert len(got) == 405
    text = {i: t for i, t, _ in rows} | {900: "", 901: "", None: "river1", 902: "x" * 300_000}
    for r in got:
        assert r.score == pytest.approx(_plain(text[r.doc_id], m), abs=1e-9)
        assert r.predicted == int(r.score >= 0.3)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    right = [(r.predicted, y) for r in got for i, _, y in rows if r.doc_id == i and r.held_out]
    assert len(right) > 40 and all(a == b for a, b in right)


def test_sample_leaves_held_out_rows_alone(tables):
    docs, labels = tables
    got = quality.sample(docs, labels, P).collect()
    assert got and all(zlib.crc32(str(r.id).encode()) % 5 for r in got)
    assert len({r.id for r in got}) == len(got)
    assert sum(not r.held and r.y == 1 for r in got) <= 60 and sum(r.held for r in got) <= 80
    other = quality.sample(docs, labels.withColumn("lang", labels.doc_id).withColumn("text", labels.doc_id), P)
    assert sorted(r.id for r in other.collect()) == sorted(r.id for r in got)


def test_logistic_is_calibrated():
    rng = np.random.default_rng(2)
    x = rng.normal(0, 0.05, 4000)
    y = (rng.random(4000) < 1 / (1 + np.exp(-(30 * x + 1)))).astype(float)
    slope, bias = quality._logistic(x, y, 1e-3)
    q = 1 / (1 + np.exp(-(slope * x + bias)))
    assert (slope, bias) == (pytest.approx(30, rel=0.15), pytest.approx(1, rel=0.15))
    assert q.mean() == pytest.approx(y.mean(), abs=1e-3)


def test_without_labels_or_rows(spark, tables):
    docs, labels = tables
    assert {r.score for r in quality.score_documents(docs, labels.limit(0), P).collect()} == {0.5}
    assert {round(r.score, 2) for r in quality.score_documents(docs, labels.where("quality = 1"), P).collect()} == {0.99}
    assert quality.score_documents(docs.limit(0), labels, P).count() == 0
    few = spark.createDataFrame([(1, "aaa bbb"), (2, "ccc"), (4, "bbb")], "doc_id long, text string")
    assert quality.score_documents(few, spark.createDataFrame([(1, 1), (2, 0), (4, 1)], "doc_id long, quality int"), P).count() == 3
