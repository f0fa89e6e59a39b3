"""The pipeline on rows with nulls, empty and long texts, repeated rows and clashing columns: each stage against a plain version of its decision, on its own input."""

from __future__ import annotations

import collections
import functools
import re

import numpy as np
import pytest

import corpus_pipeline
from skyloom.llm import mixing, queries, toxicity
from skyloom.llm.words import word_hashes
from test_operators import near_plainly, prose, shingles

CLASH = ["__score", "__site", "__dropped", "__count", "__post", "__copy", "cid", "bucket", "key", "r", "row", "piece"]
FIELDS = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)


def _rows():
    base = prose(1, 200).split()
    rows = [(0, " ".join(base)), (1, " ".join([*base[:100], "anders", *base[101:]])), (2, " ".join(base)), (3, None), (4, ""), (5, "  \n\t"), (6, "solo"), (7, "solo"), (8, "zwei worte"), (8, "zwei worte"), (None, "senza " + prose(3, 40)), (None, " ".join(base)), (9, prose(4, 300_000))]
    rows += [(20 + i, f"{prose(50 + i, 40)}.\nmenu home contatti\n" + (f"you stupid worthless idiot {prose(90 + i, 4)}." if i % 3 == 0 else prose(90 + i, 9))) for i in range(90)]
    return [(i, t, ["en", "fr", None][k % 3], "a" if k % 2 else None, len(t or ""), *["x"] * len(CLASH)) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """(rows, columns) before the first and after each stage."""
    at = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(_rows(), FIELDS).repartition(3).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(20 + i, 1, int(i % 3 == 0)) for i in range(90)] + [(None, 1, 1), (0, 0, None)], "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    out = [(docs.collect(), docs.columns)]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, at).write.parquet(f"{at}/{k}")
        docs = spark.read.parquet(f"{at}/{k}")
        out.append((docs.collect(), docs.columns))
    weights = toxicity.train(spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet"))
    return out, weights, at


def _texts(rows):
    return sorted((repr(r.doc_id), repr(r.text)) for r in rows)


@functools.cache
def _features(word, p):
    raw = np.frombuffer(word.encode(), np.uint8)
    return [(int(word_hashes(raw, np.array([0]), np.array([stop]))[0]) >> (64 - p.bits)) + base for stop, base in ((len(raw), 0), (min(len(raw), p.beginning), 1 << p.bits))]


def noisy_or(text, weights, p=toxicity.Mil()):
    """1 - prod(1 - p) over sentences, sentence by sentence and word by word."""
    none = 1.0
    for sentence in re.split(r"[.!?\n]", text or ""):
        words = re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", sentence)
        for i in range(0, len(words), p.longest):
            z = float(weights[-1]) + sum(float(weights[f]) for f in {f for w in words[i : i + p.longest] for f in _features(w, p)})
            none *= 1 - 1 / (1 + np.exp(-z))
    return 1 - none


def test_columns_stay_until_the_last_stage(stages):
    out, _, _ = stages
    assert all(columns == out[0][1] for _, columns in out[:-1])


def test_toxicity(stages):
    out, weights, _ = stages
    kept = [r for r in out[0][0] if noisy_or(r.text, weights) < 0.5]
    assert _texts(kept) == _texts(out[1][0])
    gone = {r.doc_id for r in out[0][0]} - {r.doc_id for r in out[1][0]}
    assert {20 + i for i in range(0, 90, 3)} <= gone and len(gone) <= 31


def test_line_dedup(stages):
    out, _, _ = stages
    pages, seen = collections.defaultdict(set), collections.defaultdict(set)
    for r in out[1][0]:
        pages[r.source or ""].add(r.text or "")
        for line in (r.text or "").split("\n"):
            if line.strip(" "):
                seen[r.source or "", line].add(r.text or "")
    bad = {k for k, v in seen.items() if len(v) >= 2 and len(v) * 100 > 5 * len(pages[k[0]])}
    want = [(repr(r.doc_id), repr(None if r.text is None else "\n".join(x for x in r.text.split("\n") if (r.source or "", x) not in bad))) for r in out[1][0]]
    assert bad and sorted(want) == _texts(out[2][0])
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out[2][0])


def test_near_dedup(stages, monkeypatch):
    out, _, _ = stages
    rows = [(r.doc_id, r.text) for r in out[2][0]]
    small = [(i, t) for i, t in rows if len(shingles(t)) < 10_000]
    component = {i: c for i, _, c in near_plainly(small)}
    gone = {i for i, c in component.items() if i != "None" and c != i}
    kept = [(repr(i), repr(t)) for i, t in rows if repr(i) not in gone]
    assert {"1", "2", "7"} <= gone and sorted(kept) == _texts(out[3][0])


def test_mixing(spark, stages):
    out, _, at = stages
    assert {r.doc_id for r in out[3][0]} == {r.doc_id for r in out[4][0]}
    rates = mixing.rates(spark.read.parquet(f"{at}/2"), spark.read.parquet(f"{at}/labels.parquet")).where("doc_id is not null").collect()
    times = collections.Counter()
    for r in rates:
        times[r.doc_id] += r.copies
    assert collections.Counter(r.doc_id for r in out[4][0] if r.doc_id is not None) == times


def test_packing(stages):
    from tokenizers import Tokenizer

    out, _, _ = stages
    t = Tokenizer.from_file(queries.tokenizer_path())
    want = collections.Counter()
    for r in out[4][0]:
        n = len(t.encode(r.text or "", add_special_tokens=False).ids) + 1
        want.update((r.doc_id, k, min(4096, n - 4096 * k)) for k in range(-(-n // 4096)))
    assert collections.Counter((r.doc_id, r.piece, r.length) for r in out[5][0]) == want
    bins = collections.defaultdict(list)
    for r in out[5][0]:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        b.sort()
        assert all(o == sum(n for _, n in b[:k]) for k, (o, _) in enumerate(b)) and sum(n for _, n in b) <= 4096


def test_run_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.count() == 0 and "sequence_id" in got.columns
