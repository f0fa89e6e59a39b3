"""Decisions of the pipeline's stages."""

from __future__ import annotations

import numpy as np

import corpus_pipeline
from skyloom.llm import mixing


def _edited(seed, n, edits):
    """A text of n words of its own, and the same with that many words changed, each more than five words from the next."""
    rng = np.random.default_rng(seed)
    w = [f"s{seed}w{x}" for x in rng.permutation(n)]
    v = list(w)
    for k in range(edits):
        v[10 + k * (n - 20) // edits] = f"s{seed}altro{k}"
    return " ".join(w), " ".join(v)


def test_near_dedup_links_from_080(spark):
    # 196 shingles: 4 edits leave 176 of 216 (0.815), 5 edits 171 of 221 (0.774)
    rows = [(2 * i + k, t) for i in range(40) for k, t in enumerate(_edited(i, 200, 4 if i < 20 else 5))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id for r in corpus_pipeline.keep_one_of_each_group(spark, docs, "").collect()}
    assert got == {i for i, _ in rows if i >= 40 or i % 2 == 0}


def _soft(spark, n=3000):
    """Documents of three domains that share most of their words."""
    rng = np.random.default_rng(4)
    kinds = {"en": "the and of house river", "fr": "le la des maison fleuve", "de": "der die und haus fluss"}
    shared = "taxi radio hotel piano opera".split() * 8
    rows = []
    for i in range(n):
        d = "en" if i % 10 < 7 else "fr" if i % 10 < 9 else "de"
        rows.append((i, " ".join(rng.choice(kinds[d].split() + shared, 12)), d))
    return spark.createDataFrame([*rows, (n, None, "en"), (n + 1, "", "de")], "doc_id long, text string, lang string").repartition(3)


def test_mixing_drops_no_document(spark, tmp_path):
    docs = _soft(spark)
    docs.select("doc_id").write.parquet(f"{tmp_path}/labels.parquet")
    out = corpus_pipeline.mix_domains(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    assert docs.join(out.select("doc_id").distinct(), "doc_id", "left_anti").count() == 0
    assert mixing.rates(docs, docs).where("rate < 1 or copies < 1").count() == 0


def test_default_mix_reaches_its_goals(spark):
    docs = _soft(spark)
    fitted, _ = mixing.fit(docs, docs)
    shares = [(x / sum(fitted.totals)) ** 0.7 for x in fitted.totals]
    assert np.allclose(np.array(fitted.reached) / sum(fitted.reached), np.array(shares) / sum(shares), atol=2e-3)
    assert all(g >= t for g, t in zip(fitted.targets, fitted.totals, strict=True))
