"""Mixing against plain Python: the word table, posteriors, rates and copies; and its bounds."""

from __future__ import annotations

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyloom.llm import mixing

P = mixing.Mixing(buckets=64, rounds=25, replayed=4)
KINDS = {"de": "der die und haus fluss", "en": "the and of house river", "fr": "le la des maison fleuve"}


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(8)
    shared = "taxi radio hotel piano opera".split() * 4
    out = [(i, " ".join(rng.choice(KINDS[d].split() + shared, 15)), d) for i in range(150) for d in [["en", "en", "en", "fr", "de"][i % 5]]]
    return [*out, (150, None, "en"), (151, "", "fr"), (152, "  ", None), (152, "The the", "de"), (153, "house " * 400_000, "en"), (154, "river\nhouse\tand \r\n of\u00a0the\n", "en")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


def _plainly(spark, rows, targets):
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").lower()) if w]
    known = sorted({w for _, t, _ in rows for w in words(t)})
    hashed = spark.createDataFrame([(w,) for w in known], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(P.buckets)).cast("int").alias("b"))
    bucket = {r.w: r.b for r in hashed.collect()}
    counts = {d: np.full(P.buckets, P.smoothing) for d in KINDS}
    for _, t, d in rows:
        for w in words(t) if d else []:
            counts[d][bucket[w]] += 1
    whole = sum(c.sum() for c in counts.values())
    logs = [np.log(counts[d] / counts[d].sum()) for d in KINDS]
    prior = [math.log(counts[d].sum() / whole) for d in KINDS]
    tokens, post = [], []
    for _, t, _ in rows:
        w = words(t)
        z = np.array([sum(lg[bucket[x]] for x in w) / max(1.0, len(w) / P.evidence) + pr for lg, pr in zip(logs, prior, strict=True)])
        e = np.exp(z - z.max())
        tokens.append(len(w))
        post.append(e / e.sum())
    tokens, post = np.array(tokens, float), np.array(post)
    n = tokens @ post
    goal = np.array([targets[d] for d in KINDS])
    goal = goal / goal.sum() * n.sum()
    r = np.ones(len(rows))
    for _ in range(P.rounds):
        e = ((tokens * r) @ post - goal) / n
        if np.abs(e).max() < P.tolerance:
            break
        r = np.maximum(0, r - post @ e)
    return tokens, post, r


def test_rates_are_those_of_plain_descent(spark, docs, rows):
    targets = {"de": 6.0, "en": 1.0, "fr": 1.0}
    tokens, post, r = _plainly(spark, rows, targets)
    got = sorted((repr(x.doc_id), x.tokens, round(x.membership, 4), round(x.rate, 3)) for x in mixing.rates(docs, docs, P, targets).collect())
    want = sorted((repr(i), int(t), round(float(q.max()), 4), round(float(v), 3)) for (i, _, _), t, q, v in zip(rows, tokens, post, r, strict=True))
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-3) and a[3] == pytest.approx(b[3], abs=5e-3)


def test_copies_hold_the_rate_on_average(spark):
    got = spark.range(20000).select(mixing.copies(F.col("id").cast("string"), F.lit(1.3)).alias("c")).agg(F.avg("c"), F.min("c"), F.max("c")).first()
    assert got[0] == pytest.approx(1.3, abs=0.02) and got[1:] == (1, 2)


def test_too_many_domains_are_refused_before_they_are_gathered(docs):
    with pytest.raises(ValueError, match="more than 2 domains"):
        mixing.rates(docs, docs, mixing.Mixing(max_domains=2))
