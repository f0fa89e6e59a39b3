"""Settling of sorted (rank, context) pairs against plain counts, however they are dealt over tasks."""

from __future__ import annotations

import collections

import numpy as np
import pytest

from skyloom.llm import suffixdup
from skyloom.llm.common import scratch


@pytest.mark.parametrize(("ranks", "contexts", "n"), [(1, 1, 50), (1, 3, 60), (2, 1, 40), (5, 2, 100), (1000, 1, 300), (30, 5, 400), (1, 1, 1), (1, 1, 0), (1, 200, 300)])
def test_settling(spark, ranks, contexts, n):
    rng = np.random.default_rng(ranks * 7 + contexts)
    rows = [(int(rng.integers(ranks)), int(rng.integers(contexts)), bytes([k % 7]), k, 0, 1) for k in range(n)]
    df = spark.createDataFrame(rows, suffixdup.ITEM).repartition(3)
    with scratch(spark):
        found, apart = (x.collect() for x in suffixdup._settle(df, "test"))
    pairs = collections.Counter(r[:2] for r in rows)
    of = collections.Counter(g for g, _ in pairs)
    assert sorted(r.at for r in found) == sorted(k for g, u, _, k, _, _ in rows if pairs[g, u] > 1)
    assert sorted((r.g, r.u) for r in apart) == sorted(x for x in pairs if of[x[0]] > 1)
