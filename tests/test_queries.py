"""Every registered query of the sky-frame operators against its SQL, at the smallest scale."""

from __future__ import annotations

import math
import os

import duckdb
import pytest

from skyloom import catalog

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


def _plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "~"
    return f"{v:.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in cols) for r in df.collect())
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == cols
    want = sorted(tuple(_plain(dict(zip(names, r, strict=True))[c]) for c in cols) for r in cursor.fetchall())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
