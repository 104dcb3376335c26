"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import math
import os

import pytest

import __spark_entry__ as entry
from tidemark import catalog

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-9, abs_tol=2e-6)
    return a == b


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted(([r[c] for c in cols] for r in df.collect()), key=str)
    sql = entry.oracle_sql()[name]
    res = duck.execute(sql)
    names = [c[0] for c in res.description]
    assert sorted(names) == cols
    at = [names.index(c) for c in cols]
    want = sorted(([r[i] for i in at] for r in res.fetchall()), key=str)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(same(x, y) for x, y in zip(g, w)), (g, w)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["entity_id", "feature_name", "window_start_us", "window_end_us", "feature_value", "event_count"]
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
