from __future__ import annotations

import duckdb
import pytest

TABLES = ("documents", "pages", "benchmark", "labels", "embeddings")


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    return con


def run_sql(con, sql, columns):
    res = con.execute(sql)
    names = [c[0] for c in res.description]
    assert sorted(names) == sorted(columns)
    return sorted((tuple(r[names.index(c)] for c in columns) for r in res.fetchall()), key=str)
