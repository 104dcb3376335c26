from __future__ import annotations

import hashlib
import re

from tests.llm.conftest import run_sql
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "keep string, doc_id long, digest int, text string"


def brute(rows):
    norm = {}
    for i, t in rows:
        norm.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for t, ids in norm.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), keep is None or i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_cases(spark):
    rows = [(5, "a b"), (3, "a \t\n b"), (9, " a b"), (1, None), (2, ""), (None, "a b"), (None, "alone"), (7, "x" * 300_000), (8, "x" * 300_000), (3, "a  b"), (11, "a b")]
    df = spark.createDataFrame([("k", i, 0, t) for i, t in rows], SCHEMA)
    assert result(exact_dedup(df)) == brute(rows)


def test_hot_text_over_many_ranges(spark):
    rows = [(i, "same text" if i % 3 else f"text {i % 50}") for i in range(3000)]
    df = spark.createDataFrame([("k", i, 0, t) for i, t in rows], SCHEMA).repartition(7)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert result(exact_dedup(df)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_empty(spark):
    assert exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query(spark, duck):
    df = QUERIES["op9_exact_dedup"](spark, "/root/testdata/sf0.001")
    assert result(df) == run_sql(duck, ORACLES["op9_exact_dedup"], df.columns)
