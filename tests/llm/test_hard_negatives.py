from __future__ import annotations

import math
import random

import numpy as np
import pytest

from tests.llm.conftest import run_sql
from tidemark.llm import hard_negatives as hn
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "key string, vec_id long, label int, embedding array<double>, q int, block string"


def brute(rows):
    sound = []
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) or abs(256 * x) >= 2.0**63 for x in v):
            continue
        row = (i, label, tuple(math.floor(256 * x) for x in v))
        if row not in sound:
            sound.append(row)
    out = []
    for a in sound:
        if a[0] % 100:
            continue
        score = lambda r: sum(x * y for x, y in zip(a[2], r[2]))  # noqa: B023, E731
        best = sorted(((-score(r), r[0]) for r in sound if r[0] != a[0] and r[1] == a[1]))[:5]
        for s, i in best:
            negatives = sorted((-score(r), r[0]) for r in sound if r[1] != a[1] and 30 * -s <= 100 * score(r) <= 90 * -s)[:10]
            out += [(a[0], i, k + 1, n, -s, -t) for k, (t, n) in enumerate(negatives)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame([("k", i, label, v, 0, "b") for i, label, v in rows], SCHEMA)
    return hn.hard_negatives(df, **options)


def result(df):
    return sorted(tuple(r) for r in df.collect())


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for planes, kind in ((2, np.int32), (9, np.int32), (40, np.int64)):
        half = 1 << planes - 1
        a, c = rng.integers(-100, 100, (70, 24)), rng.integers(-half, half, (2500, 24))
        got = hn.scores(hn.subset_sums(a, kind), hn.pack_planes(c, planes))
        assert (got == c @ a.T).all()


def test_random_with_ties(spark):
    rng = random.Random(2)
    rows = [(i, rng.randrange(4), [rng.randrange(-3, 4) / 4 for _ in range(11)]) for i in range(0, 3000, 5)]
    rows += [(i, 1, [0.5, 0.25, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.25]) for i in range(6001, 6400)]  # a hot label and vector
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    try:
        assert result(mined(spark, rows)) == brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_several_blocks_of_both(spark, monkeypatch):
    monkeypatch.setattr(hn, "ANCHOR_ROWS", 3)
    monkeypatch.setattr(hn, "CANDIDATE_ROWS", 40)
    rng = random.Random(3)
    rows = [(i, rng.randrange(3), [rng.random() - 0.4 for _ in range(9)]) for i in range(0, 2000, 10)]
    assert result(mined(spark, rows)) == brute(rows)


def test_odd_rows(spark):
    v = [0.5, -0.25, 1.0]
    rows = [(0, 1, v), (0, 1, v), (0, 1, [0.5, -0.25, 0.75]), (100, 1, [1.0]), (200, 2, []), (1, 1, v), (2, 1, v), (3, 2, v), (4, 2, [0.25, 0.0, 0.25])]
    rows += [(5, None, v), (None, 1, v), (6, 1, None), (7, 1, [None, 1.0]), (8, 2, [float("nan")]), (9, 2, [float("inf"), 0.0]), (10, 2, [1e300]), (11, 2, [-1e-9, 1e-9, 0.3])]
    rows += [(300, 5, v), (12, 2, [0.25, 0.25, 0.5, 9.0]), (13, 2, v), (13, 2, v)]
    assert result(mined(spark, rows)) == brute(rows) != []


def test_large_components(spark):
    rows = [(0, 1, [2.0**21, -3.0]), (1, 1, [2.0**21, 5.0]), (2, 2, [2.0**20, 1.0]), (3, 2, [-(2.0**21), 0.0]), (4, 2, [2.0**20 + 0.5, -7.25])]
    assert result(mined(spark, rows)) == brute(rows) != []


@pytest.mark.parametrize("rows", [[], [(1, 1, [1.0]), (2, 2, [0.5])], [(100, 1, [1.0]), (2, 2, [0.5])], [(100, 1, []), (2, 1, [])]])
def test_nothing_to_find(spark, rows):
    assert result(mined(spark, rows)) == []


def test_query(spark, duck):
    df = QUERIES["op12_hard_negatives"](spark, "/root/testdata/sf0.001")
    assert dict(df.dtypes) == {"anchor_id": "bigint", "positive_id": "bigint", "rank": "int", "negative_id": "bigint", "positive_score": "bigint", "negative_score": "bigint"}
    got = sorted((tuple(r) for r in df.collect()), key=str)
    assert got == run_sql(duck, ORACLES["op12_hard_negatives"], df.columns) != []
