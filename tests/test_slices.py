"""Ordered operators on a key that holds most of the rows: results do not depend on slicing."""

from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests import replay
from tidemark.operators.asof import as_of
from tidemark.operators.chain import greedy_chain
from tidemark.operators.percentiles import ranked_percentile
from tidemark.operators.slices import Running, lag_rows, running, with_slices


def skewed(n=800, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rng.random() < 0.6 else rng.choice("abc")
        # A burst: half of the hot rows lie within a short time.
        t = rng.randrange(1000, 1010) if rng.random() < 0.3 else rng.randrange(0, 100_000)
        rows.append((k, t, i, rng.randrange(-50, 50)))
    return rows


def test_slices_are_bounded_and_ordered(spark):
    df = spark.createDataFrame(skewed(), "k string, t long, i long, v long")
    cut, name = with_slices(df, ["k"], "t", 50)
    assert name is not None
    rows = cut.collect()
    assert len(rows) == 800
    per = {}
    for r in rows:
        per.setdefault((r.k, r[name]), []).append(r.t)
    hot = {s: ts for (k, s), ts in per.items() if k == "hot"}
    order = sorted(hot)
    assert len(order) > 5
    for a, b in zip(order, order[1:]):
        assert max(hot[a]) < min(hot[b])
    # Only rows with one and the same time cannot be separated.
    assert all(len(ts) <= 50 or len(set(ts)) <= 2 for ts in hot.values())
    assert with_slices(df, ["k"], "t", 5000)[1] is None


@pytest.mark.parametrize("reverse", [False, True])
def test_running_values(spark, reverse):
    df = spark.createDataFrame(skewed(), "k string, t long, i long, v long")
    v = F.when(F.col("v") % 3 == 0, F.col("v"))
    values = {
        "s": Running("sum", F.col("v")), "mn": Running("min", v), "mx": Running("max", v, inclusive=False),
        "la": Running("last", v, inclusive=False), "sx": Running("sum", F.lit(1), inclusive=False),
    }
    plain = running(df, ["k"], ["t", "i"], None, values, reverse)
    cut, name = with_slices(df, ["k"], "t", 40)
    sliced = running(cut, ["k"], ["t", "i"], name, values, reverse).drop(name)
    key = lambda rows: sorted(map(tuple, rows))
    cols = ["i", *values]
    assert [r for r in sorted(plain.select(cols).collect())] == [r for r in sorted(sliced.select(cols).collect())]
    assert key(plain.select("i").collect()) == key(df.select("i").collect())


def test_running_without_key(spark):
    df = spark.createDataFrame(skewed(), "k string, t long, i long, v long")
    cut, name = with_slices(df, [], "i", 60)
    out = running(cut, [], ["i"], name, {"m": Running("max", F.col("t"))}).select("i", "t", "m").collect()
    best = -1
    for r in sorted(out, key=lambda r: r.i):
        best = max(best, r.t)
        assert r.m == best


def test_lag_rows(spark):
    df = spark.createDataFrame(skewed(), "k string, t long, i long, v long")
    cut, name = with_slices(df, ["k"], "t", 40)
    numbered = running(cut, ["k"], ["t", "i"], name, {"n": Running("sum", F.lit(1).cast("long"))}).drop(name)
    a = lag_rows(numbered, ["k"], ["t", "i"], "n", "t", 4, "back", False).select("i", "back")
    b = lag_rows(numbered, ["k"], ["t", "i"], "n", "t", 4, "back", True, 10).select("i", "back")
    assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert b.count() == 800


@pytest.mark.parametrize(("limit", "fold"), [(None, None), (None, 5), (100, 5)])
def test_greedy_chain(spark, limit, fold):
    rng = random.Random(11)
    pts = {("hot", x) for x in rng.sample(range(3000), 700)} | {("a", x) for x in range(0, 500, 7)} | {("b", 5)}
    df = spark.createDataFrame(sorted(pts), "k string, x long")
    for distance in (150,) if limit else (9,):
        got = sorted(map(tuple, greedy_chain(df, ["k"], "x", distance, limit, fold).collect()))
        want = sorted((k, x) for k in ("hot", "a", "b") for x in replay.chain([x for kk, x in pts if kk == k], distance))
        assert got == want


def test_ranked_percentile(spark):
    df = spark.createDataFrame([(k, float(v)) for k, _, _, v in skewed()], "k string, v double")
    for p in (0, 33.3, 50, 95, 100):
        want = {r.k: r.p for r in df.groupBy("k").agg(F.percentile("v", p / 100).alias("p")).collect()}
        got = {r.k: r.value for r in ranked_percentile(df, ["k"], "v", p, 60).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want)


@pytest.mark.parametrize("limit", [None, 30])
@pytest.mark.parametrize("forward", [False, True])
def test_as_of(spark, limit, forward):
    rng = random.Random(5)
    records = [("hot" if rng.random() < 0.7 else rng.choice("ab"), rng.randrange(0, 400), i) for i in range(300)]
    asks = [(rng.choice(["hot", "a", "zz"]), rng.randrange(-10, 420), i) for i in range(200)]
    r = spark.createDataFrame(records, "k string, t long, i long").withColumn("rt", F.timestamp_seconds("t"))
    a = spark.createDataFrame(asks, "k string, t long, j long").withColumn("at", F.timestamp_seconds("t"))
    got = {x.j: (x.record.i if x.record else None) for x in as_of(a, r, ["k"], "at", "rt", ["i"], forward, limit).collect()}
    for k, t, j in asks:
        if forward:
            c = [(rt, i) for rk, rt, i in records if rk == k and rt >= t]
            want = min(c)[1] if c else None
        else:
            c = [(rt, i) for rk, rt, i in records if rk == k and rt <= t]
            want = max(c)[1] if c else None
        assert got[j] == want, (k, t, j)
    assert len(got) == 200


@settings(max_examples=4, deadline=None)
@given(st.lists(st.integers(0, 60), min_size=1, max_size=40, unique=True), st.integers(2, 9))
def test_greedy_chain_property(spark, xs, distance):
    df = spark.createDataFrame([("k", x) for x in xs], "k string, x long")
    got = sorted(r.x for r in greedy_chain(df, ["k"], "x", distance, limit=8, fold=2).collect())
    assert got == replay.chain(xs, distance)
