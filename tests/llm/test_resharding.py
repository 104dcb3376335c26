from __future__ import annotations

import itertools
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.llm.queries import QUERIES
from tidemark.llm.resharding import equal_capacities, least_cost_flow, moving_costs, reshard, write_layout

SCHEMA = "shard int, doc_id long, size string, text string, slot long"


def cheapest(supply, capacity, cost):
    """The least cost by trying every way to give units one after the other."""
    units = [o for o, n in enumerate(supply) for _ in range(n)]
    best = None
    for places in itertools.product(range(len(capacity)), repeat=len(units)):
        if all(places.count(n) <= c for n, c in enumerate(capacity)):
            total = sum(cost[o][n] for o, n in zip(units, places))
            best = total if best is None else min(best, total)
    return best


def test_flow_is_cheapest():
    rng = random.Random(3)
    for _ in range(60):
        supply = [rng.randrange(3) for _ in range(3)]
        capacity = [rng.randrange(4) for _ in range(3)]
        if sum(capacity) < sum(supply):
            with pytest.raises(ValueError, match="capacities"):
                least_cost_flow(supply, capacity, moving_costs(3, 3))
            continue
        cost = [[rng.randrange(5) for _ in range(3)] for _ in range(3)]
        sent = least_cost_flow(supply, capacity, cost)
        assert [sum(r) for r in sent] == supply
        assert all(sum(c) <= n for c, n in zip(zip(*sent), capacity))
        assert sum(cost[o][n] * sent[o][n] for o in range(3) for n in range(3)) == cheapest(supply, capacity, cost)


def test_flow_moves_only_what_is_over():
    rng = random.Random(4)
    for old, new in ((12, 16), (16, 12), (5, 5), (1, 7), (7, 1)):
        supply = [rng.randrange(10**12) for _ in range(old)]
        capacity = equal_capacities(sum(supply), new)
        sent = least_cost_flow(supply, capacity, moving_costs(old, new))
        moved = sum(sent[o][n] for o in range(old) for n in range(new) if o != n)
        assert moved == sum(max(0, s - (capacity[o] if o < new else 0)) for o, s in enumerate(supply))


def resharded(spark, rows, old, new, **options):
    df = spark.createDataFrame([(None, i, "s", t, None) for i, t in rows], SCHEMA)
    layout = write_layout(df, runtime.scratch_path(spark, "t"), old)
    return layout, reshard(layout, runtime.scratch_path(spark, "t"), new, **options)


def check(rows, got, new):
    """Every row once, its size, and a gapless number in its shard; bytes by shard."""
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    assert all(r["__size"] == len((r.text or "").encode()) + 1 and 0 <= r["__shard"] < new for r in got)
    slots, sizes = defaultdict(list), dict.fromkeys(range(new), 0)
    for r in got:
        slots[r["__shard"]].append(r["__slot"])
        sizes[r["__shard"]] += r["__size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes


def test_grow_and_shrink(spark):
    rng = random.Random(5)
    rows = [(i, "é" * rng.randrange(1, 40)) for i in range(4000)]
    by = F.pmod(F.xxhash64("doc_id"), F.lit(6))
    for new in (9, 4):
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "8k")
        try:
            layout, done = resharded(spark, rows, by, new)
        finally:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        old = Counter()
        for r in layout.read().collect():
            old[r["__shard"]] += r["__size"]
        got = done.read().collect()
        sizes = check(rows, got, new)
        largest = max(r["__size"] for r in got)
        assert max(sizes.values()) - min(sizes.values()) <= 2 * largest
        moved = sum(r["__size"] for r in got if r["__from"] != r["__shard"])
        least = sum(max(0, b - (done.capacities[o] if o < new else 0)) for o, b in old.items())
        assert abs(moved - least) <= 2 * largest * new
        # Files without a moved row stay: what is written anew is the moved rows and the rest of the few cut files.
        assert done.anew.read().filter(F.col("__from") == F.col("__shard")).count() < 0.3 * len(rows)


def test_large_rows_nulls_and_repeats(spark):
    rows = [(1, "x" * 50_000), (2, "y" * 30_000), (2, "y" * 30_000), (None, None), (None, None), (3, ""), (None, "own")]
    rows += [(i, "w" * 20) for i in range(4, 3000)]
    _, done = resharded(spark, rows, F.lit(1), 4)
    sizes = check(rows, done.read().collect(), 4)
    # The largest row fills a shard by itself, the others share the rest.
    assert max(sizes.values()) == 50_001 and max(s for s in sizes.values() if s != 50_001) - min(sizes.values()) <= 64


def test_own_capacities_and_costs(spark):
    rows = [(i, "abcdefghi") for i in range(1000)]
    by = (F.col("doc_id") % 2).cast("int")
    _, done = resharded(spark, rows, by, 3, capacities=[2000, 5000, 4000], costs=[[0, 1, 9], [1, 0, 2]])
    sizes = check(rows, done.read().collect(), 3)
    assert [round(sizes[n], -2) for n in range(3)] == [2000, 5000, 3000]
    # Sending on from 0 through 1 costs 3 a byte, straight to 2 costs 9.
    assert done.flow[0][2] == 0
    with pytest.raises(ValueError, match="capacity"):
        resharded(spark, rows, by, 2, capacities=[10, 10])


def test_empty_and_reserved(spark):
    _, done = resharded(spark, [], F.lit(0), 4)
    assert done.read().collect() == []
    with pytest.raises(ValueError, match="reserved"):
        write_layout(spark.createDataFrame([(1, "x")], "__size int, text string"), runtime.scratch_path(spark, "t"), F.lit(0))


def test_query(spark):
    got = QUERIES["op11_resharding"](spark, "/root/testdata/sf0.01").collect()
    texts = dict(duckdb.sql("SELECT doc_id, coalesce(text, '') FROM '/root/testdata/sf0.01/documents.parquet'").fetchall())
    assert sorted(r.doc_id for r in got) == sorted(texts)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        data = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(16)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) < 1.03 * min(sizes.values())
