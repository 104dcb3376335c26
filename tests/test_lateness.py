from __future__ import annotations

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tests import replay
from tidemark.functions.columns import from_epoch
from tidemark.operators import rows
from tidemark.operators.lateness import late_output, lateness_counts, on_time, tag_lateness, watermark_lag


def arrived(make_events, arrivals):
    ev = make_events([(f"{i:04d}", "u", "x", ts, {"n": i}) for i, ts in arrivals])
    order = {f"{i:04d}": n for n, (i, _) in enumerate(arrivals)}
    pairs = F.create_map(*[x for k, v in order.items() for x in (F.lit(k), F.lit(v))])
    return ev.withColumn("seq", pairs[F.col("event_id")])


def test_watermark_does_not_regress(make_events):
    got = tag_lateness(arrived(make_events, [(0, 100), (1, 90), (2, 101)]), 5, 30).orderBy("seq").collect()
    assert [r.watermark for r in got] == [95.0, 95.0, 96.0]
    assert [r.is_late for r in got] == [False, True, False]
    assert [r.lateness_s for r in got] == [0.0, 5.0, 0.0]


def test_far_too_late(make_events):
    b = 10_000
    seq = [(i, b + 10 * i) for i in range(10)] + [(10, b - 100)]
    t = tag_lateness(arrived(make_events, seq), 5, 30)
    assert [(r.event_id, r.lateness_s) for r in late_output(t).collect()] == [("0010", 185.0)]
    assert on_time(t).count() == 10
    assert tuple(lateness_counts(t, F.col("event_id") != "0003").first()) == (1, 9, 1, 1)


@pytest.mark.parametrize("limit", [None, 40])
def test_against_replay(make_events, limit):
    rng = random.Random(2)
    arrivals = [(i, max(0, 3 * i + rng.choice([0, 0, 0, -10, -40, -80]))) for i in range(300)]
    got = {int(r.event_id): (r.is_late, r.is_dropped) for r in tag_lateness(arrived(make_events, arrivals), 5, 30, row_limit=limit).collect()}
    assert got == replay.lateness(arrivals, 5, 30)


def test_processing_time_and_lag(make_events):
    ev = arrived(make_events, [(0, 100), (1, 1)])
    assert [r.is_late for r in tag_lateness(ev, event_time=False).collect()] == [False, False]
    assert tuple(watermark_lag(ev, from_epoch(F.lit(200.0))).first()) == (95.0, 105.0)


def test_row_operators(make_events):
    ev = make_events([(i, "u", "x", i, {"n": i}) for i in range(6)])
    seen = Observation()
    kept = rows.keep(ev, F.col("event_id").cast("int") >= 2, seen)
    doubled = rows.transform(kept, {"event_type": F.upper("event_type")})
    many = rows.expand(doubled, F.when(F.col("event_id") != "3", F.array(F.lit(1), F.lit(2))))
    assert rows.key_by(many, F.col("event_type")).groupBy("entity_id").count().collect()[0]["count"] == 6
    assert seen.get == {"processed": 4, "filtered": 2}
    out = rows.transform_batches(ev.select("event_id"), lambda b: b[b["event_id"] > "3"])
    assert sorted(r.event_id for r in out.collect()) == ["4", "5"]
