from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests import replay
from tidemark.functions import windows as W
from tidemark.functions.columns import from_epoch, to_epoch
from tidemark.plans.features import FeatureDefinition, FeatureSet


def assigned(spark, column, times):
    df = spark.createDataFrame([(float(t),) for t in times], "t double")
    rows = df.select("t", column(from_epoch(F.col("t"))).alias("w")).select(
        "t", to_epoch(F.col("w.start")).alias("s"), to_epoch(F.col("w.end")).alias("e")
    )
    return sorted((r.t, r.s, r.e) for r in rows.collect())


def test_tumbling(spark):
    got = assigned(spark, lambda ts: W.tumbling(ts, 60), [100, 61, 119, 59, 0, -1, -60])
    assert dict((t, (s, e)) for t, s, e in got) == {
        100: (60, 120), 61: (60, 120), 119: (60, 120), 59: (0, 60), 0: (0, 60), -1: (-60, 0), -60: (-60, 0),
    }
    assert assigned(spark, lambda ts: W.tumbling(ts, 60, 10), [5, 10]) == [(5, -50, 10), (10, 10, 70)]


def test_sliding(spark):
    assert assigned(spark, lambda ts: W.sliding(ts, 60, 30), [45]) == [(45, 0, 60), (45, 30, 90)]
    assert len(assigned(spark, lambda ts: W.sliding(ts, 60, 15), [50])) == 4
    # Size not a multiple of the slide: ends are multiples of the slide.
    got = assigned(spark, lambda ts: W.sliding(ts, 60, 25), [50, -10])
    assert got == [(-10, -60, 0), (-10, -35, 25), (-10, -10, 50), (50, 15, 75), (50, 40, 100)]
    with pytest.raises(ValueError):
        W.sliding(F.col("ts"), 30, 60)


def test_panes(spark):
    for size, slide in ((86400, 21600), (60, 25), (86400, 86399), (7, 3)):
        cut = -size % slide
        for t in (-100_001, -1, 0, 5, 59, 86_400, 123_456):
            base = t - t % slide
            want = base + (cut if t % slide >= cut else 0)
            got = spark.sql(f"select timestamp_seconds({t}) ts").select(F.unix_seconds(W.pane_start(F.col("ts"), size, slide))).first()[0]
            assert got == want
            # The pane is in the windows that the event is in: ends are multiples of the slide.
            ends = [e for e in range(base - size - slide, base + size + 2 * slide, slide) if e % slide == 0]
            assert [e for e in ends if e - size <= t < e] == [e for e in ends if e - size <= got < e]


def test_ready_and_late(spark):
    row = spark.range(1).select(
        W.is_ready(from_epoch(F.lit(120.0)), from_epoch(F.lit(120.0))).alias("a"),
        W.is_ready(from_epoch(F.lit(120.0)), from_epoch(F.lit(119.9))).alias("b"),
        W.is_late_but_allowed(from_epoch(F.lit(120.0)), from_epoch(F.lit(120.0)), 30).alias("c"),
        W.is_late_but_allowed(from_epoch(F.lit(120.0)), from_epoch(F.lit(150.0)), 30).alias("d"),
        W.is_expired(from_epoch(F.lit(120.0)), from_epoch(F.lit(120.0))).alias("e"),
    ).first()
    assert tuple(row) == (True, False, True, False, False)


def session_rows(make_events, events, row_limit=None, **rule):
    f = FeatureDefinition("n", "count", "session", session_gap_seconds=rule.pop("gap"), **rule)
    df = FeatureSet((f,)).compute(make_events([(i, u, t, ts, None) for i, u, t, ts in events]), row_limit=row_limit)
    rows = df.select("entity_id", to_epoch(F.col("window_start")).alias("s"), to_epoch(F.col("window_end")).alias("e"), "event_count")
    return sorted((r[0], r[1], r[2], r[3]) for r in rows.collect())


def test_session_literals(make_events):
    one = lambda *ts: session_rows(make_events, [(i, "u", "x", t) for i, t in enumerate(ts)], gap=30)
    assert one(100) == [("u", 100, 130, 1)]
    assert one(100, 120) == [("u", 100, 150, 2)]
    assert one(100, 200) == [("u", 100, 130, 1), ("u", 200, 230, 1)]
    assert one(100, 130) == [("u", 100, 160, 2)]
    assert one(100, 130.000001) == [("u", 100, 130, 1), ("u", 130.000001, 160.000001, 1)]


def test_double_gap_has_no_limit():
    with pytest.raises(ValueError, match="without a length limit"):
        W.SessionRule(30, 3600, "double_gap")


def test_double_gap_rule(make_events):
    ev = [(0, "u", "x", 100), (1, "u", "x", 159.999999), (2, "u", "x", 219.999999)]
    got = session_rows(make_events, ev, gap=30, max_session_seconds=None, session_rule="double_gap")
    assert got == [("u", 100, 189.999999, 2), ("u", 219.999999, 249.999999, 1)]


@pytest.mark.parametrize("row_limit", [None, 20])
def test_sessions_against_replay(make_events, row_limit):
    import random

    rng = random.Random(7)
    ev, t = [], -300.0
    for i in range(600):
        t += rng.choice([0, 1, 5, 20, 30, 31, 45, 90])
        # One user has most of the events.
        ev.append((i, rng.choice(["hot", "hot", "hot", "b", "c"]), "x", t))
    assert session_rows(make_events, ev, row_limit, gap=60, max_session_seconds=None) == replay.sessions(ev, 60)
    assert session_rows(make_events, ev, row_limit, gap=60, max_session_seconds=200) == replay.sessions(ev, 60, 200)
    assert session_rows(make_events, ev, row_limit, gap=60, max_session_seconds=40) == replay.sessions(ev, 60, 40)
