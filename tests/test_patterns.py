from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests import replay
from tidemark.functions.columns import from_epoch, to_epoch
from tidemark.plans.patterns import PatternDefinition, PatternSet, alert_summary, detect


def found(alerts):
    rows = alerts.select(
        "entity_id", to_epoch(F.col("match_ts")).alias("t"), F.transform("matched_events", lambda e: e["event_id"].cast("int")).alias("ids")
    ).collect()
    return sorted((r.entity_id, r.t, tuple(r.ids)) for r in rows)


def simple(make_events, *rows):
    return make_events([(i, "u", kind, ts, props) for i, (kind, ts, props) in enumerate(rows)])


def test_sequence_literals(make_events):
    p = PatternDefinition("p", "sequence", ("product_click", "purchase"), 300)
    ev = simple(make_events, ("product_click", 1000, None), ("purchase", 1060, None))
    a = detect(ev, p).first()
    assert (a.event_count, a.time_span_seconds, a.severity, a.entity_id) == (2, 60.0, "LOW", "u")
    assert a.message == "Pattern 'p' detected for entity 'u': sequence"
    short = PatternDefinition("p", "sequence", ("product_click", "purchase"), 10)
    assert detect(simple(make_events, ("product_click", 1000, None), ("purchase", 1020, None)), short).count() == 0
    at_limit = simple(make_events, ("product_click", 1000, None), ("purchase", 1010, None))
    assert detect(at_limit, short).count() == 1


def test_sequence_that_never_matches(make_events):
    ev = simple(make_events, ("a", 1, None), ("b", 2, None), ("a", 3, None))
    assert detect(ev, PatternDefinition("p", "sequence", ("a",), 300)).count() == 0
    assert detect(ev, PatternDefinition("p", "sequence", ("a", "b", "a"), 300)).count() == 0


def test_threshold_literals(make_events):
    p = PatternDefinition("p", "threshold", ("purchase",), 300, threshold_field="amount", threshold_value=100)
    ev = simple(
        make_events, ("purchase", 1, {"amount": 50}), ("purchase", 2, {"amount": 150}), ("purchase", 3, {"amount": "100"}),
        ("purchase", 4, {"amount": "many"}), ("view", 5, {"amount": 500}), ("purchase", 6, {}),
    )
    assert [f[2] for f in found(detect(ev, p))] == [(1,), (2,)]
    assert {r.severity for r in detect(ev, p).collect()} == {"HIGH"}
    anything = PatternDefinition("p", "threshold", (), 300, threshold_field="amount", threshold_value=100)
    assert detect(ev, anything).count() == 3
    assert detect(ev, PatternDefinition("p", "threshold", (), 300)).count() == 0


def test_frequency_literals(make_events):
    p = PatternDefinition("p", "frequency", ("search",), 60, min_occurrences=3)
    ev = simple(make_events, *[("search", 1000 + i, None) for i in range(3)])
    a = detect(ev, p).collect()
    assert len(a) == 1 and a[0].metadata == {"count": "3"} and a[0].severity == "MEDIUM"
    # Matches do not overlap.
    assert detect(simple(make_events, *[("search", 1000 + i, None) for i in range(7)]), p).count() == 2
    assert detect(simple(make_events, *[("search", 1000 + 31 * i, None) for i in range(3)]), p).count() == 0


def test_absence_literals(make_events):
    p = PatternDefinition("p", "absence", ("add_to_cart", "purchase"), 10)
    cart = simple(make_events, ("add_to_cart", 1000, None))
    assert found(detect(cart, p, from_epoch(F.lit(1015.0)))) == [("u", 1010.0, (0,))]
    assert detect(cart, p, from_epoch(F.lit(1009.0))).count() == 0
    assert detect(cart, p, from_epoch(F.lit(1010.0))).count() == 1
    longer = PatternDefinition("p", "absence", ("add_to_cart", "purchase"), 60)
    done = simple(make_events, ("add_to_cart", 1000, None), ("purchase", 1030, None))
    assert detect(done, longer, from_epoch(F.lit(1120.0))).count() == 0
    at_limit = simple(make_events, ("add_to_cart", 1000, None), ("purchase", 1060, None))
    assert detect(at_limit, longer, from_epoch(F.lit(1120.0))).count() == 0
    assert detect(done, PatternDefinition("p", "absence", ("add_to_cart",), 60)).count() == 0
    a = detect(cart, p).first()
    assert a.metadata == {"absence_type": "purchase"} and a.time_span_seconds == 0.0


@pytest.mark.parametrize("row_limit", [None, 25])
def test_against_replay(make_events, row_limit):
    rng = random.Random(23)
    ev, t = [], 1000
    for i in range(500):
        t += rng.choice([0, 0, 1, 3, 10, 40])
        ev.append((i, rng.choice(["hot", "hot", "hot", "x", "y"]), rng.choice("abcd"), t))
    # Numbers of equal width, so that text order is arrival order.
    df = make_events([(f"{i:04d}", u, k, ts, None) for i, u, k, ts in ev])
    for types in (("a", "b"), ("a", "b", "c"), ("a", "b", "b", "d")):
        p = PatternDefinition("s", "sequence", types, 120)
        assert found(detect(df, p, row_limit=row_limit)) == replay.sequence(ev, types, 120)
    last = max(e[3] for e in ev)
    p = PatternDefinition("a", "absence", ("a", "z", "c"), 30)
    got = found(detect(df, p, from_epoch(F.lit(float(last))), row_limit))
    assert got == replay.absence(ev, "a", "c", 30, last)
    for n in (1, 2, 4):
        p = PatternDefinition("f", "frequency", ("a", "b"), 60, min_occurrences=n)
        assert found(detect(df, p, row_limit=row_limit)) == replay.frequency(ev, ("a", "b"), n, 60)


@pytest.mark.parametrize("row_limit", [None, 20])
def test_all_patterns_in_one_pass(make_events, row_limit):
    rng = random.Random(31)
    ev, t = [], 1000
    for i in range(400):
        t += rng.choice([0, 0, 1, 3, 10, 40])
        ev.append((i, rng.choice(["hot", "hot", "hot", "x", "y"]), rng.choice("abcde"), t))
    df = make_events([(f"{i:04d}", u, k, ts, {"v": i % 7, "group": f"{u}{i % 2}"}) for i, u, k, ts in ev])
    last = float(max(e[3] for e in ev))
    patterns = PatternSet((
        PatternDefinition("s2", "sequence", ("a", "b"), 120), PatternDefinition("s4", "sequence", ("a", "b", "b", "d"), 300),
        PatternDefinition("s3", "sequence", ("c", "a", "e"), 90), PatternDefinition("none", "sequence", ("a", "b", "a"), 90),
        PatternDefinition("gone", "absence", ("a", "c"), 30), PatternDefinition("gone2", "absence", ("b", "e"), 45),
        PatternDefinition("f1", "frequency", ("e",), 60), PatternDefinition("f2", "frequency", ("a", "b"), 60, min_occurrences=2),
        PatternDefinition("f3", "frequency", ("c", "b"), 90, min_occurrences=3), PatternDefinition("high", "threshold", ("a", "d"), 1, threshold_field="v", threshold_value=5),
        PatternDefinition("by_group", "frequency", ("a", "b", "c"), 100, key_field="group", min_occurrences=3),
    ))
    alerts = patterns.detect(df, from_epoch(F.lit(last)), row_limit).persist()
    got = {n: found(alerts.filter(F.col("pattern_name") == n)) for n in patterns}
    assert alerts.count() == sum(map(len, got.values()))
    for n in ("s2", "s3", "s4"):
        assert got[n] == replay.sequence(ev, patterns[n].event_types, patterns[n].time_window_seconds) != []
    assert got["none"] == []
    assert got["gone"] == replay.absence(ev, "a", "c", 30, last) != []
    assert got["gone2"] == replay.absence(ev, "b", "e", 45, last) != []
    for n in ("f1", "f2", "f3"):
        assert got[n] == replay.frequency(ev, patterns[n].event_types, patterns[n].min_occurrences, patterns[n].time_window_seconds) != []
    assert got["high"] == sorted((u, float(ts), (i,)) for i, u, k, ts in ev if k in "ad" and i % 7 >= 5)
    grouped = [(i, f"{u}{i % 2}", k, ts) for i, u, k, ts in ev]
    assert got["by_group"] == replay.frequency(grouped, ("a", "b", "c"), 3, 100) != []
    alerts.unpersist()


def test_numbers_without_a_small_common_multiple(make_events, monkeypatch):
    monkeypatch.setattr("tidemark.plans.patterns.COMMON_MULTIPLE", 12)
    ev = [(i, "u", "a", 1000 + 2 * i) for i in range(60)]
    df = make_events([(f"{i:04d}", u, k, ts, None) for i, u, k, ts in ev])
    patterns = PatternSet(tuple(PatternDefinition(f"f{n}", "frequency", ("a",), 60, min_occurrences=n) for n in (2, 3, 5, 6, 7)))
    alerts = patterns.detect(df).collect()
    for n in (2, 3, 5, 6, 7):
        mine = sorted((r.entity_id, r.match_ts.timestamp(), tuple(int(e.event_id) for e in r.matched_events)) for r in alerts if r.pattern_name == f"f{n}")
        assert mine == replay.frequency(ev, ("a",), n, 60)


def test_one_scan_for_all_patterns(spark, make_events):
    ev = simple(make_events, *[("abcd"[i % 4], 1000 + i, {"v": i}) for i in range(50)])
    patterns = PatternSet((
        PatternDefinition("s", "sequence", ("a", "b"), 120), PatternDefinition("s2", "sequence", ("b", "c", "d"), 120),
        PatternDefinition("g", "absence", ("a", "c"), 30), PatternDefinition("h", "threshold", (), 1, threshold_field="v", threshold_value=5),
    ))
    plan = patterns.detect(ev)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LogicalRDD") + plan.count("LocalRelation") == 1
    # Without a hot key the rows are moved once, whatever the number of patterns.
    assert patterns.detect(ev)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_set_and_summary(make_events):
    a = PatternDefinition("a", "threshold", (), 1, threshold_field="v", threshold_value=1)
    b = PatternDefinition("b", "frequency", ("k",), 60, key_field="v")
    s = PatternSet((a,)).having(b)
    assert list(s) == ["a", "b"] and list(s.without("a")) == ["b"] and s["b"] is b
    ev = simple(make_events, ("k", 1, {"v": 1}), ("k", 2, {"v": 2}), ("k", 3, {}))
    got = {(r.pattern_name, r.severity): r.alerts for r in alert_summary(s.detect(ev)).collect()}
    assert got == {("a", "HIGH"): 2, ("b", "MEDIUM"): 3}
    assert {r.entity_id for r in detect(ev, b).collect()} == {"1", "2", "u"}
    ids = [r.alert_id for r in s.detect(ev).collect()]
    assert len(set(ids)) == 5 and sorted(ids) == sorted(r.alert_id for r in s.detect(ev).collect())


def test_patterns_from_config():
    s = PatternSet.from_dict({"cep_patterns": [{"name": "x", "pattern_type": "frequency", "event_types": ["search"],
                                                "time_window_seconds": 60, "min_occurrences": 5, "description": "d"}]})
    assert s["x"].event_types == ("search",) and s["x"].min_occurrences == 5
    with pytest.raises(ValueError):
        PatternDefinition("x", "other")
