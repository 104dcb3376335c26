from __future__ import annotations

import random
import statistics

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import columns as C
from tidemark.functions.columns import from_epoch, to_epoch
from tidemark.plans.features import FeatureDefinition, FeatureSet, summarize
from tidemark.sources.events import parse_json_records, to_json_records

VALUES = {
    "count": ([1, 2, 3, 4, 5], 5), "sum": ([10, 20, 30], 60), "avg": ([10, 20, 30], 20), "min": ([5, 3, 8, 1, 9], 1),
    "max": ([5, 3, 8, 1, 9], 9), "percentile": (list(range(1, 101)), 50.5), "stddev": ([10, 10, 10], 0),
    "first_value": ([7, 8, 9], 7), "last_value": ([7, 8, 9], 9),
}


def computed(fs, df, **kw):
    out = fs.compute(df, **kw)
    return sorted(
        (r.feature_name, r.entity_id, r.s, r.e, r.feature_value, r.event_count)
        for r in out.select("*", to_epoch("window_start").alias("s"), to_epoch("window_end").alias("e")).collect()
    )


def test_aggregate_literals(make_events):
    rows = [(i, agg, agg, 70 + i * 0.01, {"v": v}) for agg, (vs, _) in VALUES.items() for i, v in enumerate(vs)]
    defs = tuple(
        FeatureDefinition(a, a, "tumbling", 60, "v", filter_event_type=a, percentile_value=50) for a in VALUES
    )
    got = {n: (s, e, v, c) for n, _, s, e, v, c in computed(FeatureSet(defs), make_events(rows))}
    assert got == {a: (60, 120, want, len(vs)) for a, (vs, want) in VALUES.items()}


def test_distinct_keys(make_events):
    ev = make_events([(i, "u", "x", 1 + i, {"product_id": p} if p else {}) for i, p in enumerate(["a", "b", "a", None, None])])
    f = FeatureDefinition("d", "distinct_count", "tumbling", 60, "_count")
    # Events without a product count by their id.
    assert [r[4] for r in computed(FeatureSet((f,)), ev)] == [4.0]
    named = FeatureDefinition("d", "distinct_count", "tumbling", 60, "category")
    cats = make_events([(i, "u", "x", 1, {"category": c}) for i, c in enumerate(["toys", "books", "toys"])])
    assert [r[4] for r in computed(FeatureSet((named,)), cats)] == [2.0]


def test_single_row_stddev_and_ties(make_events):
    ev = make_events([("a", "u", "x", 5, {"v": 1}), ("b", "u", "x", 5, {"v": 2})])
    defs = [FeatureDefinition(a, a, "tumbling", 60, "v") for a in ("first_value", "last_value")]
    assert [r[4] for r in computed(FeatureSet(tuple(defs)), ev)] == [1.0, 2.0]
    one = FeatureSet((FeatureDefinition("s", "stddev", "tumbling", 60, "v"),))
    assert [r[4] for r in computed(one, make_events([("a", "u", "x", 5, {"v": 3})]))] == [0.0]


def test_filter_trigger_and_routing(make_events):
    fs = FeatureSet((FeatureDefinition("spend", "sum", "tumbling", 60, "amount", filter_event_type="purchase"),))
    ev = make_events([(i, "u1", "purchase", 70 + i, {"amount": 10.0}) for i in range(5)] + [(9, "u1", "page_view", 75, {"amount": 99})])
    assert computed(fs, ev, watermark=from_epoch(F.lit(121.0))) == [("spend", "u1", 60, 120, 50.0, 5)]
    assert computed(fs, ev, watermark=from_epoch(F.lit(119.0))) == []
    assert fs.routed(ev).collect()[0].routed == 5


def test_value_extraction(make_events, spark):
    raws = ["12", " 2 ", "1e3", ".5", "1.5d", "1_000", "nan", "inf", "", "abc", None, 7, 2.5]
    ev = make_events([(i, "u", "x", i, {} if r is None else {"v": r}) for i, r in enumerate(raws)])
    got = [r.v for r in ev.select("ts", C.value(ev, "v", "sum").alias("v")).orderBy("ts").collect()]
    assert got == [12, 2, 1000, 0.5, None, None, None, None, None, None, None, 7, 2.5]
    # A missing field counts, an unusable one does not.
    count = [r.v for r in ev.select("ts", C.value(ev, "v", "count").alias("v")).orderBy("ts").collect()]
    assert count[10] == 1.0 and count[9] is None
    special = ev.select(
        C.value(ev, "_count", "sum").alias("a"), C.value(ev, "_timestamp", "max").alias("b"),
        C.value(ev, "timestamp", "max").alias("c"), C.value(ev, "event_id", "max").alias("d"),
    ).filter("b = 3").first()
    assert tuple(special) == (1.0, 3.0, 3.0, 3.0)


def test_property_containers(spark):
    base = spark.createDataFrame([("1", "u", "x")], "event_id string, user_id string, event_type string")
    js = base.withColumn("properties", F.lit('{"a": 5, "b.c": "t"}'))
    kinds = {
        "json": js,
        "variant": js.withColumn("properties", F.parse_json("properties")),
        "map": base.withColumn("properties", F.create_map(F.lit("a"), F.lit("5"), F.lit("b.c"), F.lit("t"))),
        "struct": base.withColumn("properties", F.struct(F.lit(5).alias("a"), F.lit("t").alias("b.c"))),
    }
    for df in kinds.values():
        row = df.select(
            C.number_prop(df, "a").alias("n"), C.prop_or(df, "a", "x").alias("s"), C.prop_or(df, "zz", "x").alias("d"),
            C.entity(df, "a").alias("e"), C.entity(df, "zz").alias("u"),
        ).first()
        assert tuple(row) == (5.0, "5", "x", "5", "u")


def test_no_user_is_one_key(make_events, spark):
    ev = make_events([(1, None, "x", 1, None), (2, None, "x", 2, None), (3, "u", "x", 2, None)])
    fs = FeatureSet((FeatureDefinition("n", "count", "tumbling", 60),))
    assert [(r[1], r[4]) for r in computed(fs, ev)] == [("", 2.0), ("u", 1.0)]


@pytest.mark.parametrize("row_limit", [None, 15])
def test_all_aggregates_all_windows(make_events, row_limit):
    """Every aggregate over every kind of window, with most events on one key."""
    rng = random.Random(1)
    rows = [(i, rng.choice(["h", "h", "h", "b"]), rng.choice("pq"), rng.randrange(0, 400), {"v": rng.randrange(0, 30), "product_id": rng.choice("xyz")}) for i in range(150)]
    df = make_events([(f"{i:03d}", u, t, ts, p) for i, u, t, ts, p in rows])
    aggs = list(VALUES) + ["distinct_count"]
    kinds = {"tumbling": {"window_size_seconds": 60}, "sliding": {"window_size_seconds": 60, "slide_seconds": 25}}
    fs = FeatureSet(tuple(
        FeatureDefinition(f"{a}/{k}", a, k, source_field="v", distinct_field="product_id", percentile_value=90, **kw) if a != "distinct_count"
        else FeatureDefinition(f"{a}/{k}", a, k, source_field="_count", **kw)
        for a in aggs for k, kw in kinds.items()
    ))
    want = {}
    for i, u, _, ts, p in rows:
        t0 = ts // 60 * 60
        first = ts // 25 * 25 - 60 + 25
        for k, starts in (("tumbling", [t0]), ("sliding", [s for s in range(first, ts + 1, 25) if s <= ts < s + 60])):
            for s in starts:
                want.setdefault((k, u, s), []).append((ts, i, p["v"], p["product_id"]))

    def pct(vs):
        vs = sorted(vs)
        at = 0.9 * (len(vs) - 1)
        lo = int(at)
        hi = min(lo + 1, len(vs) - 1)
        return vs[lo] * (1 - (at - lo)) + vs[hi] * (at - lo)

    fns = {
        "count": lambda r: len(r), "sum": lambda r: sum(x[2] for x in r), "avg": lambda r: sum(x[2] for x in r) / len(r),
        "min": lambda r: min(x[2] for x in r), "max": lambda r: max(x[2] for x in r), "percentile": lambda r: pct([x[2] for x in r]),
        "stddev": lambda r: statistics.stdev([x[2] for x in r]) if len(r) > 1 else 0.0,
        "first_value": lambda r: min(r)[2], "last_value": lambda r: max(r)[2], "distinct_count": lambda r: len({x[3] for x in r}),
    }
    got = computed(fs, df, row_limit=row_limit)
    assert len(got) == len(want) * len(aggs)
    for name, u, s, e, v, n in got:
        agg, k = name.split("/")
        r = want[(k, u, s)]
        assert e == s + 60 and n == len(r)
        assert v == pytest.approx(fns[agg](r)), (name, u, s)


def test_approximate_variants(make_events):
    ev = make_events([(i, "u", "x", i % 50, {"v": i}) for i in range(200)])
    fs = FeatureSet((
        FeatureDefinition("d", "distinct_count", "tumbling", 60, "v", approx=True),
        FeatureDefinition("p", "percentile", "tumbling", 60, "v", percentile_value=50, approx=True),
    ))
    got = {r[0]: r[4] for r in computed(fs, ev)}
    assert abs(got["d"] - 200) <= 20 and abs(got["p"] - 99.5) <= 3


def test_feature_set_api():
    a = FeatureDefinition("a", "count", "tumbling", 60)
    fs = FeatureSet((a, FeatureDefinition("b", "sum", "sliding", 60, "v")))
    assert fs["b"].slide == 15 and len(fs) == 2 and "a" in fs
    assert fs.get("zz") is None and list(fs.without("a")) == ["b"]
    newer = FeatureDefinition("a", "max", "tumbling", 60, "v")
    assert fs.having(newer)["a"] is newer and len(fs.having(newer)) == 2
    assert FeatureDefinition("s", "count", "session").session.gap_seconds == 300
    for bad in ({"aggregation": "median"}, {"window_type": "global"}, {"window_size_seconds": 0}, {"percentile_value": 101}):
        with pytest.raises(ValueError):
            FeatureDefinition(**{"name": "x", "aggregation": "count", "window_type": "tumbling", "window_size_seconds": 60, **bad})
    with pytest.raises(ValueError):
        FeatureDefinition("x", "count", "sliding", 30, slide_seconds=60)


def test_one_shuffle_per_window_specification(make_events):
    """Eight features over one window need one exchange."""
    ev = make_events([(1, "u", "x", 1, {"v": 1})])
    fs = FeatureSet(tuple(FeatureDefinition(f"f{i}", a, "tumbling", 60, "v", filter_event_type="x") for i, a in enumerate(["count", "sum", "avg", "min", "max", "stddev"])))
    plan = fs.compute(ev)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_yaml_and_wide(make_events, tmp_path):
    text = """
features:
  - {name: views, source_topic: t, key_field: user_id, value_field: _count, aggregation: count, window_type: tumbling, window_size_seconds: 60, filter_event_type: view, tags: [a]}
  - {name: carts, source_topic: t, key_field: user_id, value_field: _count, aggregation: count, window_type: sliding, window_size_seconds: 60, window_slide_seconds: 20}
  - {name: spend, source_topic: t, key_field: user_id, value_field: amount, aggregation: sum, window_type: tumbling, window_size_seconds: 60, filter_event_type: buy}
feature_groups: {main: [views, spend, unknown]}
quality: {max_null_ratio: 0.1}
"""
    path = tmp_path / "f.yaml"
    path.write_text(text)
    fs = FeatureSet.from_yaml(str(path))
    assert fs["carts"].slide_seconds == 20 and fs["views"].tags == ("a",) and fs.settings["quality"]["max_null_ratio"] == 0.1
    group = fs.group("main")
    assert list(group) == ["views", "spend"]
    ev = make_events([(1, "u", "view", 5, None), (2, "u", "buy", 6, {"amount": 4}), (3, "w", "view", 70, None)])
    wide = group.wide(group.compute(ev)).select("entity_id", "views", "spend").collect()
    assert sorted(map(tuple, wide)) == [("u", 1.0, 4.0), ("w", 1.0, 0.0)]
    latest = group.wide(group.compute(ev), per_window=False).collect()
    assert sorted(tuple(r) for r in latest) == [("u", 1.0, 4.0), ("w", 1.0, 0.0)]
    with pytest.raises(ValueError):
        FeatureDefinition.from_dict({"name": "x", "aggregation": "count", "window_type": "tumbling", "windowsize": 3})


def test_summary_and_records(make_events):
    ev = make_events([(i, u, "x", 10 * i, {"v": i}) for i, u in enumerate("uuv")])
    fs = FeatureSet((FeatureDefinition("s", "sum", "tumbling", 60, "v"),))
    r = summarize(fs.compute(ev)).first()
    assert (r.computations, r.entities, r.avg_value, r.max_value) == (2, 2, 1.5, 2.0)
    back = parse_json_records(to_json_records(ev))
    assert sorted(map(str, back.collect())) == sorted(map(str, ev.select(back.columns).collect())) or back.count() == 3
    assert isinstance(back.schema["ts"].dataType, T.TimestampType)
