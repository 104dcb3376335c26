from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import from_epoch
from tidemark.plans import monitor
from tidemark.plans.features import FeatureDefinition, FeatureSet


def samples(spark, values):
    df = spark.createDataFrame([(float(i), float(v)) for i, v in enumerate(values)], "t double, value double")
    return df.withColumn("ts", from_epoch(F.col("t")))


def test_latency(spark):
    r = monitor.latency_summary(samples(spark, [10, 20, 30])).first()
    assert (r["count"], r.mean_ms, r.median_ms, r.p95_ms, r.p99_ms, r.min_ms, r.max_ms) == (3, 20, 20, 30, 30, 10, 30)
    many = monitor.latency_summary(samples(spark, range(2000))).first()
    # Only the last 1000 values: 1000 .. 1999.
    assert (many["count"], many.p95_ms, many.p99_ms, many.min_ms) == (1000, 1950, 1990, 1000)
    twenty = monitor.latency_summary(samples(spark, range(20))).first()
    assert twenty.p95_ms == 19
    empty = monitor.latency_summary(samples(spark, [1]).filter("false")).first()
    assert (empty["count"], empty.mean_ms, empty.p99_ms) == (0, 0.0, 0.0)


def test_throughput(spark):
    s = samples(spark, range(100))
    assert tuple(monitor.throughput(s, from_epoch(F.lit(99.0)), 60).first()) == (61, 61 / 60)
    assert tuple(monitor.throughput(s.filter("false"), from_epoch(F.lit(99.0))).first()) == (0, 0.0)
    assert tuple(monitor.throughput(s.filter("t = 99"), from_epoch(F.lit(99.0))).first()) == (1, 1.0)
    assert [r.events for r in monitor.throughput_by_interval(s, 60).orderBy("interval_start").collect()] == [60, 40]


@pytest.mark.parametrize(("values", "level"), [([0.3, 0.5], "none"), ([0.6], "moderate"), ([0.8], "high"), ([0.95], "critical"), ([0.9], "high")])
def test_backpressure(spark, values, level):
    assert monitor.backpressure(samples(spark, values)).first().level == level


def test_errors(spark):
    df = spark.createDataFrame([("parse_error",), ("parse_error",), ("timeout",), (None,)], "kind string")
    got = {r.error_type: r.errors for r in monitor.errors(df, F.col("kind").isNotNull(), F.col("kind")).collect()}
    assert got == {"parse_error": 2, "timeout": 1}
    rate = monitor.error_rate(df, F.col("kind").isNotNull(), F.col("kind").isNull()).first()
    assert tuple(rate) == (3, 1, 3.0)
    limits = monitor.alert_limits(spark.createDataFrame([(0.02, 99.0)], "error_rate double, p99_ms double")).first()
    assert (limits.error_rate_exceeded, limits.p99_exceeded) == (True, False)


def test_freshness_and_quality(spark):
    df = spark.createDataFrame([("a", "f", 1.0, 100.0), ("b", "f", None, 250.0), ("a", "g", 1.0, 10.0)], "entity_id string, feature_name string, feature_value double, t double")
    df = df.withColumn("computed_at", from_epoch(F.col("t")))
    now = from_epoch(F.lit(320.5))
    assert {r.feature_name: (r.freshness_s, r.stale) for r in monitor.staleness(df, now).collect()} == {"f": (70.5, False), "g": (310.5, True)}
    ask = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    got = {r.feature_name: (r.null_ratio, r.exceeded) for r in monitor.null_ratio(df, ask, ["f", "g", "h"]).collect()}
    assert got == {"f": (0.5, True), "g": (0.5, True), "h": (1.0, True)}


def test_drift(spark):
    base = spark.range(4000).select(
        F.lit("f").alias("feature_name"), F.col("id").cast("string").alias("entity_id"), F.timestamp_seconds("id").alias("window_end"),
        (F.col("id") % 100).cast("double").alias("feature_value"),
    )
    same = monitor.drift(base, ["f"]).first()
    assert (same.current, same.baseline, same.drifted) == (1000, 1000, False) and same.psi < 0.01
    moved = base.withColumn("feature_value", F.col("feature_value") + F.when(F.unix_seconds("window_end") >= 3000, 40).otherwise(0))
    assert monitor.drift(moved, ["f"]).first().drifted


def test_backfill_and_reconcile(make_events, spark):
    day = 86400
    ev = make_events([(i, f"u{i % 3}", "x", i * day / 2, {"v": 1}) for i in range(20)])
    fs = FeatureSet((FeatureDefinition("s", "sum", "tumbling", day, "v"),))
    until = F.timestamp_seconds(F.lit(8 * day))
    part = monitor.backfill(fs, ev, until, 3)
    assert part.agg(F.sum("event_count")).first()[0] == 6
    assert monitor.backfill(fs, ev, datetime(1970, 1, 9), 3).count() == part.count()
    with pytest.raises(ValueError):
        monitor.backfill(fs, ev, until, 400)
    all_rows = fs.compute(ev)
    same = monitor.reconcile(all_rows, all_rows, sample_rate=1.0)
    assert {r.status for r in same.collect()} == {"match"} and same.count() == all_rows.count()
    less = all_rows.filter("entity_id <> 'u1'").withColumn("feature_value", F.col("feature_value") + F.when(F.col("entity_id") == "u2", 1).otherwise(0))
    assert {(r.entity_id, r.status) for r in monitor.reconcile(all_rows, less, sample_rate=1.0).collect()} == {("u0", "match"), ("u1", "missing_stored"), ("u2", "mismatch")}
    assert monitor.reconcile(all_rows, all_rows, sample_rate=0.0).count() == 0


def test_report(make_events):
    from tidemark.operators.lateness import tag_lateness

    ev = make_events([(i, "u", "x", 100 + i, {"v": i}) for i in range(5)])
    tagged = tag_lateness(ev.withColumn("seq", F.col("event_id").cast("long"))).withColumn("value", F.get_json_object("properties", "$.v").cast("double"))
    fs = FeatureSet((FeatureDefinition("s", "sum", "tumbling", 60, "v"),))
    r = monitor.report(tagged, fs.compute(ev), from_epoch(F.lit(130.0))).first()
    assert (r.processed, r.late, r.features_computed, r.windows_triggered, r.latency_samples, r.mean_ms) == (5, 0, 1, 1, 5, 2.0)
    assert [(x.event_type, x.events) for x in monitor.event_types(ev).collect()] == [("x", 5)]
