"""Streams agree with batch, over several micro-batches and after a repeated batch."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests import replay
from tidemark.functions.columns import from_epoch, to_epoch
from tidemark.plans.features import FeatureDefinition, FeatureSet
from tidemark.plans.patterns import PatternDefinition, PatternSet
from tidemark.streaming.features import stream_all, stream_features
from tidemark.streaming.patterns import stream_pattern, stream_patterns
from tidemark.streaming.run import drain, state_settings
from tidemark.streaming.sinks import FeatureStore, StoreSink, dedup_stream, start


def some_events(n=240, seed=9):
    rng = random.Random(seed)
    out, t = [], 1000
    for i in range(n):
        t += rng.choice([0, 1, 2, 9, 31])
        out.append((i, rng.choice(["h", "h", "a"]), rng.choice("abc"), t))
    return out


@pytest.fixture(scope="module")
def source(spark, make_events, tmp_path_factory):
    """Events in four files, read one file per micro-batch."""
    ev = some_events()
    folder = str(tmp_path_factory.mktemp("events"))
    for k in range(4):
        part = make_events([(f"{i:04d}", u, t, ts, {"v": i % 7, "product_id": i % 5}) for i, u, t, ts in ev[60 * k: 60 * (k + 1)]])
        part.coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema

    def read():
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return ev, read, spark.read.parquet(folder)


def tidy(df):
    rows = df.select("feature_name", "entity_id", to_epoch(F.col("window_start")).alias("s"), to_epoch(F.col("window_end")).alias("e"), F.round("feature_value", 6), "event_count")
    return sorted(map(tuple, rows.collect()))


WINDOWS = FeatureSet((
    *[FeatureDefinition(f"{a}_t", a, "tumbling", 60, "_count" if a == "distinct_count" else "v", allowed_lateness_seconds=0)
      for a in ("count", "sum", "avg", "min", "max", "stddev", "percentile", "distinct_count", "first_value", "last_value")],
    FeatureDefinition("sum_s", "sum", "sliding", 60, "v", slide_seconds=25, allowed_lateness_seconds=0),
    FeatureDefinition("n_g", "count", "session", session_gap_seconds=20, max_session_seconds=None, allowed_lateness_seconds=0),
))


def test_windows_equal_batch(source):
    ev, read, batch = source
    wm = max(e[3] for e in ev) - 5
    # Windows are closed by the watermark; a session also has to be out of reach of its gap.
    want = [r for r in tidy(WINDOWS.compute(batch)) if r[3] <= wm]
    got = tidy(drain(stream_all(WINDOWS, read(), 5)))
    assert [r for r in got if r[3] <= wm] == want and got == want
    assert len(stream_features(WINDOWS, read())) == 3


def test_capped_sessions_equal_batch(source):
    ev, read, batch = source
    fs = FeatureSet(tuple(FeatureDefinition(f"{a}_c", a, "session", 0, "v", session_gap_seconds=20, max_session_seconds=50, allowed_lateness_seconds=0) for a in ("count", "sum", "min", "max", "avg", "stddev", "first_value", "last_value", "distinct_count", "percentile")))
    want, got = tidy(fs.compute(batch)), tidy(drain(stream_all(fs, read(), 0)))
    # Only sessions still open at the end are missing.
    assert set(got) <= set(want)
    open_ones = {r[1] for r in want if r not in got}
    last = max(e[3] for e in ev)
    assert all(r[3] + 1e-6 > last for r in want if r not in got) and len(open_ones) <= 2


def test_percentile_of_counted_values():
    import numpy as np

    from tidemark.streaming.sessions import percentile

    rng = np.random.default_rng(2)
    for _ in range(200):
        values = rng.integers(0, 9, rng.integers(1, 12)) / 2
        counted = [(float(v), int((values == v).sum())) for v in set(values.tolist())]
        for p in (0, 12.5, 50, 95, 100):
            assert percentile(counted, p) == pytest.approx(np.percentile(values, p))


@pytest.fixture(scope="module")
def disordered(spark, make_events, tmp_path_factory):
    """The same events, each up to 60 s late: an event may come two files after later ones."""
    ev = some_events(seed=4)
    rng = random.Random(7)
    arrival = sorted(ev, key=lambda e: e[3] + rng.uniform(0, 60))
    folder = str(tmp_path_factory.mktemp("disordered"))
    for k in range(6):
        part = make_events([(f"{i:04d}", u, t, ts, {"v": i % 7}) for i, u, t, ts in arrival[40 * k: 40 * (k + 1)]])
        part.coalesce(1).write.mode("append").parquet(folder)
    # A last event far away lets the watermark pass all others.
    make_events([("9999", "z", "a", ev[-1][3] + 10_000, {"v": 0})]).coalesce(1).write.mode("append").parquet(folder)
    schema = spark.read.parquet(folder).schema
    return ev, lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder), spark.read.parquet(folder)


def test_patterns_do_not_depend_on_arrival(disordered):
    ev, read, _ = disordered
    last = ev[-1][3] + 10_000
    s = PatternDefinition("s", "sequence", ("a", "b", "c"), 40)
    f = PatternDefinition("f", "frequency", ("a", "b"), 30, min_occurrences=3)
    a = PatternDefinition("a", "absence", ("a", "c"), 25)
    out = drain(stream_patterns(read(), PatternSet((s, f, a)), 120)).cache()
    by = lambda n: found(out.filter(F.col("pattern_name") == n))
    assert by("s") == replay.sequence(ev, ("a", "b", "c"), 40)
    assert by("f") == replay.frequency(ev, ("a", "b"), 3, 30)
    assert by("a") == replay.absence(ev, "a", "c", 25, last)


def test_capped_sessions_do_not_depend_on_arrival(disordered):
    _, read, batch = disordered
    fs = FeatureSet(tuple(
        FeatureDefinition(f"{a}_c", a, "session", 0, "v", session_gap_seconds=20, max_session_seconds=50, allowed_lateness_seconds=0)
        for a in ("count", "sum", "avg", "stddev", "first_value", "last_value")
    ))
    want = [r for r in tidy(fs.compute(batch)) if r[1] != "z"]
    assert tidy(drain(stream_all(fs, read(), 120))) == want


def found(alerts):
    rows = alerts.select("entity_id", to_epoch(F.col("match_ts")).alias("t"), F.transform("matched_events", lambda e: e["event_id"].cast("int")).alias("ids"))
    return sorted((r.entity_id, r.t, tuple(r.ids)) for r in rows.collect())


def test_patterns_equal_replay(source):
    ev, read, _ = source
    last = max(e[3] for e in ev)
    s = PatternDefinition("s", "sequence", ("a", "b", "c"), 40)
    f = PatternDefinition("f", "frequency", ("a", "b"), 30, min_occurrences=3)
    a = PatternDefinition("a", "absence", ("a", "c"), 25)
    t = PatternDefinition("t", "threshold", ("a",), 1, threshold_field="v", threshold_value=5)
    out = drain(stream_patterns(read(), PatternSet((s, f, a, t)), 0)).cache()
    by = lambda n: found(out.filter(F.col("pattern_name") == n))
    assert by("s") == replay.sequence(ev, ("a", "b", "c"), 40)
    assert by("f") == replay.frequency(ev, ("a", "b"), 3, 30)
    assert by("a") == replay.absence(ev, "a", "c", 25, last)
    assert len(by("t")) == sum(1 for i, _, k, _ in ev if k == "a" and i % 7 >= 5)
    with pytest.raises(ValueError):
        stream_pattern(read(), PatternDefinition("x", "sequence", ("a", "a"), 40))


def test_store_sink_and_repeat(spark, source, tmp_path):
    ev, read, batch = source
    fs = FeatureSet((FeatureDefinition("sum_t", "sum", "tumbling", 60, "v", allowed_lateness_seconds=0),))
    sink = StoreSink(str(tmp_path / "store"), now=from_epoch(F.lit(5000.0)))
    settings = {k: v for k, v in state_settings(spark).items()}
    assert "spark.sql.streaming.stateStore.providerClass" in settings
    seen = {}

    def twice(df, batch_id):
        sink(df, batch_id)
        seen[batch_id] = df.count()
        # The same batch again, as after a failure.
        sink(df, batch_id)

    start(stream_all(fs, read(), 5), twice, str(tmp_path / "cp"), availableNow=True).awaitTermination()
    wm = max(e[3] for e in ev) - 5
    want = {(r[1], r[3], r[4]) for r in tidy(fs.compute(batch)) if r[3] <= wm}
    store = FeatureStore(spark, str(tmp_path / "store"))
    got = store.history().select("entity_id", to_epoch(F.col("event_time")).alias("t"), "value").collect()
    assert len(got) == len(want) == sum(seen.values()) and set(map(tuple, got)) == want
    assert store.online().count() == 2


def test_dedup_stream(spark, source, tmp_path):
    _, _, batch = source
    fs = FeatureSet((FeatureDefinition("sum_t", "sum", "tumbling", 60, "v"),))
    computed = fs.compute(batch).cache()
    folder = str(tmp_path / "features")
    for _ in range(2):
        computed.coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(computed.schema).option("maxFilesPerTrigger", 1).parquet(folder)
    assert drain(dedup_stream(stream, within_seconds=100_000)).count() == computed.count()


def test_keyed_state(spark, source):
    import pandas as pd

    from tidemark.streaming.state import with_state

    ev, read, _ = source

    def count(key, rows, state):
        if key == "a" and (rows["event_type"] == "c").any():
            state.clear()
        n = state.get("n", 0) + len(rows)
        state.set("n", n)
        return pd.DataFrame({"entity_id": [key], "n": [n]})

    keyed = read().select(F.col("user_id").alias("entity_id"), "event_type")
    out = drain(with_state(keyed, count, "entity_id string, n long")).collect()
    assert max(r.n for r in out if r.entity_id == "h") == sum(1 for e in ev if e[1] == "h")
    assert max(r.n for r in out if r.entity_id == "a") < sum(1 for e in ev if e[1] == "a")


def test_late_split(spark, make_events, tmp_path):
    from tidemark.streaming.lateness import LateSplit

    kept, late = {}, {}
    split = LateSplit(
        str(tmp_path / "wm"), lambda df, b: kept.__setitem__(b, sorted(r.event_id for r in df.collect())),
        lambda df, b: late.__setitem__(b, sorted(r.event_id for r in df.collect())), 5, 30,
    )
    batches = [[("a", 1000), ("b", 1010)], [("c", 970), ("d", 980), ("e", 1100)], [("f", 1060), ("g", 1066)]]
    for i, rows in enumerate(batches):
        df = make_events([(k, "u", "x", t, None) for k, t in rows]).withColumn("seq", F.col("event_id"))
        df = df.withColumn("seq", F.ascii("event_id"))
        split(df, i)
    assert kept == {0: ["a", "b"], 1: ["d", "e"], 2: ["g"]} and late == {0: [], 1: ["c"], 2: ["f"]}
    # The same batch again.
    split(df, 2)
    assert late[2] == ["f"]


def test_progress_log(spark, source):
    import time

    from tidemark.plans import monitor
    from tidemark.streaming.progress import ProgressLog

    _, read, _ = source
    log = ProgressLog(spark)
    spark.streams.addListener(log)
    try:
        drain(read().select("event_id"))
        for _ in range(50):
            if log.frame(spark).filter("kind = 'input_rows'").count() >= 4:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
    got = log.frame(spark)
    assert got.filter("kind = 'input_rows'").agg(F.sum("value")).first()[0] == 240
    assert monitor.latency_summary(got.filter("kind = 'batch_ms'")).first()["count"] >= 4


def test_messages_from_files(spark, tmp_path):
    """Kafka's columns from files: good messages are processed, the others set aside."""
    from tidemark.sources import wire
    from tidemark.sources.kafka import consume

    df = spark.createDataFrame([("u", "f", 1.0, 10.0)], "entity_id string, feature_name string, feature_value double, timestamp double")
    m = wire.encode(df, "t").unionByName(wire.encode(df, "t").withColumn("value", F.lit(b"broken")))
    m.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = wire.decode(spark.readStream.schema(m.schema).parquet(str(tmp_path / "in")))
    ok, bad = [], []
    q = consume(stream, lambda d, b: ok.extend(d.collect()), str(tmp_path / "cp"), "1 second", lambda d, b: bad.extend(d.collect()))
    q.processAllAvailable()
    q.stop()
    assert [r.entity_id for r in ok] == ["u"] and [r._error for r in bad] == ["invalid magic byte"]
