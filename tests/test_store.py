from __future__ import annotations

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.functions.columns import from_epoch, to_epoch
from tidemark.plans import dual, store
from tidemark.streaming.sinks import FeatureStore, StoreSink, batches, write_batch


def at(seconds):
    return from_epoch(F.lit(float(seconds)))


@pytest.fixture(scope="module")
def make_history(spark):
    """History from (entity, feature, value, event time, arrival, ttl)."""

    def make(rows, version=1):
        df = spark.createDataFrame(
            [(e, f, float(v), float(t), float(a), i, ttl, version) for i, (e, f, v, t, a, ttl) in enumerate(rows)],
            "entity_id string, feature_name string, value double, t double, a double, seq long, ttl_seconds int, version int",
        )
        return store.records(df.select("*", from_epoch(F.col("t")).alias("event_time"), from_epoch(F.col("a")).alias("ingestion_time")))

    return make


def pairs(df):
    return sorted((r.entity_id, r.feature_name, r.value) for r in df.collect())


def test_records_defaults(spark):
    df = spark.createDataFrame([("u", "f", 1.0, 0), ("u", "g", 2.0, 50)], "entity_id string, feature_name string, value double, ttl_seconds int")
    a = {r.feature_name: r for r in store.records(df, at(1000)).collect()}
    assert a["f"].ttl_seconds == 3600 and a["g"].ttl_seconds == 50 and a["f"].version == 1 and a["f"].op == "set"
    assert a["g"].expires_at.timestamp() - a["g"].event_time.timestamp() == 50
    b = {r.feature_name: r.ttl_seconds for r in store.records(df, at(1000), ttl_seconds=7).collect()}
    assert b == {"f": 7, "g": 7}
    c = store.records(df, at(1000), default_ttl=None).filter("feature_name = 'f'").first()
    assert c.ttl_seconds is None and c.expires_at is None


def test_point_in_time(make_history, spark):
    h = make_history([("u", "f", 10, 1000, 1, 0), ("u", "f", 20, 2000, 2, 0), ("u", "f", 30, 3000, 3, 0), ("u", "f", 15, 1200, 4, 0)])
    spine = spark.createDataFrame([("u", 999.0), ("u", 1000.0), ("u", 1500.0), ("u", 2500.0), ("w", 5000.0)], "entity_id string, t double")
    spine = spine.withColumn("ts", from_epoch(F.col("t")))
    for limit in (None, 2):
        got = {(r.entity_id, r.t): r.value for r in store.at_time(h, spine, ["f"], row_limit=limit).collect()}
        assert got == {("u", 999.0): None, ("u", 1000.0): 10, ("u", 1500.0): 15, ("u", 2500.0): 20, ("w", 5000.0): None}


def test_online_and_expiry(make_history):
    h = make_history([("u", "f", 1, 100, 10, 50), ("u", "f", 2, 90, 11, 50), ("u", "g", 3, 100, 10, 0)])
    # The last write wins, even with an older time.
    assert pairs(store.online(h)) == [("u", "f", 2), ("u", "g", 3)]
    assert pairs(store.online(h, by_event_time=True)) == [("u", "f", 1), ("u", "g", 3)]
    v = store.online(h)
    assert pairs(store.get_features(v, at(140))) == [("u", "f", 2), ("u", "g", 3)]
    assert pairs(store.get_features(v, at(140.000001))) == [("u", "g", 3)]
    assert pairs(store.expired(v, at(141))) == [("u", "f", 2)]
    assert store.list_entities(v).count() == 1 and tuple(store.counts(v).first()) == (1, 2)
    assert [r.feature_name for r in store.list_features(v, at(141)).collect()] == ["g"]


def test_versions_and_batch_get(make_history, spark):
    h = make_history([("u1", "f", i, i, i, 0) for i in range(1, 14)] + [("u2", "f", 5, 1, 1, 0)])
    last = store.versions(h).filter("entity_id = 'u1'").orderBy("version_rank").collect()
    assert len(last) == 10 and last[0].value == 13.0
    assert store.versions(h, None).count() == 14
    asked = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "entity_id string")
    got = {r.entity_id: (r.f, r.g) for r in store.batch_get(store.online(h), asked, ["f", "g"], at(10)).collect()}
    assert got == {"u1": (13.0, None), "u2": (5.0, None), "u3": (None, None)}


def test_deletion(make_history, spark):
    h = make_history([("u", "f", 1, 1, 1, 0), ("u", "g", 2, 1, 1, 0), ("w", "f", 3, 1, 1, 0)])
    one = spark.createDataFrame([("u", "f")], "entity_id string, feature_name string")
    after = h.unionByName(store.tombstones(one, at(5)))
    assert pairs(store.online(after)) == [("u", "g", 2), ("w", "f", 3)]
    assert pairs(store.online(after, True)) == [("u", "g", 2), ("w", "f", 3)]
    # A deleted feature keeps its past, a deleted entity does not.
    assert pairs(store.latest(after)) == [("u", "f", 1), ("u", "g", 2), ("w", "f", 3)]
    gone = after.unionByName(store.tombstones(spark.createDataFrame([("u",)], "entity_id string"), at(6)))
    assert pairs(store.online(gone)) == [("w", "f", 3)] == pairs(store.latest(gone))
    again = gone.unionByName(make_history([("u", "f", 9, 1, 7, 0)]))
    assert pairs(store.online(again)) == [("u", "f", 9), ("w", "f", 3)]


def test_hit_rate_and_ttl(make_history, spark):
    v = store.online(make_history([("u", "f", 1, 100, 1, 50), ("u", "g", 2, 100, 1, 500)]))
    ask = spark.createDataFrame([("u", "f"), ("u", "g"), ("u", "h"), ("x", "f"), ("x", "g")], "entity_id string, feature_name string")
    # f expired, g valid, h absent, x unknown: one miss in total.
    assert tuple(store.hit_rate(v, ask, at(200)).first()) == (1, 3, 0.25)
    assert tuple(store.hit_rate(v, ask.filter("false"), at(200)).first()) == (0, 0, 0.0)
    left = {(r.entity_id, r.feature_name): r.ttl_remaining for r in store.ttl_remaining(v, ask, at(200)).collect()}
    assert left[("u", "g")] == 400 and left[("u", "f")] == left[("x", "f")] == -2
    forever = v.withColumn("expires_at", F.lit(None).cast("timestamp"))
    assert {r.ttl_remaining for r in store.ttl_remaining(forever, ask.limit(1), at(200)).collect()} == {-1}


def test_offline_queries(make_history, spark):
    h = make_history([("u", "f", i, 10 * i, i, 0) for i in range(6)] + [("u", "f", 99, 20, 50, 0)])
    assert store.offline(h).count() == 6
    rng = store.time_range(h, at(10), at(30), limit=2).orderBy("newest_rank").collect()
    assert [r.value for r in rng] == [3.0, 99.0]
    assert store.time_range(h, at(10), at(30)).count() == 3
    none = spark.createDataFrame([("zz",)], "entity_id string")
    assert store.time_range(h, at(10), at(30), none).count() == 0 and store.time_range(h, at(0), at(99), names=["g"]).count() == 0
    assert [r.value for r in store.latest(h).collect()] == [5.0]
    assert store.entity_index(h).select(to_epoch(F.col("last_updated")).alias("t")).first().t == 50
    assert store.retained(h, at(60), 20).count() == 1


def test_exports(make_history, spark):
    h = make_history([("u", "f", 1.5, 100, 1, 0)])
    text = spark.createDataFrame([("u", "name", json.dumps("ann"))], "entity_id string, feature_name string, value_json string")
    v = store.online(h.unionByName(store.records(text, at(100))))
    kv = {r.key: json.loads(r.value) for r in store.kv_pairs(v).collect()}
    assert kv["feature:u:f"] == {"v": 1.5, "ver": 1, "ts": 100.0, "meta": {}} and kv["feature:u:name"]["v"] == "ann"
    line = json.loads(store.log_lines(h).first().value)
    assert line["entity_id"] == "u" and line["value"] == 1.5 and line["timestamp"] == 100.0
    nested = store.nested_snapshot(v, at(100)).first()
    assert nested.features["f"].value == 1.5 and nested.features["name"].value_json == '"ann"'


def test_consistency_and_repair(make_history, spark):
    on = store.online(make_history([("a", "f", 1, 100, 1, 0), ("b", "f", 1, 100, 1, 0), ("c", "f", 1, 100, 1, 0), ("d", "f", 1, 200, 1, 0)]))
    off = store.latest(make_history([("a", "f", 1, 100, 1, 0), ("b", "f", 2, 100, 1, 0), ("d", "f", 2, 100, 1, 0), ("e", "f", 1, 100, 1, 0)]))
    ask = spark.createDataFrame([(k, "f") for k in "abcdez"], "entity_id string, feature_name string")
    rep = {r.entity_id: (r.is_consistent, r.details) for r in dual.consistency(on, off, ask).collect()}
    assert rep == {
        "a": (True, ""), "b": (False, "Value mismatch"), "c": (False, "Missing from offline store"),
        "d": (False, "Temporal drift: 100.0s"), "e": (False, "Missing from online store"), "z": (True, "Both stores empty"),
    }
    assert [r.entity_id for r in dual.repair_rows(on, off).orderBy("entity_id").collect()] == ["b", "d", "e"]
    assert [r.entity_id for r in dual.repair_rows(on, off, "online").orderBy("entity_id").collect()] == ["b", "c", "d"]
    got = {r.entity_id: (r.value, r.origin) for r in dual.read_with_fallback(on, off).collect()}
    assert got["e"] == (1.0, "offline") and got["b"] == (1.0, "online")
    assert [r.entity_id for r in dual.backfill_rows(on, off).collect()] == ["e"]
    with pytest.raises(ValueError):
        dual.repair_rows(on, off, "both")


def test_dedup(make_history):
    h = make_history([("a", "f", 1, 100, 1, 0), ("a", "f", 2, 100, 2, 0), ("a", "f", 3, 200, 3, 0)])
    assert pairs(dual.dedup(h, ["entity_id", "feature_name", "event_time"])) == [("a", "f", 1), ("a", "f", 3)]
    assert pairs(dual.last_per_feature(h)) == [("a", "f", 3)]
    assert pairs(dual.unseen(h, h.filter("value = 3"))) == [("a", "f", 1)]


def computed(spark, *rows):
    df = spark.createDataFrame([(e, f, float(v), float(t)) for e, f, v, t in rows], "entity_id string, feature_name string, feature_value double, t double")
    return df.select("entity_id", "feature_name", "feature_value", from_epoch(F.col("t") - 60).alias("window_start"), from_epoch(F.col("t")).alias("window_end"), F.lit(1).alias("event_count"))


def test_rows_are_picked_by_a_limit_before_the_shuffle(make_history):
    """No sort-based aggregation of whole rows: what a key does not need stays in its task."""
    h = make_history([("a", "f", 1, 100, 1, 0), ("a", "f", 2, 100, 2, 0), ("a", "f", 3, 200, 3, 0)])
    for df in (dual.dedup(h, ["entity_id", "feature_name", "event_time"]), dual.last_per_feature(h)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "WindowGroupLimit" in plan and "Partial" in plan
        assert df.columns == h.columns


def test_deletions_look_for_their_targets_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    targets = spark.createDataFrame([("u",), ("v",)], "entity_id string").mapInArrow(count, "entity_id string")
    fs = FeatureStore(spark, str(tmp_path))
    fs.delete(targets)
    assert seen.value == 2 and sorted(r.entity_id for r in fs.history().collect()) == ["u", "v"]


def test_sink_is_replay_safe(spark, tmp_path):
    sink = StoreSink(str(tmp_path), now=at(1000))
    batch = computed(spark, ("u", "f", 1, 60), ("u", "f", 2, 120), ("u", "f", 2, 120))
    sink(batch, 0)
    sink(batch, 0)
    fs = FeatureStore(spark, str(tmp_path))
    assert pairs(fs.history().select("entity_id", "feature_name", "value")) == [("u", "f", 1), ("u", "f", 2)]
    assert pairs(fs.online()) == [("u", "f", 2)]
    assert sink.metrics["batches"] == 1 and sink.metrics["records_written"] == 2


def test_store_folder(spark, tmp_path):
    fs = FeatureStore(spark, str(tmp_path))
    assert fs.online().count() == 0 and fs.compact() == 0
    w = spark.createDataFrame([("u", "f", 1.0, 10), ("u", "g", 2.0, 9999), ("w", "f", 3.0, 9999)], "entity_id string, feature_name string, value double, ttl_seconds int")
    assert fs.set_features(w, at(100)) != fs.delete(spark.createDataFrame([("w",)], "entity_id string"), at(101))
    assert pairs(fs.online()) == [("u", "f", 1), ("u", "g", 2)]
    assert fs.compact(at(200)) == 1
    assert pairs(fs.online()) == [("u", "g", 2)]
    fs.set_features(w.limit(1), at(300))
    assert pairs(fs.online()) == [("u", "f", 1), ("u", "g", 2)]
    assert fs.compact(at(305)) == 0 and pairs(fs.online()) == [("u", "f", 1), ("u", "g", 2)]
    assert batches(spark, f"{tmp_path}/online") == ["writer=compact/batch_id=1"]
    fs.export_snapshot(str(tmp_path / "snap"), at(305))
    assert spark.read.json(str(tmp_path / "snap")).count() == 1


def test_writers_do_not_overwrite_each_other(spark, tmp_path):
    fs, sink = FeatureStore(spark, str(tmp_path)), StoreSink(str(tmp_path))
    w = spark.createDataFrame([("z", "f", 9.0)], "entity_id string, feature_name string, value double")
    sink(computed(spark, ("u", "f", 1, 60)), 0)
    fs.set_features(w)
    sink(computed(spark, ("u", "f", 2, 120)), 1)
    fs.delete(spark.createDataFrame([("u", "f")], "entity_id string, feature_name string"))
    sink(computed(spark, ("v", "f", 3, 120)), 2)
    assert pairs(fs.online()) == [("v", "f", 3), ("z", "f", 9)]
    assert fs.history().filter("op = 'set'").count() == 4
    before = sorted(map(str, fs.history().collect()))
    sink(computed(spark, ("v", "f", 3, 120)), 2)
    assert sorted(map(str, fs.history().collect())) == before


def test_deletions_hold_against_late_writes(spark, tmp_path):
    """A write fails, its entity is deleted, the store compacted and the write retried: it stays deleted."""
    def broken(df, path, batch):
        if path.endswith("online"):
            raise OSError("online is down")
        write_batch(df, path, batch)

    fs, down = FeatureStore(spark, str(tmp_path)), []
    sink = StoreSink(str(tmp_path), "sync_both", "queue_retry", now=at(100), writer=lambda *a: (broken if down else write_batch)(*a))
    down.append(1)
    sink(computed(spark, ("u", "f", 1, 60), ("v", "f", 2, 60), ("v", "g", 3, 60)), 0)
    down.clear()
    entity, feature = spark.createDataFrame([("u",)], "entity_id string"), spark.createDataFrame([("v", "g")], "entity_id string, feature_name string")
    fs.delete(entity, at(200))
    fs.delete(feature, at(200))
    assert fs.oldest_open_write() == 100_000_000
    for _ in range(2):
        fs.compact()
    assert fs.online().count() == 0 and fs.online_log().count() == 2
    assert fs.retry_failed() == (1, 0) and pairs(fs.online()) == [("v", "f", 2)]
    # Nothing older can come any more: the marks go with the next compaction, the result stays.
    assert fs.oldest_open_write() is None
    fs.compact()
    assert pairs(fs.online()) == [("v", "f", 2)] and fs.online_log().count() == 1


def test_marks_wait_for_batches_that_may_be_repeated(spark, tmp_path):
    fs, sink = FeatureStore(spark, str(tmp_path)), StoreSink(str(tmp_path), name="s")
    batch = computed(spark, ("u", "f", 1, 60))
    sink(batch, 7)
    fs.delete(spark.createDataFrame([("u",)], "entity_id string"))
    fs.compact()
    sink(batch, 7)  # Spark repeats the batch after a restart, with the time of its first attempt
    assert fs.online().count() == 0
    sink(batch, 8)
    assert pairs(fs.online()) == [("u", "f", 1)]
    fs.compact()
    assert fs.online_log().filter("op <> 'set'").count() == 0


def test_an_interrupted_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    fs = FeatureStore(spark, str(tmp_path))
    w = spark.createDataFrame([("u", "f", 1.0), ("w", "f", 3.0)], "entity_id string, feature_name string, value double")
    fs.set_features(w, at(100))
    fs.delete(spark.createDataFrame([("w",)], "entity_id string"), at(101))

    def stop(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr("tidemark.streaming.sinks.remove", stop)
    with pytest.raises(RuntimeError):
        fs.compact()
    monkeypatch.undo()
    assert pairs(fs.online()) == [("u", "f", 1)]
    fs.compact()
    assert pairs(fs.online()) == [("u", "f", 1)] and batches(spark, f"{tmp_path}/online") == ["writer=compact/batch_id=1"]


def test_history_is_dropped_by_partition_names_only(spark, tmp_path):
    fs, day = FeatureStore(spark, str(tmp_path)), 86_400
    StoreSink(str(tmp_path), now=at(9 * day))(computed(spark, *[("u", "f", i, i * day + 60) for i in range(6)]), 0)
    StoreSink(str(tmp_path), now=at(9 * day), name="other")(computed(spark, ("w", "f", 9, 60), ("w", "f", 9, 5 * day)), 0)
    for f in tmp_path.glob("offline/*/*/event_date=1970-01-0[123]/*.parquet"):
        f.write_bytes(b"not to be read")
    assert fs.drop_history_before(date(1970, 1, 4)) == 4
    assert pairs(fs.history().select("entity_id", "feature_name", "value")) == [("u", "f", 3), ("u", "f", 4), ("u", "f", 5), ("w", "f", 9)]
    assert fs.drop_history_before(date(1970, 1, 4)) == 0


def test_failed_online_writes_are_retried(spark, tmp_path):
    def broken(df, path, batch):
        if path.endswith("online"):
            raise OSError("online is down")
        write_batch(df, path, batch)

    StoreSink(str(tmp_path), "sync_both", "queue_retry", writer=broken)(computed(spark, ("u", "f", 1, 60), ("u", "f", 2, 120)), 0)
    fs = FeatureStore(spark, str(tmp_path))
    assert fs.online().count() == 0 and fs.history().count() == 2
    assert fs.retry_failed() == (1, 0) and pairs(fs.online()) == [("u", "f", 2)]
    assert fs.retry_failed() == (0, 0)


@pytest.mark.parametrize(("strategy", "policy", "online", "offline"), [
    ("sync_both", "best_effort", 1, 0), ("online_first", "queue_retry", 1, 0), ("offline_first", "best_effort", 1, 0),
])
def test_failures(spark, tmp_path, strategy, policy, online, offline):
    def broken(df, path, batch_id):
        if path.endswith("offline"):
            raise OSError("offline is down")
        write_batch(df, path, batch_id)

    sink = StoreSink(str(tmp_path), strategy, policy, now=at(1), writer=broken)
    sink(computed(spark, ("u", "f", 1, 60)), 0)
    fs = FeatureStore(spark, str(tmp_path))
    assert (fs.online().count(), fs.history().count()) == (online, offline)
    assert fs.retry_failed() == (1, 0)
    assert fs.history().count() == 1 and fs.retry_failed() == (0, 0)


def test_fail_fast_stops(spark, tmp_path):
    def broken(df, path, batch_id):
        raise OSError("down")

    with pytest.raises(OSError):
        StoreSink(str(tmp_path), "offline_first", now=at(1), writer=broken)(computed(spark, ("u", "f", 1, 60)), 0)
    with pytest.raises(ValueError):
        StoreSink(str(tmp_path), "both")
