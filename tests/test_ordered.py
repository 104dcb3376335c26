"""State of ordered streams: by buckets of keys, with counted values in rows of their own."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark import catalog, runtime
from tidemark.plans.features import FeatureDefinition, FeatureSet
from tidemark.plans.patterns import PatternDefinition
from tidemark.streaming.features import stream_all
from tidemark.streaming.ordered import BUCKETS
from tidemark.streaming.patterns import stream_pattern
from tidemark.streaming.run import state_settings
from tidemark.streaming.sessions import COUNT_ROWS, FEW_VALUES, CappedSessions

USERS = 4000


def progress(spark, stream):
    """The micro-batches of a stream that is run to its end."""
    with runtime.settings(spark, state_settings(spark)):
        writer = stream.writeStream.format("noop").option("checkpointLocation", runtime.scratch_path(spark, "progress"))
        q = writer.trigger(availableNow=True).start()
        q.awaitTermination()
    return q.recentProgress


@pytest.mark.parametrize("kind", ["pattern", "session"])
def test_state_is_kept_by_buckets(spark, make_events, tmp_path, kind):
    """Rows and timers in state, and so calls to it, do not grow with the number of keys."""
    folder = str(tmp_path / "in")
    for k in range(2):
        make_events([(f"{k}-{u}", f"u{u}", "a", 1000 + k, {"v": u}) for u in range(USERS)]).coalesce(1).write.mode("append").parquet(folder)
    stream = spark.readStream.schema(spark.read.parquet(folder).schema).option("maxFilesPerTrigger", 1).parquet(folder)
    if kind == "pattern":
        out = stream_pattern(stream, PatternDefinition("s", "sequence", ("a", "b"), 40), 60)
    else:
        out = stream_all(FeatureSet((FeatureDefinition("n", "count", "session", 0, "v", session_gap_seconds=20, max_session_seconds=50),)), stream, 60)
    rows = max(s["numRowsTotal"] for p in progress(spark, out) for s in p["stateOperators"])
    # Two micro-batches' events of every bucket and its timer; by keys there would be three rows for each user.
    assert 0 < rows <= 5 * BUCKETS < 3 * USERS


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_micro_batches_are_as_many_as_weeks(spark, tmp_path):
    """However many partitions the table is read in."""
    raw = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    raw.repartition(8).write.parquet(str(tmp_path / "events.parquet"))
    with runtime.settings(spark, {"spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "0"}):
        assert spark.read.parquet(str(tmp_path / "events.parquet")).rdd.getNumPartitions() >= 8
        seen = [p for p in progress(spark, catalog.disordered_stream(spark, str(tmp_path)).select("event_id")) if p["numInputRows"]]
    weeks = raw.select(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / (7 * catalog.DAY))).distinct().count()
    assert len(seen) <= weeks + 1 and sum(p["numInputRows"] for p in seen) == raw.count()


class Map:
    """Map state in memory."""

    def __init__(self):
        self.rows = {}

    def getValue(self, key):  # noqa: N802
        return self.rows[key]

    def updateValue(self, key, value):  # noqa: N802
        self.rows[key] = value

    def removeKey(self, key):  # noqa: N802
        del self.rows[key]


@pytest.mark.parametrize("kind", ["distinct_count", 75.0])
def test_many_counted_values(kind):
    """A session that stays open over many rounds gives what it gives in one, and leaves no rows behind."""
    rng = random.Random(3)
    values = [float(rng.randrange(4000)) for _ in range((COUNT_ROWS + 8) * 3 * FEW_VALUES)]
    events = [(t, "", [v], [str(v)]) for t, v in enumerate(values)]
    results = []
    for step in (len(events), 3 * FEW_VALUES):
        machine = CappedSessions([kind], 10, 10, 10**9)
        machine.counts, kept, most = Map(), None, 0
        for i in range(0, len(events), step):
            rows, kept, due = machine.advance("u", kept, events[i : i + step], events[min(i + step, len(events)) - 1][0])
            most = max(most, len(machine.counts.rows))
            assert rows == [] and due is not None and len(kept["counted"]) <= FEW_VALUES
        rows, kept, due = machine.advance("u", kept, [], due)
        assert kept is None and due is None and machine.counts.rows == {} and 0 < most <= COUNT_ROWS
        results.append(rows)
    assert results[0] == results[1]
    want = float(len(set(values))) if kind == "distinct_count" else sorted(values)[int((len(values) - 1) * 0.75)]
    assert results[0][0]["by_value"][0] == pytest.approx(want, abs=1.0)
