"""Windowed features on streams (PIPE-7..10, WIN-3..5, WIN-8).

The same feature set as in batch. Windows are emitted once, when the watermark passes their end (append mode).
"""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import runtime
from tidemark.functions import aggregates as A
from tidemark.functions import windows as W
from tidemark.functions.columns import interval
from tidemark.plans.features import OUTPUT, FeatureSet, _base_rows, _long, _order, _Spec
from tidemark.streaming.run import state_settings
from tidemark.streaming.sessions import capped_sessions


def stream_features(features: FeatureSet, events: DataFrame, delay_seconds: float = 5.0) -> list[DataFrame]:
    """One streaming frame in the batch output format per (key, window) specification.

    Each is meant for a query of its own, so specifications keep separate state and checkpoints. State is kept for the
    delay plus the largest allowed lateness (D-2); later events are dropped.
    """
    allowed = max((f.allowed_lateness_seconds for f in features.definitions), default=0.0)
    bounded = events.withWatermark("ts", interval(delay_seconds + allowed))
    return [_stream_spec(bounded, s) for s in features.specs()]


def _stream_spec(events: DataFrame, spec: _Spec) -> DataFrame:
    rows = _base_rows(events, spec)
    f = spec.first
    if spec.window[0] == "session":
        rule: W.SessionRule = spec.window[1]
        if rule.max_micros is not None:
            return capped_sessions(rows, spec.features, rule)
        w = F.session_window("ts", f"{rule.join_micros} microseconds")
        agg = _aggregate(rows, spec, w, F.max(F.unix_micros("ts")).alias("__last"))
        end = F.timestamp_micros(rule.end(F.unix_micros("__w.start"), F.col("__last")))
        return _long(agg, spec.features, F.col("__w.start"), end)
    if spec.window[0] == "tumbling":
        w = W.tumbling(F.col("ts"), f.window_size_seconds, f.offset_seconds)
    else:
        w = W.sliding(F.col("ts"), f.window_size_seconds, f.slide)
    distinct = [f for f in spec.features if f.aggregation == "distinct_count" and not f.approx]
    rest = [f for f in spec.features if f not in distinct]
    parts = []
    if distinct:
        own = spec.only(distinct)
        parts.append(_distinct(_base_rows(events, own), own, w))
    if rest:
        own = spec.only(rest)
        parts.append(_long(_aggregate(_base_rows(events, own), own, w), own.features, F.col("__w.start"), F.col("__w.end")))
    return reduce(DataFrame.unionByName, parts)


def _distinct(rows: DataFrame, spec: _Spec, window: Column) -> DataFrame:
    """Exact distinct counts in two steps of state (AGG-6): rows by value, then values by window.

    A state row has a count and no set, however many values a window has, and values are spread over all tasks. Both
    steps close a window with the watermark, so the second sees a value once.
    """
    entries = [F.struct(F.lit(f.name).alias("feature_name"), F.col(f"d{i}").alias("__x"), F.col(f"v{i}").alias("__v")) for i, f in enumerate(spec.features)]
    routed = rows.select("entity_id", "ts", F.inline(F.array(*entries))).filter(F.col("__v").isNotNull())
    values = routed.groupBy("entity_id", window.alias("__w"), "feature_name", "__x").agg(F.count(F.lit(1)).alias("n"))
    counts = values.groupBy("entity_id", "__w", "feature_name").agg(F.count(F.lit(1)).cast("double").alias("feature_value"), F.sum("n").alias("event_count"))
    return counts.select(
        "entity_id", "feature_name", "feature_value", F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), "event_count"
    ).select(*OUTPUT)


def _aggregate(rows: DataFrame, spec: _Spec, window: Column, *extra: Column) -> DataFrame:
    cols = []
    for i, f in enumerate(spec.features):
        v = F.col(f"v{i}")
        d = F.col(f"d{i}") if f.aggregation == "distinct_count" else None
        cols.append(
            A.from_rows(f.aggregation, v, _order(rows), d, f.percentile_value, f.approx, streaming=True).alias(f"f{i}")
        )
        cols.append(F.count(v).alias(f"n{i}"))
    return rows.groupBy("entity_id", window.alias("__w")).agg(*cols, *extra)


def stream_all(features: FeatureSet, events: DataFrame, delay_seconds: float = 5.0) -> DataFrame:
    """All specifications in one streaming frame, for one query."""
    return reduce(DataFrame.unionByName, stream_features(features, events, delay_seconds))




def update_windows(features: FeatureSet, events: DataFrame, path: str, checkpoint: str, delay_seconds: float = 5.0, **trigger: Any) -> list[StreamingQuery]:
    """Keep the open windows of a stream in a table as they change (WIN-8): a query per specification.

    Every micro-batch writes the windows that it has changed, in a directory of its own that a repeat overwrites;
    ``current_windows`` reads the newest state of each. Sessions and exact distinct counts have no such form in Spark.
    """
    queries = []
    for n, (frame, spec) in enumerate(zip(stream_features(features, events, delay_seconds), features.specs())):
        if spec.window[0] == "session" or any(f.aggregation == "distinct_count" and not f.approx for f in spec.features):
            raise ValueError("open sessions and exact distinct counts are not available as updates")

        def write(batch: DataFrame, batch_id: int, n: int = n) -> None:
            batch.write.mode("overwrite").parquet(f"{path}/spec={n}/batch_id={batch_id}")

        with runtime.settings(events.sparkSession, state_settings(events.sparkSession)):
            writer = frame.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{checkpoint}/{n}")
            queries.append((writer.trigger(**trigger) if trigger else writer).start())
    return queries


def current_windows(spark: SparkSession, path: str) -> DataFrame:
    """The newest state of every window written by ``update_windows``, open and closed ones."""
    kinds = "entity_id string, feature_name string, feature_value double, window_start timestamp, window_end timestamp, event_count bigint, spec int, batch_id bigint"
    key = ["entity_id", "feature_name", "window_start", "window_end"]
    rows = spark.read.schema(kinds).option("basePath", path).parquet(path)
    newest = rows.groupBy(*key).agg(F.max_by(F.struct("feature_value", "event_count"), "batch_id").alias("r"))
    return newest.select(*key, "r.*").select(*OUTPUT)
