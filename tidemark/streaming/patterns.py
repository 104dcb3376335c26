"""Event patterns on streams (CEP-1..10): a small state machine per key, run by event-time timers.

Events wait until the watermark has passed them and are applied in (ts, arrival) order, whichever micro-batch brought
them, so the alerts are those of the batch operators. Besides the waiting events, state per key is bounded by the
pattern's definition: the steps matched so far, one pending trigger, or fewer than n recent events.
"""

from __future__ import annotations

from functools import reduce
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import arrival, entity, interval
from tidemark.plans.patterns import PatternDefinition, PatternSet, as_alerts, detect, event_struct
from tidemark.streaming.ordered import OrderedProcessor, bucket

MATCH = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("match_us", T.LongType()),
    T.StructField("us", T.ArrayType(T.LongType())),
    T.StructField("ids", T.ArrayType(T.StringType())),
    T.StructField("types", T.ArrayType(T.StringType())),
])

Event = tuple[int, str, str]


class PatternMachine(OrderedProcessor):
    """Common part: the events that a key keeps, and the time that ends their validity."""

    def __init__(self, types: tuple[str, ...], window_us: int, occurrences: int = 1) -> None:
        super().__init__(["us", "seq", "event_id", "event_type"])
        self.types, self.window_us, self.occurrences = types, window_us, occurrences

    def step(self, kept: list[Event], e: Event) -> tuple[list[Event], list[tuple[int, list[Event]]]]:
        """New kept events and matches as (time, events)."""
        raise NotImplementedError

    def expire(self, kept: list[Event]) -> list[tuple[int, list[Event]]]:
        """Matches when the window of the kept events has passed."""
        return []

    def valid_until(self, kept: list[Event]) -> int:
        return kept[0][0] + self.window_us

    def advance(self, key, kept, events, until_us):
        kept = kept or []
        found: list[tuple[int, list[Event]]] = []
        for us, _, event_id, event_type in events:
            kept, matches = self.step(kept, (us, event_id, event_type))
            found.extend(matches)
        if kept and self.valid_until(kept) <= until_us:
            found.extend(self.expire(kept))
            kept = []
        rows = [
            {"entity_id": key, "match_us": t, "us": [e[0] for e in es], "ids": [e[1] for e in es], "types": [e[2] for e in es]}
            for t, es in found
        ]
        return rows, kept, self.valid_until(kept) if kept else None

    def frame(self, rows: list[dict[str, Any]]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=MATCH.names)


class SequenceMachine(PatternMachine):
    def valid_until(self, kept: list[Event]) -> int:
        # An event exactly at the limit still counts, so the state outlives it by one instant.
        return kept[0][0] + self.window_us + 1

    def step(self, kept, e):
        if e[2] == self.types[0]:
            return [e], []
        if not kept or e[2] != self.types[len(kept)]:
            return kept, []
        if e[0] - kept[0][0] > self.window_us:
            return [], []
        kept = [*kept, e]
        return ([], [(e[0], kept)]) if len(kept) == len(self.types) else (kept, [])


class AbsenceMachine(PatternMachine):
    def step(self, kept, e):
        found = []
        if kept and e[0] > kept[0][0] + self.window_us:
            found, kept = self.expire(kept), []
        if e[2] == self.types[0]:
            return [e], found
        return [], found

    def expire(self, kept):
        return [(kept[0][0] + self.window_us, kept)]


class FrequencyMachine(PatternMachine):
    def valid_until(self, kept: list[Event]) -> int:
        return kept[-1][0] + self.window_us + 1

    def step(self, kept, e):
        kept = [k for k in kept if k[0] >= e[0] - self.window_us] + [e]
        return ([], [(e[0], kept)]) if len(kept) >= self.occurrences else (kept, [])


def stream_pattern(events: DataFrame, p: PatternDefinition, delay_seconds: float = 5.0) -> DataFrame:
    """Alerts of one pattern, in the batch format."""
    if p.pattern_type == "threshold":
        return detect(events, p)
    types = p.event_types
    if p.pattern_type == "absence":
        machine, wanted, usable = AbsenceMachine, (types[0], types[-1]) if types else (), len(types) >= 2
    elif p.pattern_type == "sequence":
        machine, wanted, usable = SequenceMachine, types, len(types) >= 2 and types[0] not in types[1:]
    else:
        machine, wanted, usable = FrequencyMachine, types, bool(types)
    if not usable:
        raise ValueError(f"pattern '{p.name}' can never match")
    rows = events.filter(F.col("ts").isNotNull() & F.col("event_type").isin(*sorted(set(wanted)))).select(
        entity(events, p.key_field).alias("entity_id"), F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.unix_micros("ts").alias("us"), arrival(events).alias("seq"), F.timestamp_micros(F.unix_micros("ts")).alias("ts"),
    )
    if isinstance(rows.schema["seq"].dataType, T.IntegralType):
        # Rows without an arrival number come first. A null would make pandas pass the numbers of others as doubles.
        rows = rows.withColumn("seq", F.coalesce(F.col("seq").cast("bigint"), F.lit(-(1 << 63))))
    rows = rows.withColumn("bucket", bucket()).withWatermark("ts", interval(delay_seconds))
    found = rows.groupBy("bucket").transformWithStateInPandas(
        machine(tuple(types), p.window_micros, max(p.min_occurrences, 1)), MATCH, "Append", "EventTime"
    )
    entries = F.transform(
        F.arrays_zip("us", "ids", "types"), lambda e: event_struct(e["us"], e["ids"], e["types"])
    )
    meta = {
        "absence": F.create_map(F.lit("absence_type"), F.lit(types[-1])),
        "frequency": F.create_map(F.lit("count"), F.size("us").cast("string")),
    }.get(p.pattern_type, F.create_map().cast("map<string,string>"))
    return as_alerts(
        found.select(
            "entity_id", F.lit(0).alias("__no"), F.col("match_us").alias("__match_us"), entries.alias("matched_events"), meta.alias("metadata")
        ), [p],
    )


def stream_patterns(events: DataFrame, patterns: PatternSet, delay_seconds: float = 5.0) -> DataFrame:
    """Alerts of all patterns in one streaming frame."""
    return reduce(DataFrame.unionByName, [stream_pattern(events, p, delay_seconds) for p in patterns.definitions])
