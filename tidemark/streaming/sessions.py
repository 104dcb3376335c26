"""Sessions with a length limit on streams (WIN-4): the open session of each key in state, ended by event-time timers.

Events are applied in time order once the watermark has passed them, so sessions, first and last values are those of
the batch operator. State per key is one open session besides the waiting events. Distinct counts and percentiles count
values; more than a few of them go to state rows of their own, which are read when the session is over.
"""

from __future__ import annotations

import pickle
from collections.abc import Sequence
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

from tidemark.functions.windows import SessionRule
from tidemark.streaming.ordered import OrderedProcessor, bucket

# Aggregations that need every value of a session with its count.
BY_VALUE = ("distinct_count", "percentile")

# Per feature: count, sum, smallest, largest, first, last, and mean and squared deviations for the spread.
PARTS = ("n", "s", "lo", "hi", "first", "newest", "mean", "m2")
# Counted values that stay with their open session, and rows of counted values that are merged into one.
FEW_VALUES, COUNT_ROWS = 256, 32
OUT = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("start", T.LongType()),
    T.StructField("last", T.LongType()),
    *[T.StructField(c, T.ArrayType(T.LongType() if c == "n" else T.DoubleType())) for c in PARTS],
    T.StructField("by_value", T.ArrayType(T.DoubleType())),
])


def percentile(counted: Sequence[tuple[float, int]], p: float) -> float:
    """The percentile, interpolated between neighbours, of values with their counts."""
    ordered = sorted(counted)
    at = (sum(n for _, n in ordered) - 1) * p / 100.0
    low, found, before = int(at), [], 0
    for value, n in ordered:
        found += [value] * sum(before <= k < before + n for k in (low, low + 1))
        before += n
        if len(found) == 2:
            break
    return found[0] + (at - low) * (found[-1] - found[0])


class CappedSessions(OrderedProcessor):
    """Keeps the open session of a key and emits it when it is over.

    ``by_value`` has, for each feature, None, "distinct_count", or the percentile wanted.
    """

    def __init__(self, by_value: Sequence[Any], join_us: int, gap_us: int, max_us: int) -> None:
        super().__init__(["us", "seq", "v", "d"])
        self.by_value, self.width, self.join_us, self.gap_us, self.max_us = list(by_value), len(by_value), join_us, gap_us, max_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.counts = handle.getMapState("counts", "entity_id string, part int", "counted binary")

    def _count(self, s: dict[str, Any], values: Sequence[float | None], names: Sequence[str | None]) -> None:
        """Count an event's values."""
        counted = s["counted"]
        for i, kind in enumerate(self.by_value):
            if kind is not None and values[i] is not None and values[i] == values[i]:
                key = (i, str(names[i]) if kind == "distinct_count" else values[i] + 0.0)
                counted[key] = counted.get(key, 0) + 1

    def _merge(self, key: str, s: dict[str, Any]) -> dict[tuple[int, Any], int]:
        """All counted values of a session; its own rows are removed."""
        for part in range(s["rows"]):
            for k, n in pickle.loads(self.counts.getValue((key, part))[0]).items():
                s["counted"][k] = s["counted"].get(k, 0) + n
            self.counts.removeKey((key, part))
        s["rows"] = 0
        return s["counted"]

    def _keep(self, key: str, s: dict[str, Any]) -> None:
        """Before a session goes to state: many counted values get a row of their own, many rows become one."""
        if len(s["counted"]) <= FEW_VALUES:
            return
        if s["rows"] == COUNT_ROWS:
            self._merge(key, s)
        self.counts.updateValue((key, s["rows"]), (pickle.dumps(s["counted"]),))
        s["counted"], s["rows"] = {}, s["rows"] + 1

    def _finish(self, key: str, s: dict[str, Any]) -> dict[str, Any]:
        """The output row of a session that is over, with what its counted values give."""
        found: list[list[tuple[Any, int]]] = [[] for _ in self.by_value]
        for (i, value), n in self._merge(key, s).items():
            found[i].append((value, n))
        results: list[float | None] = []
        for kind, counted in zip(self.by_value, found):
            if kind is None or not counted:
                results.append(None)
            else:
                results.append(float(len(counted)) if kind == "distinct_count" else percentile(counted, kind))
        return {"entity_id": key, **{k: s[k] for k in ("start", "last", *PARTS)}, "by_value": results}

    def _over(self, s: dict[str, Any]) -> int:
        """When the session has ended and nothing can join it any more."""
        end = min(s["last"] + self.gap_us, s["start"] + self.max_us)
        return max(end, min(s["last"] + self.join_us, s["start"] + self.max_us) + 1)

    def _fresh(self, us: int) -> dict[str, Any]:
        made: dict[str, Any] = {"start": us, "last": us, "counted": {}, "rows": 0}
        for c in PARTS:
            made[c] = [0] * self.width if c == "n" else [0.0 if c in ("s", "mean", "m2") else None] * self.width
        return made

    def _add(self, s: dict[str, Any], us: int, values: Sequence[float | None]) -> None:
        s["last"] = max(s["last"], us)
        for i, v in enumerate(values):
            if v is None or v != v:
                continue
            v = float(v)
            if s["n"][i] == 0:
                s["lo"][i] = s["hi"][i] = s["first"][i] = v
            s["n"][i] += 1
            s["s"][i] += v
            s["lo"][i], s["hi"][i], s["newest"][i] = min(s["lo"][i], v), max(s["hi"][i], v), v
            off = v - s["mean"][i]
            s["mean"][i] += off / s["n"][i]
            s["m2"][i] += off * (v - s["mean"][i])

    def advance(self, key, kept, events, until_us):
        s, done = kept, []
        for us, _, values, names in events:
            if s is None or us - s["last"] > self.join_us or us > s["start"] + self.max_us:
                if s is not None:
                    done.append(self._finish(key, s))
                s = self._fresh(us)
            self._add(s, us, values)
            self._count(s, values, names)
        if s is not None and self._over(s) <= until_us:
            done.append(self._finish(key, s))
            s = None
        if s is None:
            return done, None, None
        self._keep(key, s)
        return done, s, self._over(s)

    def frame(self, rows: list[dict[str, Any]]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=OUT.names)


def _arrival(rows: DataFrame) -> Column:
    """The arrival part of the order, as text that sorts like it."""
    if "__order" not in rows.columns:
        return F.lit("")
    if isinstance(rows.schema["__order"].dataType, T.StructType):
        return F.col("__order.s").cast("string")
    number = F.expr("pmod(__order, cast('20000000000000000000' as decimal(38,0)))")
    return F.lpad(number.cast("decimal(20,0)").cast("string"), 20, "0")


def capped_sessions(rows: DataFrame, features: Sequence[Any], rule: SessionRule) -> DataFrame:
    """Session features in the output format, from base rows with one value column per feature."""
    from tidemark.plans.features import OUTPUT

    cols = [F.col(f"v{i}") for i in range(len(features))]
    names = [F.col(f"d{i}").cast("string") if f.aggregation == "distinct_count" else F.lit(None).cast("string") for i, f in enumerate(features)]
    slim = rows.select(
        bucket(), "entity_id", "ts", F.unix_micros("ts").alias("us"), _arrival(rows).alias("seq"), F.array(*cols).alias("v"), F.array(*names).alias("d")
    )
    by_value = [{"distinct_count": "distinct_count", "percentile": f.percentile_value}.get(f.aggregation) for f in features]
    done = slim.groupBy("bucket").transformWithStateInPandas(
        CappedSessions(by_value, rule.join_micros, rule.gap_micros, rule.max_micros), OUT, "Append", "EventTime"
    )
    pick = {"count": "n", "sum": "s", "min": "lo", "max": "hi", "first_value": "first", "last_value": "newest"}
    entries = []
    for i, f in enumerate(features):
        n = F.col("n")[i]
        if f.aggregation in BY_VALUE:
            v = F.col("by_value")[i]
        elif f.aggregation == "avg":
            v = F.col("s")[i] / n
        elif f.aggregation == "stddev":
            v = F.when(n > 1, F.sqrt(F.col("m2")[i] / (n - 1))).otherwise(F.lit(0.0))
        else:
            v = F.col(pick[f.aggregation])[i].cast("double")
        entries.append(F.struct(F.lit(f.name).alias("feature_name"), v.alias("feature_value"), n.alias("event_count")))
    return (
        done.select(
            "entity_id", F.timestamp_micros("start").alias("window_start"),
            F.timestamp_micros(rule.end(F.col("start"), F.col("last"))).alias("window_end"), F.inline(F.array(*entries)),
        )
        .filter(F.col("event_count") > 0)
        .select(*OUTPUT)
    )
