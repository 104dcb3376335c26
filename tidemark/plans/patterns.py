"""Temporal event patterns, batch (CEP-1..11): sequence, absence, frequency, threshold.

Events of a key are taken in (ts, arrival) order. All patterns that share a key are found in one scan: one projection of
the needed types, one look for hot keys, one ordered pass that carries the running values of every pattern. No pattern
gathers a key's events in one place.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, fields, replace
from datetime import datetime
from functools import reduce
from math import lcm
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.functions import columns as C
from tidemark.operators.chain import greedy_chain
from tidemark.operators.joins import join_on
from tidemark.operators.slices import Running, lag_rows, running, with_slices

# Severity by pattern type; any other type is INFO.
SEVERITY = {"threshold": "HIGH", "frequency": "MEDIUM", "absence": "MEDIUM", "sequence": "LOW"}

ALERT_COLUMNS = (
    "alert_id", "pattern_name", "pattern_type", "severity", "entity_id", "message", "match_ts", "matched_events",
    "event_count", "time_span_seconds", "confidence", "metadata",
)

ORDER = ["__us", "seq"]
# Scaled row numbers stay below the largest whole number for up to 10^12 rows of a key.
COMMON_MULTIPLE = 1_000_000


@dataclass(frozen=True)
class PatternDefinition:
    """A pattern over the events of one key."""

    name: str
    pattern_type: str
    event_types: tuple[str, ...] = ()
    time_window_seconds: float = 0.0
    key_field: str = "user_id"
    min_occurrences: int = 1
    threshold_field: str = ""
    threshold_value: float = 0.0
    description: str = ""

    def __post_init__(self) -> None:
        if self.pattern_type not in SEVERITY:
            raise ValueError(f"unknown pattern type: {self.pattern_type}")
        object.__setattr__(self, "event_types", tuple(self.event_types))

    @property
    def window_micros(self) -> int:
        return C.micros(self.time_window_seconds)

    @property
    def severity(self) -> str:
        return SEVERITY.get(self.pattern_type, "INFO")

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> PatternDefinition:
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in values.items() if k in known})


def event_struct(us: Column, event_id: Column, event_type: Column) -> Column:
    """An entry of ``matched_events``."""
    return F.struct(
        event_id.cast("string").alias("event_id"), event_type.alias("event_type"), F.timestamp_micros(us).alias("ts")
    )


def as_alerts(matches: DataFrame, patterns: Sequence[PatternDefinition]) -> DataFrame:
    """Alerts from (entity_id, __no, __match_us, matched_events, metadata), ``__no`` a place in ``patterns`` (CEP-6..8).

    The id is derived from the content, so a replay gives the same ids (D-8).
    """
    if not patterns:
        raise ValueError("no patterns")
    facts = {
        "name": [p.name for p in patterns], "type": [p.pattern_type for p in patterns], "severity": [p.severity for p in patterns],
        "label": [p.description or p.pattern_type for p in patterns],
    }
    named = matches.withColumns({f"__{k}": F.lit(v)[F.col("__no")] for k, v in facts.items()})
    # Written as SQL text: each piece of an expression built in Python is a call to the JVM.
    times, ids = "transform(matched_events, e -> unix_micros(e.ts))", "concat_ws(',', transform(matched_events, e -> e.event_id))"
    return named.selectExpr(
        f"sha2(concat_ws('|', __name, entity_id, cast(__match_us AS string), {ids}), 256) AS alert_id",
        "__name AS pattern_name", "__type AS pattern_type", "__severity AS severity", "entity_id",
        "concat('Pattern \\'', __name, '\\' detected for entity \\'', entity_id, '\\': ', __label) AS message",
        "timestamp_micros(__match_us) AS match_ts", "matched_events", "cast(size(matched_events) AS bigint) AS event_count",
        f"CASE WHEN size(matched_events) < 2 THEN 0D ELSE (array_max({times}) - array_min({times})) / {C.MICROS}D END AS time_span_seconds",
        "1D AS confidence", "metadata",
    )


def _meta(**values: Column) -> Column:
    if not values:
        return F.create_map().cast("map<string,string>")
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v.cast("string"))])


def _match(no: int, us: Column, events: Sequence[Column], **meta: Column) -> Column:
    """One match of the pattern at place ``no``."""
    return F.struct(
        F.lit(no).alias("__no"), us.alias("__match_us"), F.array(*events).alias("matched_events"), _meta(**meta).alias("metadata")
    )


@dataclass
class _Scan:
    """The ordered scan of one key for all its patterns (CEP-9).

    Every pattern asks for running values per key in (ts, arrival) order; those of one step are added together, so the
    rows are moved and sorted once (and once more in the other direction if there are absences). A match is decided at
    one row from its running values.
    """

    rows: DataFrame
    piece: str | None

    def add(self, values: Mapping[str, Running], reverse: bool = False) -> None:
        if values:
            self.rows = running(self.rows, ["entity_id"], ORDER, self.piece, values, reverse=reverse)

    def sequences(self, patterns: Mapping[int, PatternDefinition]) -> dict[int, Column]:
        """Types in order within the window of the first; other events between them do not matter (CEP-1).

        Every event of the first type restarts the search, so the events of a key fall into segments that begin with
        one. In a segment, each step completes at the first event of its type after the step before.
        """
        here, kind = F.struct("__us", "seq", "event_id"), F.col("event_type")
        start = {i: F.col(f"__start{i}") for i in patterns}
        self.add({f"__start{i}": Running("last", F.when(kind == p.event_types[0], here)) for i, p in patterns.items()})
        done: dict[int, list[Column]] = {i: [] for i in patterns}
        found: dict[int, Column] = {}
        for k in range(1, max((len(p.event_types) for p in patterns.values()), default=0)):
            able = {}
            for i, p in patterns.items():
                if k < len(p.event_types):
                    able[i] = (kind == p.event_types[k]) & start[i].isNotNull()
                    if done[i]:
                        able[i] = able[i] & (done[i][-1] > start[i])
            # The first able event of a segment is the one before which there is none since the segment's start.
            self.add({f"__able{i}": Running("last", F.when(a, here), inclusive=False) for i, a in able.items()})
            first = {i: a & ~F.coalesce(F.col(f"__able{i}") > start[i], F.lit(False)) for i, a in able.items()}
            last = {i for i in able if k == len(patterns[i].event_types) - 1}
            for i in last:
                steps = zip([start[i], *done[i], here], patterns[i].event_types)
                events = [event_struct(s["__us"], s["event_id"], F.lit(t)) for s, t in steps]
                in_time = F.col("__us") - start[i]["__us"] <= F.lit(patterns[i].window_micros)
                found[i] = F.when(first[i] & in_time, _match(i, F.col("__us"), events))
            self.add({f"__done{i}_{k}": Running("last", F.when(first[i], here), inclusive=False) for i in able if i not in last})
            for i in able.keys() - last:
                done[i].append(F.col(f"__done{i}_{k}"))
            # The columns of this step are used up, except where a match is still to be read from them.
            self.rows = self.rows.withColumns({f"__match{i}": found[i] for i in last}).drop(*[f"__able{i}" for i in able])
            found |= {i: F.col(f"__match{i}") for i in last}
        return found

    def absences(self, patterns: Mapping[int, PatternDefinition], watermark: Column | None) -> dict[int, Column]:
        """A trigger that is neither repeated nor completed within the window (CEP-2, D-7).

        The next trigger or completing event of the key decides. The alert belongs to the instant the window ends; with
        a watermark only alerts due by then are returned.
        """
        kind, found = F.col("event_type"), {}
        ends = {i: (p.event_types[0], p.event_types[-1]) for i, p in patterns.items()}
        self.add({f"__next{i}": Running("last", F.when(kind.isin(*e), F.col("__us")), inclusive=False) for i, e in ends.items()}, reverse=True)
        for i, p in patterns.items():
            after, due = F.col(f"__next{i}"), F.col("__us") + F.lit(p.window_micros)
            missed = (kind == p.event_types[0]) & (after.isNull() | (after > due))
            if watermark is not None:
                missed = missed & (due <= F.unix_micros(watermark))
            event = event_struct(F.col("__us"), F.col("event_id"), kind)
            found[i] = F.when(missed, _match(i, due, [event], absence_type=F.lit(p.event_types[-1])))
        return found

    def numbers(self, patterns: Mapping[int, PatternDefinition]) -> None:
        """``__rn{i}``: the number of a row among the rows of its pattern, else null."""
        counts = {f"__rn{i}": Running("sum", F.when(F.col("event_type").isin(*p.event_types), F.lit(1).cast("bigint"))) for i, p in patterns.items()}
        self.add(counts)
        own = {f"__rn{i}": F.when(F.col("event_type").isin(*p.event_types), F.col(f"__rn{i}")) for i, p in patterns.items()}
        self.rows = self.rows.withColumns(own)

    def closing(self, patterns: Mapping[int, PatternDefinition]) -> None:
        """``__closes{i}``: whether at least n rows of the pattern are in the window that ends at this row (no slices)."""
        by_time = Window.partitionBy("entity_id").orderBy("__us")
        out = {}
        for i, p in patterns.items():
            older = by_time.rangeBetween(Window.unboundedPreceding, -(p.window_micros + 1))
            out[f"__closes{i}"] = F.col(f"__rn{i}") - F.coalesce(F.count(f"__rn{i}").over(older), F.lit(0)) >= p.min_occurrences
        self.rows = self.rows.select("*", *[c.alias(n) for n, c in out.items()])


def _frequencies(rows: DataFrame, patterns: Mapping[int, PatternDefinition], sliced: bool, row_limit: int | None) -> DataFrame:
    """At least n events within the window, without overlap between matches (CEP-3), of numbered rows.

    An event closes a possible match when the event n - 1 places earlier is inside the window. Matches take the first
    such event, then the first at least n places further on. Row numbers are scaled so that n places are the same
    distance in every pattern, and all patterns are followed together.
    """
    span = lcm(*[p.min_occurrences for p in patterns.values()])
    scale = {i: span // p.min_occurrences for i, p in patterns.items()}
    point = lambda i: F.struct(F.lit(i).alias("__no"), (F.col(f"__rn{i}") * scale[i]).alias("__x"))
    if sliced:
        parts = []
        for i, p in patterns.items():
            mine = rows.filter(F.col(f"__rn{i}").isNotNull()).select("entity_id", *ORDER, f"__rn{i}")
            back = lag_rows(mine, ["entity_id"], ORDER, f"__rn{i}", "__us", p.min_occurrences - 1, "__since", True, row_limit)
            parts.append(back.filter(F.col("__us") - F.col("__since") <= F.lit(p.window_micros)).select("entity_id", F.inline(F.array(point(i)))))
        points = reduce(DataFrame.unionByName, parts)
    else:
        hits = F.array_compact(F.array(*[F.when(F.col(f"__closes{i}"), point(i)) for i in patterns]))
        points = rows.select("entity_id", F.inline(hits))
    chosen = greedy_chain(points, ["entity_id", "__no"], "__x", span, row_limit, bounded=not sliced, cheap=True)
    # n rows are read back for every match, by their numbers.
    n = F.element_at(F.create_map(*[x for i, p in patterns.items() for x in (F.lit(i), F.lit(p.min_occurrences))]), F.col("__no"))
    per = F.element_at(F.create_map(*[x for i in patterns for x in (F.lit(i), F.lit(scale[i]).cast("bigint"))]), F.col("__no"))
    chosen = chosen.select("entity_id", "__no", F.call_function("div", "__x", per).alias("__close"), n.alias("__n"))
    members = chosen.select("entity_id", "__no", "__close", F.explode(F.sequence(F.col("__close") - (F.col("__n") - 1), "__close")).alias("__rn"))
    owned = F.array_compact(F.array(*[F.when(F.col(f"__rn{i}").isNotNull(), F.struct(F.lit(i).alias("__no"), F.col(f"__rn{i}").alias("__rn"))) for i in patterns]))
    numbered = rows.select("entity_id", "__us", "event_id", "event_type", F.inline(owned))
    taken = join_on(members, numbered, ["entity_id", "__no", "__rn"], "inner")
    # Exactly n rows per group.
    found = taken.groupBy("entity_id", "__no", "__close").agg(
        F.max("__us").alias("__match_us"),
        F.array_sort(F.collect_list(F.struct("__rn", "__us", "event_id", "event_type"))).alias("__rows"),
    )
    return found.select(
        "entity_id", "__no", "__match_us",
        F.transform("__rows", lambda r: event_struct(r["__us"], r["event_id"], r["event_type"])).alias("matched_events"),
        _meta(count=F.size("__rows")).alias("metadata"),
    )


def _usable(p: PatternDefinition) -> bool:
    """Whether a definition can match at all."""
    if p.pattern_type == "sequence":
        return len(p.event_types) > 1 and p.event_types[0] not in p.event_types[1:]
    if p.pattern_type == "absence":
        return len(p.event_types) > 1
    return p.pattern_type == "threshold" or bool(p.event_types)


def _matches(
    events: DataFrame, key_field: str, patterns: Mapping[int, PatternDefinition], watermark: Column | None, row_limit: int | None
) -> DataFrame:
    """Matches of all patterns that share a key: ``entity_id, __no, __match_us, matched_events, metadata``."""
    of = lambda kind: {i: p for i, p in patterns.items() if p.pattern_type == kind}
    levels, sequences, absences = of("threshold"), of("sequence"), of("absence")
    repeats = {i: replace(p, min_occurrences=max(p.min_occurrences, 1)) for i, p in of("frequency").items()}
    measured = {}
    for i, p in levels.items():
        v = C.number_prop(events, p.threshold_field) if p.threshold_field else F.lit(None).cast("double")
        over = v >= F.lit(float(p.threshold_value))
        measured[i] = F.when(over & F.col("event_type").isin(*p.event_types) if p.event_types else over, v)
    types = {t for p in (*sequences.values(), *repeats.values()) for t in p.event_types}
    types |= {t for p in absences.values() for t in (p.event_types[0], p.event_types[-1])}
    known = events.filter(F.col("ts").isNotNull())
    if all(p.event_types for p in levels.values()):  # types only: this filter reaches the scan
        known = known.filter(F.col("event_type").isin(*sorted(types | {t for p in levels.values() for t in p.event_types})))
    needed = reduce(Column.__or__, [m.isNotNull() for m in measured.values()], F.col("event_type").isin(*sorted(types)))
    rows = known.filter(needed).select(
        C.entity(events, key_field).alias("entity_id"), F.col("event_id").cast("string").alias("event_id"), "event_type",
        F.unix_micros("ts").alias("__us"), C.arrival(events).alias("seq"), *[m.alias(f"__v{i}") for i, m in measured.items()],
    )
    # Levels are decided at their own row; without other patterns nothing has to be ordered.
    cut, piece = with_slices(rows, ["entity_id"], "__us", row_limit, bounded=not types)
    scan = _Scan(cut, piece)
    event = event_struct(F.col("__us"), F.col("event_id"), F.col("event_type"))
    found: dict[int, Column] = {}
    for i, p in levels.items():
        meta = {"value": F.col(f"__v{i}"), "threshold": F.lit(float(p.threshold_value)), "field": F.lit(p.threshold_field)}
        found[i] = F.when(F.col(f"__v{i}").isNotNull(), _match(i, F.col("__us"), [event], **meta))
    scan.numbers(repeats)
    single = {i: p for i, p in repeats.items() if p.min_occurrences == 1}
    for i in single:
        found[i] = F.when(F.col(f"__rn{i}").isNotNull(), _match(i, F.col("__us"), [event], count=F.lit(1)))
    repeats = {i: p for i, p in repeats.items() if i not in single}
    if repeats and piece is None:
        scan.closing(repeats)
    found |= scan.sequences(sequences)
    found |= scan.absences(absences, watermark)
    hits = F.array_compact(F.array(*found.values())) if found else None
    keep = [c for i in repeats for c in (f"__rn{i}", *([f"__closes{i}"] if piece is None else []))]
    out = scan.rows.select("entity_id", *ORDER, "event_id", "event_type", *keep, *([hits.alias("__hits")] if found else []))
    if not repeats:
        return out.select("entity_id", F.inline("__hits"))
    of_any = reduce(Column.__or__, [F.col(f"__rn{i}").isNotNull() for i in repeats])
    out = runtime.pin(out.filter(of_any | (F.size("__hits") > 0) if found else of_any))
    # Patterns whose numbers have a small common multiple are followed together.
    together: list[dict[int, PatternDefinition]] = []
    for i, p in repeats.items():
        group = next((g for g in together if lcm(p.min_occurrences, *[x.min_occurrences for x in g.values()]) <= COMMON_MULTIPLE), None)
        if group is None:
            together.append(group := {})
        group[i] = p
    repeated = reduce(DataFrame.unionByName, [_frequencies(out, g, piece is not None, row_limit) for g in together])
    return out.select("entity_id", F.inline("__hits")).unionByName(repeated) if found else repeated


@dataclass(frozen=True)
class PatternSet(Mapping[str, PatternDefinition]):
    """An immutable collection of patterns; those that share a key are found in one pass (CEP-9)."""

    definitions: tuple[PatternDefinition, ...] = ()

    def __post_init__(self) -> None:
        object.__setattr__(self, "definitions", tuple({d.name: d for d in self.definitions}.values()))

    def __getitem__(self, name: str) -> PatternDefinition:
        for d in self.definitions:
            if d.name == name:
                return d
        raise KeyError(name)

    def __iter__(self) -> Iterator[str]:
        return (d.name for d in self.definitions)

    def __len__(self) -> int:
        return len(self.definitions)

    def having(self, *definitions: PatternDefinition) -> PatternSet:
        return replace(self, definitions=self.definitions + definitions)

    def without(self, *names: str) -> PatternSet:
        return replace(self, definitions=tuple(d for d in self.definitions if d.name not in names))

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> PatternSet:
        return cls(tuple(PatternDefinition.from_dict(p) for p in config.get("cep_patterns", ())))

    def detect(
        self, events: DataFrame, watermark: datetime | Column | None = None, row_limit: int | None = None
    ) -> DataFrame:
        """Alerts of all patterns; every pattern sees all events."""
        if not self.definitions:
            raise ValueError("the pattern set is empty")
        wm = watermark if watermark is None or isinstance(watermark, Column) else F.lit(watermark)
        usable = {i: p for i, p in enumerate(self.definitions) if _usable(p)}
        parts = []
        for key in dict.fromkeys(p.key_field for p in usable.values()):
            parts.append(_matches(events, key, {i: p for i, p in usable.items() if p.key_field == key}, wm, row_limit))
        if not parts:
            nothing = _match(0, F.unix_micros("ts"), [event_struct(F.unix_micros("ts"), F.col("event_id"), F.col("event_type"))])
            parts = [events.filter(F.lit(False)).select(C.entity(events).alias("entity_id"), F.inline(F.array(nothing)))]
        return as_alerts(reduce(DataFrame.unionByName, parts), self.definitions)


def detect(
    events: DataFrame, p: PatternDefinition, watermark: datetime | Column | None = None, row_limit: int | None = None
) -> DataFrame:
    """Alerts of one pattern."""
    return PatternSet((p,)).detect(events, watermark, row_limit)


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Number of alerts per pattern and severity (CEP-11)."""
    return alerts.groupBy("pattern_name", "severity").agg(F.count(F.lit(1)).alias("alerts"))
