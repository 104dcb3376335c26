"""Declarative windowed features, batch (PIPE-1..13).

A ``FeatureSet`` is compiled into one aggregation per distinct (key, window) specification: features that share it are
conditional aggregates of a single ``groupBy``, so the number of shuffles follows the number of window
specifications, not the number of features.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field, fields, replace
from datetime import datetime
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.functions import aggregates as A
from tidemark.functions import columns as C
from tidemark.functions import windows as W
from tidemark.operators.joins import join_on
from tidemark.operators.percentiles import ranked_percentile
from tidemark.operators.sessions import cell, long_sessions, session_cells, session_facts, sessionize, split_long
from tidemark.operators.slices import hot_groups

OUTPUT = ("entity_id", "feature_name", "feature_value", "window_start", "window_end", "event_count")

# Alternative spellings accepted in configuration files (D-11).
ALIASES = {"value_field": "source_field", "window_slide_seconds": "slide_seconds"}


@dataclass(frozen=True)
class FeatureDefinition:
    """What to compute, over which windows, from which field, per which key."""

    name: str
    aggregation: str
    window_type: str
    window_size_seconds: float = 0.0
    source_field: str = "_count"
    key_field: str = "user_id"
    filter_event_type: str | None = None
    slide_seconds: float | None = None
    session_gap_seconds: float | None = None
    allowed_lateness_seconds: float = 30.0
    default_value: float = 0.0
    description: str = ""
    percentile_value: float = 95.0
    offset_seconds: float = 0.0
    max_session_seconds: float | None = W.DEFAULT_MAX_SESSION
    session_rule: str = "gap"
    approx: bool = False
    distinct_field: str = "product_id"
    source_topic: str | None = None
    output_type: str = "float64"
    tags: tuple[str, ...] = ()
    ttl_seconds: int | None = None

    def __post_init__(self) -> None:
        if self.aggregation not in A.AGGREGATIONS:
            raise ValueError(f"unknown aggregation: {self.aggregation}")
        if self.window_type not in ("tumbling", "sliding", "session"):
            raise ValueError(f"unknown window type: {self.window_type}")
        if self.window_type != "session" and self.window_size_seconds <= 0:
            raise ValueError("the window size must be positive")
        if self.window_type == "sliding" and self.slide > self.window_size_seconds:
            raise ValueError("slide must not exceed the window size")
        if not 0 <= self.percentile_value <= 100:
            raise ValueError("the percentile must be between 0 and 100")
        object.__setattr__(self, "tags", tuple(self.tags))

    @property
    def slide(self) -> float:
        """A quarter of the size unless given."""
        return self.slide_seconds or self.window_size_seconds / 4

    @property
    def session(self) -> W.SessionRule:
        gap = self.session_gap_seconds or W.DEFAULT_SESSION_GAP
        return W.SessionRule(gap, self.max_session_seconds, self.session_rule)

    @classmethod
    def from_dict(cls, values: Mapping[str, Any]) -> FeatureDefinition:
        known = {f.name for f in fields(cls)}
        renamed = {ALIASES.get(k, k): v for k, v in values.items()}
        unknown = set(renamed) - known
        if unknown:
            raise ValueError(f"unknown feature settings: {sorted(unknown)}")
        return cls(**renamed)

    def routed_value(self, events: DataFrame) -> Column:
        """The value of an event for this feature, null when it is not routed here (PIPE-3, PIPE-5)."""
        v = C.value(events, self.source_field, self.aggregation)
        if self.filter_event_type is None:
            return v
        return F.when(F.col("event_type") == self.filter_event_type, v)


@dataclass(frozen=True)
class _Spec:
    """Features that can share one aggregation."""

    key_field: str
    window: tuple
    features: tuple[FeatureDefinition, ...]

    @property
    def first(self) -> FeatureDefinition:
        return self.features[0]

    def only(self, features: Iterable[FeatureDefinition]) -> _Spec:
        return replace(self, features=tuple(features))


def _window_key(f: FeatureDefinition) -> tuple:
    if f.window_type == "tumbling":
        return ("tumbling", f.window_size_seconds, f.offset_seconds % f.window_size_seconds)
    if f.window_type == "sliding":
        return ("sliding", f.window_size_seconds, f.slide)
    # Sessions depend on which events take part.
    counted = f.aggregation == "distinct_count" or f.source_field in ("_count", "__count__")
    takes = "_count" if counted else (f.source_field, f.aggregation == "count")
    return ("session", f.session, f.filter_event_type, takes)


@dataclass(frozen=True)
class FeatureSet(Mapping[str, FeatureDefinition]):
    """An immutable collection of feature definitions with named groups (PIPE-1, PIPE-2, PIPE-12)."""

    definitions: tuple[FeatureDefinition, ...] = ()
    groups: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    settings: Mapping[str, Any] = field(default_factory=dict)

    def __post_init__(self) -> None:
        # The last definition under a name wins.
        object.__setattr__(self, "definitions", tuple({d.name: d for d in self.definitions}.values()))

    def __getitem__(self, name: str) -> FeatureDefinition:
        return next((d for d in self.definitions if d.name == name), None) or self._missing(name)

    @staticmethod
    def _missing(name: str) -> FeatureDefinition:
        raise KeyError(name)

    def __iter__(self) -> Iterator[str]:
        return (d.name for d in self.definitions)

    def __len__(self) -> int:
        return len(self.definitions)

    def having(self, *definitions: FeatureDefinition) -> FeatureSet:
        """A set with these definitions added or replaced."""
        return replace(self, definitions=self.definitions + definitions)

    def without(self, *names: str) -> FeatureSet:
        """A set without these features."""
        return replace(self, definitions=tuple(d for d in self.definitions if d.name not in names))

    def group(self, name: str) -> FeatureSet:
        """The features of a named group; names that are not defined are ignored."""
        wanted = set(self.groups[name])
        return replace(self, definitions=tuple(d for d in self.definitions if d.name in wanted))

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> FeatureSet:
        definitions = tuple(FeatureDefinition.from_dict(f) for f in config.get("features", ()))
        groups = {k: tuple(v) for k, v in (config.get("feature_groups") or {}).items()}
        rest = {k: v for k, v in config.items() if k not in ("features", "feature_groups")}
        return cls(definitions, groups, rest)

    @classmethod
    def from_yaml(cls, path: str) -> FeatureSet:
        """Load definitions and groups from a YAML file (PIPE-12)."""
        import yaml

        with open(path, encoding="utf-8") as f:
            return cls.from_dict(yaml.safe_load(f) or {})

    # --- computing -------------------------------------------------------------------------------------------

    def specs(self) -> list[_Spec]:
        """Definitions grouped by key and window: one aggregation each."""
        grouped: dict[tuple, list[FeatureDefinition]] = {}
        for f in self.definitions:
            grouped.setdefault((f.key_field, _window_key(f)), []).append(f)
        return [_Spec(k, w, tuple(fs)) for (k, w), fs in grouped.items()]

    def compute(
        self, events: DataFrame, watermark: datetime | Column | None = None, row_limit: int | None = None
    ) -> DataFrame:
        """Computed features in long form (PIPE-7, PIPE-8, PIPE-11).

        With a watermark only windows that end at or before it are returned; without one all windows are.
        """
        parts = [p for s in self.specs() for p in _compute_spec(events, s, row_limit)]
        if not parts:
            raise ValueError("the feature set is empty")
        out = reduce(DataFrame.unionByName, parts)
        if watermark is None:
            return out
        wm = watermark if isinstance(watermark, Column) else F.lit(watermark)
        return out.filter(W.is_ready(F.col("window_end"), wm))

    def routed(self, events: DataFrame) -> DataFrame:
        """Number of events routed to each feature, in one pass (PIPE-7)."""
        counts = events.agg(*[F.count(f.routed_value(events)).alias(f.name) for f in self.definitions])
        pairs = [F.struct(F.lit(f.name).alias("feature_name"), F.col(f"`{f.name}`").alias("routed")) for f in self.definitions]
        return counts.select(F.inline(F.array(*pairs)))

    def wide(self, computed: DataFrame, per_window: bool = True) -> DataFrame:
        """One column per feature, missing values replaced by the feature's default (PIPE-12)."""
        keys = ["entity_id", "window_start", "window_end"] if per_window else ["entity_id"]
        value = "feature_value" if per_window else F.max_by("feature_value", "window_end")
        names = [f.name for f in self.definitions]
        agg = F.max(value) if per_window else value
        pivoted = computed.groupBy(*keys).pivot("feature_name", names).agg(agg)
        filled = [
            F.coalesce(F.col(f"`{f.name}`"), F.lit(float(f.default_value))).alias(f.name) for f in self.definitions
        ]
        return pivoted.select(*keys, *filled)


# --- compiling one specification ---------------------------------------------------------------------------------


def _base_rows(events: DataFrame, spec: _Spec) -> DataFrame:
    """Only the rows and columns the features need: key, time, one value per feature, distinct keys, order."""
    cols = [C.entity(events, spec.key_field).alias("entity_id"), F.col("ts")]
    any_ordered = any(f.aggregation in ("first_value", "last_value") for f in spec.features)
    if any_ordered:
        cols.append(C.order_key(events).alias("__order"))
    for i, f in enumerate(spec.features):
        v = f.routed_value(events)
        cols.append(v.alias(f"v{i}"))
        if f.aggregation == "distinct_count":
            cols.append(F.when(v.isNotNull(), C.distinct_key(events, f.source_field, f.distinct_field)).alias(f"d{i}"))
    types = {f.filter_event_type for f in spec.features}
    wanted = events.filter(F.col("ts").isNotNull())
    if None not in types:
        wanted = wanted.filter(F.col("event_type").isin(*sorted(types)))
    return wanted.select(*cols).filter(reduce(Column.__or__, [F.col(f"v{i}").isNotNull() for i in range(len(spec.features))]))


def _order(rows: DataFrame) -> Column:
    return F.col("__order") if "__order" in rows.columns else F.lit(0)


def _long(agg: DataFrame, features: Sequence[FeatureDefinition], start: Column, end: Column) -> DataFrame:
    """Unpivot ``f{i}`` / ``n{i}`` columns; a feature without rows in a window gives no row (AGG-0)."""
    entries = [
        F.struct(
            F.lit(f.name).alias("feature_name"),
            F.col(f"f{i}").cast("double").alias("feature_value"),
            F.col(f"n{i}").cast("bigint").alias("event_count"),
        )
        for i, f in enumerate(features)
    ]
    return (
        agg.select("entity_id", start.alias("window_start"), end.alias("window_end"), F.inline(F.array(*entries)))
        .filter((F.col("event_count") > 0) & F.col("feature_value").isNotNull())
        .select(*OUTPUT)
    )


def _compute_spec(events: DataFrame, spec: _Spec, row_limit: int | None) -> list[DataFrame]:
    fused = [f for f in spec.features if f.approx or f.aggregation in A.DECOMPOSABLE]
    distinct = [f for f in spec.features if f.aggregation == "distinct_count" and not f.approx]
    percentile = [f for f in spec.features if f.aggregation == "percentile" and not f.approx]
    # A text order key would turn the whole aggregation into a sort, so it gets its own.
    ordered = [f for f in fused if f.aggregation in ("first_value", "last_value")]
    if ordered and len(ordered) < len(fused) and C.order_key_is_struct(events):
        fused_sets = [[f for f in fused if f not in ordered], ordered]
    else:
        fused_sets = [fused]
    out: list[DataFrame] = []
    for fs in fused_sets:
        if fs:
            out.append(_fused(events, spec.only(fs), row_limit))
    if distinct:
        out.append(_distinct(events, spec.only(distinct), row_limit))
    if percentile:
        out.append(_percentile(events, spec.only(percentile), row_limit))
    return out


def _windowed(rows: DataFrame, spec: _Spec, row_limit: int | None) -> tuple[DataFrame, list[str]]:
    """Rows with their windows: (rows, group columns). Sessions carry their start, the end follows from the last event."""
    kind = spec.window[0]
    if kind == "session":
        rule: W.SessionRule = spec.window[1]
        placed = sessionize(rows.withColumn("__us", F.unix_micros("ts")), ["entity_id"], "__us", rule, row_limit)
        return placed, ["entity_id", "session_start"]
    f = spec.first
    w = (
        W.tumbling(F.col("ts"), f.window_size_seconds, f.offset_seconds)
        if kind == "tumbling"
        else W.sliding(F.col("ts"), f.window_size_seconds, f.slide)
    )
    return rows.withColumn("__w", w), ["entity_id", "__w"]


def _bounds(spec: _Spec) -> tuple[Column, Column]:
    """Window start and end of an aggregated row."""
    if spec.window[0] == "session":
        end = spec.window[1].end(F.col("session_start"), F.col("__last"))
        return F.timestamp_micros("session_start"), F.timestamp_micros(end)
    return F.col("__w.start"), F.col("__w.end")


def _last(spec: _Spec) -> list[Column]:
    return [F.max("__us").alias("__last")] if spec.window[0] == "session" else []


def _from_rows(rows: DataFrame, spec: _Spec, group: Sequence[str]) -> DataFrame:
    """Conditional aggregates straight from rows."""
    cols = []
    for i, f in enumerate(spec.features):
        v = F.col(f"v{i}")
        d = F.col(f"d{i}") if f.aggregation == "distinct_count" else None
        cols.append(A.from_rows(f.aggregation, v, _order(rows), d, f.percentile_value, f.approx).alias(f"f{i}"))
        cols.append(F.count(v).alias(f"n{i}"))
    return rows.groupBy(*group).agg(*cols, *_last(spec))


def _merged(parts: DataFrame, spec: _Spec, group: Sequence[str], *extra: Column) -> DataFrame:
    means = [A.window_mean(f"f{i}", group) for i, f in enumerate(spec.features) if f.aggregation == "stddev"]
    if means:
        parts = parts.select("*", *means)
    cols = [c for i, f in enumerate(spec.features) for c in A.merge(f.aggregation, f"f{i}")]
    agg = parts.groupBy(*group).agg(*cols, *extra)
    return agg.withColumnsRenamed({f"f{i}_c": f"n{i}" for i in range(len(spec.features))})


def _partials(rows: DataFrame, spec: _Spec) -> list[Column]:
    return [
        c for i, f in enumerate(spec.features) for c in A.partial(f.aggregation, F.col(f"v{i}"), _order(rows), f"f{i}")
    ]


def _fused(events: DataFrame, spec: _Spec, row_limit: int | None) -> DataFrame:
    rows = _base_rows(events, spec)
    kind, mergeable = spec.window[0], all(f.aggregation in A.DECOMPOSABLE for f in spec.features)
    if kind == "session" and mergeable:
        return _fused_sessions(rows, spec, row_limit)
    f = spec.first
    if kind != "sliding" or not mergeable:
        placed, group = _windowed(rows, spec, row_limit)
        return _long(_from_rows(placed, spec, group), spec.features, *_bounds(spec))
    # Sliding windows: aggregate each event once into its pane, then merge panes into windows.
    panes = _paned(rows, spec).groupBy("entity_id", "__pane").agg(*_partials(rows, spec))
    panes = _windows_of_panes(panes, spec)
    return _long(_merged(panes, spec, ["entity_id", "__w"]), spec.features, *_bounds(spec))


def _fused_sessions(rows: DataFrame, spec: _Spec, row_limit: int | None) -> DataFrame:
    rule: W.SessionRule = spec.window[1]
    rows = rows.withColumn("__us", F.unix_micros("ts"))
    keys, group = ["entity_id"], ["entity_id", "__session"]
    cells = session_cells(rows, keys, "__us", rule, [*_partials(rows, spec), F.count(F.lit(1)).alias("__rows")], row_limit)
    sessions = _merged(cells, spec, group, F.max("__hi").alias("__last"), F.sum("__rows").alias("__rows"))
    if rule.max_micros is None:
        return _long(sessions.withColumnRenamed("__session", "session_start"), spec.features, *_bounds(spec))
    # One row per session, worked out once: results of the short sessions, facts, and which ones are too long.
    sessions = runtime.pin(sessions)
    facts = session_facts(sessions, rule, row_limit)
    short = sessions.filter(F.col("__last") - F.col("__session") <= F.lit(rule.max_micros)).withColumnRenamed("__session", "session_start")
    if not facts.any_long:
        return _long(short, spec.features, *_bounds(spec))
    # Only sessions over the length limit go back to their events.
    long = long_sessions(sessions, keys, rule)
    marked = join_on(cells, long, group, "left_semi").select("entity_id", "__cell", "__session")
    back = join_on(rows.withColumn("__cell", cell(F.col("__us"), rule)), marked, ["entity_id", "__cell"], "inner")
    parts = split_long(back.drop("__cell"), keys, "__us", rule, facts, row_limit)
    return _long(short, spec.features, *_bounds(spec)).unionByName(
        _long(_from_rows(parts, spec, ["entity_id", "session_start"]), spec.features, *_bounds(spec))
    )


def _feature_rows(rows: DataFrame, spec: _Spec, group: Sequence[str], payload: str) -> DataFrame:
    """One row per (event, feature it is routed to)."""
    entries = [
        F.struct(F.lit(f.name).alias("feature_name"), F.col(f"{payload}{i}").alias("__x"), F.col(f"v{i}").alias("__v"))
        for i, f in enumerate(spec.features)
    ]
    extra = ["__us"] if spec.window[0] == "session" else []
    return rows.select(*group, *extra, F.inline(F.array(*entries))).filter(F.col("__v").isNotNull())


def _distinct(events: DataFrame, spec: _Spec, row_limit: int | None) -> DataFrame:
    """Exact distinct counts of all features of the specification: duplicates are removed before counting."""
    if spec.window[0] == "sliding":
        unique, group = _pane_values(events, spec, "d")
    else:
        placed, group = _windowed(_base_rows(events, spec), spec, row_limit)
        long = _feature_rows(placed, spec, group, "d")
        unique = long.groupBy(*group, "feature_name", "__x").agg(F.count(F.lit(1)).alias("n"), *_last(spec))
    last = [F.max("__last").alias("__last")] if spec.window[0] == "session" else []
    agg = unique.groupBy(*group, "feature_name").agg(
        F.count(F.lit(1)).cast("double").alias("feature_value"), F.sum("n").alias("event_count"), *last
    )
    start, end = _bounds(spec)
    return agg.withColumn("window_start", start).withColumn("window_end", end).select(*OUTPUT)


def _paned(rows: DataFrame, spec: _Spec) -> DataFrame:
    f = spec.first
    return rows.withColumn("__pane", W.pane_start(F.col("ts"), f.window_size_seconds, f.slide))


def _windows_of_panes(panes: DataFrame, spec: _Spec) -> DataFrame:
    f = spec.first
    return panes.withColumn("__w", W.sliding(F.col("__pane"), f.window_size_seconds, f.slide))


def _pane_values(events: DataFrame, spec: _Spec, payload: str) -> tuple[DataFrame, list[str]]:
    """Each value of a feature once per sliding window, with its count ``n``; events are counted per pane first."""
    group = ["entity_id", "__w"]
    long = _feature_rows(_paned(_base_rows(events, spec), spec), spec, ["entity_id", "__pane"], payload)
    cells = long.groupBy("entity_id", "__pane", "feature_name", "__x").agg(F.count(F.lit(1)).alias("n"))
    return _windows_of_panes(cells, spec).groupBy(*group, "feature_name", "__x").agg(F.sum("n").alias("n")), group


def _sliding_percentile(events: DataFrame, spec: _Spec, row_limit: int | None) -> DataFrame:
    """Percentiles from counted values; windows with too many distinct ones are ranked in slices."""
    values, group = _pane_values(events, spec, "v")
    full = [*group, "feature_name"]
    hot = hot_groups(values, full, row_limit)
    usual = values if hot is None else join_on(values, hot.select(*full), full, "left_anti")
    wanted = sorted({f.percentile_value for f in spec.features})
    at = F.create_map(*[x for f in spec.features for x in (F.lit(f.name), F.lit(wanted.index(f.percentile_value)))])
    many = F.percentile("__x", F.array(*[F.lit(p / 100.0) for p in wanted]), F.col("n")).alias("__p")
    out = usual.groupBy(*full).agg(many, F.sum("n").alias("event_count"))
    out = out.select(*full, F.get("__p", at[F.col("feature_name")]).alias("feature_value"), "event_count")
    if hot is not None:
        big = join_on(values, hot.select(*full), full, "left_semi")
        for f in spec.features:
            ranked = ranked_percentile(big.filter(F.col("feature_name") == f.name), full, "__x", f.percentile_value, row_limit, times="n")
            out = out.unionByName(ranked.select(*full, F.col("value").alias("feature_value"), F.col("n").cast("bigint").alias("event_count")))
    start, end = _bounds(spec)
    return out.withColumn("window_start", start).withColumn("window_end", end).select(*OUTPUT)


def _percentile(events: DataFrame, spec: _Spec, row_limit: int | None) -> DataFrame:
    if spec.window[0] == "sliding":
        return _sliding_percentile(events, spec, row_limit)
    placed, group = _windowed(_base_rows(events, spec), spec, row_limit)
    hot = hot_groups(placed, group, row_limit)
    usual = placed if hot is None else join_on(placed, hot.select(*group), group, "left_anti")
    out = _long(_from_rows(usual, spec, group), spec.features, *_bounds(spec))
    if hot is None:
        return out
    big = join_on(placed, hot.select(*group), group, "left_semi")
    for i, f in enumerate(spec.features):
        ranked = ranked_percentile(big, group, f"v{i}", f.percentile_value, row_limit)
        if spec.window[0] == "session":
            last = big.filter(F.col(f"v{i}").isNotNull()).groupBy(*group).agg(*_last(spec))
            ranked = join_on(ranked, last, group)
        start, end = _bounds(spec)
        out = out.unionByName(
            ranked.select(
                "entity_id",
                F.lit(f.name).alias("feature_name"),
                F.col("value").alias("feature_value"),
                start.alias("window_start"),
                end.alias("window_end"),
                F.col("n").cast("bigint").alias("event_count"),
            )
        )
    return out


def summarize(computed: DataFrame) -> DataFrame:
    """Per feature: computations, entities, average and maximum (MET-8)."""
    return computed.groupBy("feature_name").agg(
        F.count(F.lit(1)).alias("computations"),
        F.count_distinct("entity_id").alias("entities"),
        F.avg("feature_value").alias("avg_value"),
        F.max("feature_value").alias("max_value"),
    )
