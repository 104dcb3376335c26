"""Pipeline metrics, quality checks, backfill and reconciliation (MET-1..9, DQ-1..4, BF-1, BF-2).

Metrics are queries over a table of samples ``(ts, kind, name, value)`` or over the events and features themselves.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.functions.columns import micros, shift
from tidemark.plans.features import FeatureSet

LATENCY_SAMPLES = 1000
BACKPRESSURE_SAMPLES = 100
PSI_BINS = 10


def _newest(df: DataFrame, n: int, time: str, tie: str, keys: Sequence[str] = ()) -> DataFrame:
    """The last n rows, per key if given; the limit works in every task before the shuffle."""
    order = [F.col(time).desc(), F.col(tie).desc()]
    if not keys:
        return df.orderBy(*order).limit(n)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= n).drop("__rank")


def latency_summary(
    samples: DataFrame, value: str = "value", time: str = "ts", tie: str = "ts", keys: Sequence[str] = (),
    samples_kept: int = LATENCY_SAMPLES,
) -> DataFrame:
    """Mean, median, p95, p99, min and max of the last samples, to 3 digits (MET-1).

    p95 and p99 are the maximum while there are fewer than 20 and 100 samples.
    """
    last = _newest(samples, samples_kept, time, tie, keys)
    v = F.col(value)
    # At most ``samples_kept`` values.
    ordered = F.array_sort(F.collect_list(v))
    agg = last.groupBy(*keys).agg(
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.percentile(v, 0.5).alias("median"),
        F.min(v).alias("min"), F.max(v).alias("max"), ordered.alias("o"),
    )

    def rank(p: float, at_least: int) -> Column:
        # Whole percent, so that the index is exact.
        index = F.floor(F.col("count") * F.lit(round(p * 100)) / F.lit(100)).cast("int") + 1
        return F.when(F.col("count") < at_least, F.col("max")).otherwise(
            F.try_element_at("o", F.least(index, F.col("count").cast("int")))
        )

    def tidy(c: Column) -> Column:
        return F.round(F.coalesce(c, F.lit(0.0)), 3)

    return agg.select(
        *keys, "count", tidy(F.col("mean")).alias("mean_ms"), tidy(F.col("median")).alias("median_ms"),
        tidy(rank(0.95, 20)).alias("p95_ms"), tidy(rank(0.99, 100)).alias("p99_ms"),
        tidy(F.col("min")).alias("min_ms"), tidy(F.col("max")).alias("max_ms"),
    )


def throughput(events: DataFrame, now: Column, window_seconds: float = 60.0, time: str = "ts") -> DataFrame:
    """Events in the last window and their rate since the oldest of them (MET-2)."""
    recent = events.filter((F.col(time) >= shift(now, -window_seconds)) & (F.col(time) <= now))
    agg = recent.agg(F.count(F.lit(1)).alias("count_in_window"), F.min(F.unix_micros(time)).alias("__first"))
    elapsed = (F.unix_micros(now) - F.col("__first")) / F.lit(1e6)
    rate = F.when(F.col("count_in_window") == 0, F.lit(0.0)).when(elapsed < 0.001, F.col("count_in_window").cast("double"))
    return agg.select("count_in_window", rate.otherwise(F.col("count_in_window") / elapsed).alias("rate"))


def throughput_by_interval(events: DataFrame, seconds: float = 60.0, time: str = "ts") -> DataFrame:
    """Events per interval and their rate (MET-2)."""
    w = F.window(time, f"{micros(seconds)} microseconds")
    out = events.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("events"))
    return out.select(F.col("w.start").alias("interval_start"), "events", (F.col("events") / F.lit(float(seconds))).alias("rate"))


def freshness(computed: DataFrame, now: Column, time: str = "computed_at") -> DataFrame:
    """Seconds since each feature was last computed, to 2 digits (MET-3)."""
    last = computed.groupBy("feature_name").agg(F.max(F.unix_micros(time)).alias("__last"))
    return last.select("feature_name", F.round((F.unix_micros(now) - F.col("__last")) / F.lit(1e6), 2).alias("freshness_s"))


def backpressure(
    samples: DataFrame, value: str = "value", time: str = "ts", tie: str = "ts", samples_kept: int = BACKPRESSURE_SAMPLES
) -> DataFrame:
    """Level from the mean of the last utilisations (MET-4)."""
    agg = _newest(samples, samples_kept, time, tie).agg(
        F.coalesce(F.avg(value), F.lit(0.0)).alias("a"), F.coalesce(F.max(value), F.lit(0.0)).alias("m"),
        F.count(F.lit(1)).alias("samples"),
    )
    a = F.col("a")
    level = F.when(a > 0.9, "critical").when(a > 0.7, "high").when(a > 0.5, "moderate").otherwise("none")
    return agg.select(
        level.alias("level"), F.round(a, 3).alias("avg_utilization"), F.round("m", 3).alias("max_utilization"), "samples"
    )


def errors(samples: DataFrame, is_error: Column, error_type: Column) -> DataFrame:
    """Errors by type (MET-5)."""
    return samples.filter(is_error).groupBy(error_type.alias("error_type")).agg(F.count(F.lit(1)).alias("errors"))


def error_rate(samples: DataFrame, is_error: Column, is_processed: Column) -> DataFrame:
    """Total errors and their rate per processed event, to 6 digits (MET-5)."""
    agg = samples.agg(F.count_if(is_error).alias("errors"), F.count_if(is_processed).alias("processed"))
    return agg.withColumn("error_rate", F.round(F.col("errors") / F.greatest("processed", F.lit(1)), 6))


def event_types(events: DataFrame) -> DataFrame:
    """Event types by frequency (MET-9)."""
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events")).orderBy(F.desc("events"), "event_type")


def window_stats(computed: DataFrame, watermark: Column) -> DataFrame:
    """Windows still open and windows fired at a watermark (MET-7, WIN-8)."""
    fired = F.col("window_end") <= watermark
    return computed.agg(F.count_if(~fired).alias("active"), F.count_if(fired).alias("triggered"))


def _counted(rows: DataFrame, name: Column, value: Column, out: str) -> DataFrame:
    """One row with a map; ``name`` has few values, such as types of errors or features."""
    groups = rows.groupBy(name.alias("k")).agg(value.alias("v")).filter(F.col("k").isNotNull())
    return groups.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(out))


def report(
    tagged: DataFrame, computed: DataFrame, now: Column, latency: str = "value", tie: str = "event_id", window_seconds: float = 60.0,
    kept: Column | None = None, is_error: Column | None = None, error_type: Column | None = None, utilization: Column | None = None,
    computed_at: str = "window_end", feature_latency: str | None = None, started: Column | None = None,
) -> DataFrame:
    """The whole report as one row (MET-6).

    ``tagged`` are events with lateness and ``computed`` the features; either is worked out once, reduced to what the
    report needs. The other arguments say what of an event is its processing latency, an error and its type, and a
    sample of the buffer's use (null: none), and when a feature was computed and how long that took.

    Counts of events (``filtered, processed, late, dropped``), rates of the last window (``throughput_eps``,
    ``throughput_fps``), ``features_computed``, ``freshness`` by feature, windows, ``errors``, ``errors_by_type``,
    ``error_rate``, level and use of the buffer, and latency of events and, with ``feature_latency``, of features.
    """
    none = F.lit(None)
    kept = F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))
    failed = F.lit(False) if is_error is None else F.coalesce(is_error, F.lit(False))
    rows = runtime.pin(tagged.select(
        "ts", F.col(tie).alias("tie"), F.col(latency).cast("double").alias("latency"), kept.alias("kept"), "is_late", "is_dropped", failed.alias("failed"),
        F.when(failed, F.lit("unknown") if error_type is None else F.coalesce(error_type, F.lit("unknown"))).alias("error_type"),
        (none if utilization is None else utilization).cast("double").alias("used"),
    ))
    done = runtime.pin(computed.select(
        "feature_name", "window_end", F.col(computed_at).alias("at"), (none if feature_latency is None else F.col(feature_latency)).cast("double").alias("took"),
    ))
    recent = lambda time: F.when(F.col(time).between(shift(now, -window_seconds), now), F.unix_micros(time))

    def rate(time: str) -> Column:
        n, elapsed = F.count(recent(time)), (F.unix_micros(now) - F.min(recent(time))) / F.lit(1e6)
        return F.when(n == 0, F.lit(0.0)).when(elapsed < 0.001, n.cast("double")).otherwise(n / elapsed)

    processed = F.count_if(F.col("kept") & ~F.col("is_dropped"))
    fired = F.col("window_end") <= now
    parts = [
        rows.agg(
            F.count_if(~F.col("kept")).alias("filtered"), processed.alias("processed"), F.count_if(F.col("kept") & F.col("is_late")).alias("late"),
            F.count_if(F.col("kept") & F.col("is_dropped")).alias("dropped"), F.count(recent("ts")).alias("count_in_window"), rate("ts").alias("throughput_eps"),
            F.count_if("failed").alias("errors"), F.round(F.count_if("failed") / F.greatest(processed, F.lit(1)), 6).alias("error_rate"),
        ),
        done.agg(
            F.count(F.lit(1)).alias("features_computed"), rate("at").alias("throughput_fps"),
            F.count_if(~fired).alias("windows_active"), F.count_if(fired).alias("windows_triggered"),
        ),
        _counted(rows, F.col("error_type"), F.count(F.lit(1)), "errors_by_type"),
        _counted(done, F.col("feature_name"), F.round((F.unix_micros(now) - F.max(F.unix_micros("at"))) / F.lit(1e6), 2), "freshness"),
        latency_summary(rows.filter(F.col("latency").isNotNull()), "latency", tie="tie").withColumnRenamed("count", "latency_samples"),
        backpressure(rows.filter(F.col("used").isNotNull()), "used", tie="tie").withColumnsRenamed({"level": "backpressure", "samples": "backpressure_samples"}),
    ]
    if feature_latency is not None:
        own = latency_summary(done.filter(F.col("took").isNotNull()), "took", time="at", tie="took")
        parts.append(own.select(*[F.col(c).alias(f"feature_{c}" if c != "count" else "feature_latency_samples") for c in own.columns]))
    # Every part is one row: put below each other, the value of a column is the one that is there.
    both = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)
    out = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in both.columns])
    return out if started is None else out.withColumn("uptime_seconds", F.round((F.unix_micros(now) - F.unix_micros(started)) / F.lit(1e6), 1))


def alert_limits(report_row: DataFrame, max_error_rate: float = 0.01, max_p99_ms: float = 100.0) -> DataFrame:
    """Limits on a report with ``error_rate`` and ``p99_ms`` (DQ-4)."""
    return report_row.select(
        "error_rate", "p99_ms", (F.col("error_rate") > max_error_rate).alias("error_rate_exceeded"),
        (F.col("p99_ms") > max_p99_ms).alias("p99_exceeded"),
    )


# --- quality ------------------------------------------------------------------------------------------------------


def null_ratio(computed: DataFrame, expected: DataFrame, names: Sequence[str], limit: float = 0.05) -> DataFrame:
    """Share of expected entities without a value, per feature (DQ-1)."""
    have = (
        computed.filter(F.col("feature_value").isNotNull() & F.col("feature_name").isin(*names))
        .select("entity_id", "feature_name").distinct()
        .join(expected.select("entity_id").distinct(), "entity_id", "left_semi")
        .groupBy("feature_name").agg(F.count(F.lit(1)).alias("present"))
    )
    total = expected.agg(F.count_distinct("entity_id").alias("expected"))
    every = total.select("expected", F.explode(F.array(*[F.lit(n) for n in names])).alias("feature_name"))
    out = every.join(have, "feature_name", "left").select(
        "feature_name", "expected", F.coalesce("present", F.lit(0)).alias("present")
    )
    ratio = 1 - F.col("present") / F.nullif("expected", F.lit(0))
    return out.withColumn("null_ratio", ratio).withColumn("exceeded", F.coalesce(ratio > limit, F.lit(False)))


def staleness(computed: DataFrame, now: Column, limit_seconds: float = 300.0, time: str = "computed_at") -> DataFrame:
    """Features not computed for longer than the limit (DQ-2)."""
    return freshness(computed, now, time).withColumn("stale", F.col("freshness_s") > limit_seconds)


def drift(
    values: DataFrame, names: Sequence[str] | None = None, value: str = "feature_value", time: str = "window_end",
    tie: str = "entity_id", key: str = "feature_name", window: int = 1000, threshold: float = 0.1,
) -> DataFrame:
    """Population stability index of the last values against those before, on deciles of the latter (DQ-3).

    Shares are smoothed by half a row per bin, so an empty bin is defined. All features, or the named ones, are read in
    one pass; a feature holds any number of values, and every task sends its last ``2 * window`` ones at most.
    """
    if names is not None:
        values = values.filter(F.col(key).isin(*names))
    w = Window.partitionBy(key).orderBy(F.col(time).desc(), F.col(tie).desc())
    ranked = values.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") <= 2 * window)
    ranked = ranked.select(key, F.col(value).alias("__v"), (F.col("__rank") <= window).alias("__now"))
    # Spark limits groups before the shuffle up to a size that is set by default to fewer rows.
    with runtime.settings(values.sparkSession, {"spark.sql.optimizer.windowGroupLimitThreshold": str(2 * window)}):
        ranked = runtime.pin(ranked)
    cuts = [i / PSI_BINS for i in range(1, PSI_BINS)]
    edges = ranked.filter(~F.col("__now")).groupBy(key).agg(F.percentile("__v", F.array(*[F.lit(c) for c in cuts])).alias("__e"))
    bins = ranked.join(edges, key).select(
        key, "__now", F.size(F.filter("__e", lambda e: e < F.col("__v"))).alias("__bin")
    )
    per_bin = [
        F.struct(
            F.count_if(F.col("__now") & (F.col("__bin") == b)).alias("a"),
            F.count_if(~F.col("__now") & (F.col("__bin") == b)).alias("b"),
        )
        for b in range(PSI_BINS)
    ]
    agg = bins.groupBy(key).agg(
        F.count_if("__now").alias("current"), F.count_if(~F.col("__now")).alias("baseline"), F.array(*per_bin).alias("__bins")
    )

    def share(n: Column, total: Column) -> Column:
        return (n + 0.5) / (total + 0.5 * PSI_BINS)

    def term(x: Column) -> Column:
        a, b = share(x["a"], F.col("current")), share(x["b"], F.col("baseline"))
        return (a - b) * F.ln(a / b)

    psi = F.aggregate(F.transform("__bins", term), F.lit(0.0), lambda acc, x: acc + x)
    return agg.select(key, "current", "baseline", psi.alias("psi")).withColumn("drifted", F.col("psi") > threshold)


# --- backfill -----------------------------------------------------------------------------------------------------

DEFAULT_LOOKBACK_DAYS = 90
MAX_LOOKBACK_DAYS = 365


def backfill(features: FeatureSet, events: DataFrame, until: datetime, lookback_days: int = DEFAULT_LOOKBACK_DAYS) -> DataFrame:
    """The windows and sessions that lie wholly in a past range [until - lookback, until), from all their events (BF-1).

    Windows of a fixed size have their events in the range. Where a session begins depends on the events before it, so
    session features read the events before the range too; a session is over when the range ends after its last gap.
    """
    if not 0 < lookback_days <= MAX_LOOKBACK_DAYS:
        raise ValueError(f"lookback must be between 1 and {MAX_LOOKBACK_DAYS} days")
    start, end = F.lit(until - timedelta(days=lookback_days)), F.lit(until)
    before = events.filter(F.col("ts") < end)
    parts = []
    for sessions in (False, True):
        own = tuple(f for f in features.definitions if (f.window_type == "session") == sessions)
        if own:
            made = FeatureSet(own).compute(before if sessions else before.filter(F.col("ts") >= start))
            over = F.col("window_end") < end if sessions else F.col("window_end") <= end
            parts.append(made.filter((F.col("window_start") >= start) & over))
    return reduce(DataFrame.unionByName, parts)


def reconcile(
    recomputed: DataFrame, stored: DataFrame, tolerance: float = 0.001, sample_rate: float = 0.01,
    keys: Sequence[str] = ("entity_id", "feature_name", "window_end"), value: str = "feature_value",
) -> DataFrame:
    """Recomputed against stored values for a sample of entities, chosen by a hash so both sides agree (BF-2)."""
    buckets = 1_000_000
    chosen = F.pmod(F.xxhash64("entity_id"), F.lit(buckets)) < F.lit(round(sample_rate * buckets))
    a = recomputed.filter(chosen).select(*keys, F.col(value).alias("recomputed"))
    b = stored.filter(chosen).select(*keys, F.col(value).alias("stored"))
    both = a.join(b, list(keys), "full_outer")
    status = (
        F.when(F.col("stored").isNull(), "missing_stored")
        .when(F.col("recomputed").isNull(), "missing_recomputed")
        .when(F.abs(F.col("recomputed") - F.col("stored")) <= tolerance, "match")
        .otherwise("mismatch")
    )
    return both.withColumn("status", status)


