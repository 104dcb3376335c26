"""Registered queries over the given tables, each with the SQL it must agree with.

Times are returned as epoch microseconds and doubles are rounded to 6 digits, so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.functions import windows as W
from tidemark.functions.columns import number_prop, prop_or
from tidemark.operators import lateness, rows
from tidemark.plans import dual, monitor, store
from tidemark.plans.features import FeatureDefinition, FeatureSet, summarize
from tidemark.plans.patterns import PatternDefinition, PatternSet, alert_summary, detect
from tidemark.sources import wire
from tidemark.sources.events import map_columns, parse_json_records, to_json_records
from tidemark.streaming.features import current_windows, stream_all, update_windows
from tidemark.streaming.patterns import stream_pattern, stream_patterns
from tidemark.streaming.run import drain
from tidemark.streaming.sinks import FeatureStore, StoreSink, dedup_stream, start, write_batch
from tidemark.streaming.state import with_state

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

HOUR, DAY = 3600, 86_400
US = 1_000_000
NOW_US = 1_706_659_200 * US  # 2024-01-31 00:00 UTC, after the last event
MID_US = 1_705_320_000 * US  # 2024-01-15 12:00 UTC
MID = datetime.fromtimestamp(MID_US // US, timezone.utc)
AGGS = (
    "count", "sum", "avg", "min", "max", "distinct_count", "percentile", "stddev", "first_value", "last_value",
)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def moment(us: int) -> Column:
    return F.timestamp_micros(F.lit(us))


def us(name: str) -> Column:
    return F.unix_micros(name).alias(f"{name}_us")


def r6(c: Column | str) -> Column:
    return F.round(c, 6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    runtime.use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def as_events(raw: DataFrame) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return map_columns(
        raw, event_id="event_id", user_id="user_id", event_type="event_type", ts="ts", seq="event_id",
        properties={"value": F.col("value"), "k": k, "product_id": k},
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_events(table(spark, sf_dir, "events"))


EV = """ev AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS entity_id, event_type, value, epoch_us(ts) AS us,
         json_extract_string(props, '$.k') AS k
  FROM events)"""


# --- row operators -------------------------------------------------------------------------------------------------


@query("event_type_distribution", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def event_type_distribution(spark, d):
    return monitor.event_types(events(spark, d))


@query(
    "row_filter_map",
    f"""WITH {EV} SELECT event_id, entity_id, round(value * 1.2, 6) AS amount FROM ev
    WHERE event_type = 'purchase' AND value >= 20""",
)
def row_filter_map(spark, d):
    ev = events(spark, d)
    kept = rows.keep(ev, (F.col("event_type") == "purchase") & (number_prop(ev, "value") >= 20))
    out = rows.transform(kept, {"amount": r6(F.col("properties.value") * 1.2)})
    return out.select("event_id", F.col("user_id").alias("entity_id"), "amount")


@query(
    "row_flat_map",
    f"""WITH {EV} SELECT event_id, 'net' AS part, round(value * 0.8, 6) AS amount FROM ev
    UNION ALL SELECT event_id, 'tax', round(value * 0.2, 6) FROM ev WHERE value >= 50""",
)
def row_flat_map(spark, d):
    v = F.col("properties.value")
    net = F.struct(F.lit("net").alias("part"), (v * 0.8).alias("amount"))
    tax = F.struct(F.lit("tax").alias("part"), (v * 0.2).alias("amount"))
    out = rows.expand(events(spark, d), F.when(v >= 50, F.array(net, tax)).otherwise(F.array(net)))
    return out.select("event_id", "item.part", r6("item.amount").alias("amount"))


@query(
    "row_map_batches",
    f"WITH {EV} SELECT event_id, upper(event_type) AS event_type FROM ev WHERE value < 10",
)
def row_map_batches(spark, d):
    ev = events(spark, d).select("event_id", "event_type", F.col("properties.value").alias("value"))

    def shout(batch):
        kept = batch[batch["value"] < 10]
        return kept.assign(event_type=kept["event_type"].str.upper())[["event_id", "event_type"]]

    return rows.transform_batches(ev, shout, "event_id long, event_type string")


@query("key_by", f"WITH {EV} SELECT k AS entity_id, count(*) AS events, round(sum(value), 6) AS total FROM ev GROUP BY k")
def key_by(spark, d):
    ev = events(spark, d)
    keyed = rows.key_by(ev, prop_or(ev, "k", F.col("user_id")))
    return keyed.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("events"), r6(F.sum("properties.value")).alias("total")
    )


@query("event_json_roundtrip", f"WITH {EV} SELECT CAST(event_id AS VARCHAR) AS event_id, entity_id, event_type, us AS ts_us, k FROM ev")
def event_json_roundtrip(spark, d):
    back = parse_json_records(to_json_records(events(spark, d)))
    return back.select(
        "event_id", F.col("user_id").alias("entity_id"), "event_type", us("ts"), prop_or(back, "k", "").alias("k")
    )


# --- windows and aggregates ----------------------------------------------------------------------------------------


def tidy(computed: DataFrame) -> DataFrame:
    return computed.select(
        "entity_id", us("window_start"), us("window_end"), r6("feature_value").alias("feature_value"), "event_count"
    )


SQL_AGG = {
    "count": "CAST(count(*) AS DOUBLE)",
    "sum": "sum(value)",
    "avg": "avg(value)",
    "min": "min(value)",
    "max": "max(value)",
    "distinct_count": "CAST(count(DISTINCT k) AS DOUBLE)",
    "percentile": "quantile_cont(value, 0.95)",
    "stddev": "coalesce(stddev_samp(value), 0.0)",
    "first_value": "arg_min(value, (us, event_id))",
    "last_value": "arg_max(value, (us, event_id))",
}


def sql_windows(agg: str, size: int, slide: int | None = None, offset: int = 0) -> str:
    if slide is None:
        o, s = offset * US, size * US
        starts = f"SELECT *, us - (us - {o}) % {s} AS s FROM ev"
    else:
        w, g = size * US, slide * US
        starts = f"SELECT *, unnest(range(us - us % {g} - {w} + {g}, us + 1, {g})) AS s FROM ev"
    return f"""WITH {EV}, w AS ({starts})
    SELECT entity_id, s AS window_start_us, s + {size * US} AS window_end_us,
           round({SQL_AGG[agg]}, 6) AS feature_value, count(*) AS event_count
    FROM w GROUP BY entity_id, s"""


def feature(agg: str, window: str, **kw) -> FeatureDefinition:
    source = "_count" if agg in ("count", "distinct_count") else "value"
    return FeatureDefinition(f"{agg}_{window}", agg, window, source_field=source, **kw)


def _register_windows() -> None:
    def add(name: str, f: FeatureDefinition, sql: str) -> None:
        query(name, sql)(lambda spark, d: tidy(FeatureSet((f,)).compute(events(spark, d))))

    short = {"distinct_count": "distinct", "first_value": "first", "last_value": "last"}
    for a in AGGS:
        n = short.get(a, a)
        add(f"tumbling_{n}", feature(a, "tumbling", window_size_seconds=DAY), sql_windows(a, DAY))
        add(
            f"sliding_{n}", feature(a, "sliding", window_size_seconds=DAY, slide_seconds=6 * HOUR),
            sql_windows(a, DAY, 6 * HOUR),
        )
    add(
        "tumbling_offset", feature("sum", "tumbling", window_size_seconds=DAY, offset_seconds=6 * HOUR),
        sql_windows("sum", DAY, offset=6 * HOUR),
    )
    for agg in ("distinct_count", "percentile"):
        add(f"sliding_uneven_{agg}", feature(agg, "sliding", window_size_seconds=DAY, slide_seconds=7 * HOUR), sql_windows(agg, DAY, 7 * HOUR))
    add(
        "sliding_nondivisible", feature("sum", "sliding", window_size_seconds=DAY, slide_seconds=7 * HOUR),
        sql_windows("sum", DAY, 7 * HOUR),
    )


_register_windows()

GAP, CAP = 12 * HOUR, 48 * HOUR


def sql_sessions(agg: str, join_us: int) -> str:
    return f"""WITH {EV},
    a AS (SELECT *, us - lag(us) OVER (PARTITION BY entity_id ORDER BY us, event_id) AS silence FROM ev),
    b AS (SELECT *, sum(CASE WHEN silence IS NULL OR silence > {join_us} THEN 1 ELSE 0 END)
                 OVER (PARTITION BY entity_id ORDER BY us, event_id) AS sid FROM a)
    SELECT entity_id, min(us) AS window_start_us, max(us) + {GAP * US} AS window_end_us,
           round({SQL_AGG[agg]}, 6) AS feature_value, count(*) AS event_count
    FROM b GROUP BY entity_id, sid"""


SQL_CAPPED = f"""WITH RECURSIVE {EV},
    r AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY us, event_id) AS rn FROM ev),
    s AS (SELECT entity_id, rn, us, value, event_id, k, us AS start FROM r WHERE rn = 1
          UNION ALL
          SELECT r.entity_id, r.rn, r.us, r.value, r.event_id, r.k,
                 CASE WHEN r.us <= least(s.us + {GAP * US}, s.start + {CAP * US}) THEN s.start ELSE r.us END
          FROM s JOIN r ON r.entity_id = s.entity_id AND r.rn = s.rn + 1)
    SELECT entity_id, start AS window_start_us, least(max(us) + {GAP * US}, start + {CAP * US}) AS window_end_us,
           round(AGG, 6) AS feature_value, count(*) AS event_count
    FROM s GROUP BY entity_id, start"""


def _register_sessions() -> None:
    def add(name: str, f: FeatureDefinition, sql: str) -> None:
        query(name, sql)(lambda spark, d: tidy(FeatureSet((f,)).compute(events(spark, d))))

    base = {"session_gap_seconds": GAP, "max_session_seconds": None}
    for a, n in (
        ("count", "session_features"), ("sum", "session_sum"), ("stddev", "session_stddev"), ("last_value", "session_last"),
        ("distinct_count", "session_distinct"), ("percentile", "session_percentile"),
    ):
        add(n, feature(a, "session", **base), sql_sessions(a, GAP * US))
    add("session_double_gap", feature("count", "session", **base, session_rule="double_gap"), sql_sessions("count", 2 * GAP * US - 1))
    capped = {"session_gap_seconds": GAP, "max_session_seconds": CAP}
    add("session_capped", feature("count", "session", **capped), SQL_CAPPED.replace("AGG", SQL_AGG["count"]))
    add("session_capped_avg", feature("avg", "session", **capped), SQL_CAPPED.replace("AGG", "avg(value)"))
    add("session_capped_percentile", feature("percentile", "session", **capped), SQL_CAPPED.replace("AGG", SQL_AGG["percentile"]))
    # All events under one key, with a gap of 90 seconds: its cells are scanned in slices of a thousand at most.
    one = feature("avg", "session", session_gap_seconds=90, max_session_seconds=None)
    sql = sql_sessions("avg", 90 * US).replace("CAST(user_id AS VARCHAR) AS entity_id", "'all' AS entity_id").replace(str(GAP * US), str(90 * US))
    query("session_one_key", sql)(
        lambda spark, d: tidy(FeatureSet((one,)).compute(events(spark, d).withColumn("user_id", F.lit("all")), row_limit=1000))
    )


_register_sessions()

DAILY_SUM = FeatureSet((feature("sum", "tumbling", window_size_seconds=DAY),))
SQL_DAILY = sql_windows("sum", DAY)


@query("window_ready", f"SELECT * FROM ({SQL_DAILY}) WHERE window_end_us <= {MID_US}")
def window_ready(spark, d):
    return tidy(DAILY_SUM.compute(events(spark, d), moment(MID_US)))


@query("window_active", f"SELECT entity_id, count(*) AS active FROM ({SQL_DAILY}) WHERE window_end_us > {MID_US} GROUP BY entity_id")
def window_active(spark, d):
    computed = DAILY_SUM.compute(events(spark, d))
    open_ones = computed.filter(~W.is_ready(F.col("window_end"), moment(MID_US)))
    return open_ones.groupBy("entity_id").agg(F.count(F.lit(1)).alias("active"))


@query(
    "window_late_but_allowed",
    f"""SELECT entity_id, window_start_us FROM ({SQL_DAILY})
    WHERE window_end_us <= {MID_US} AND {MID_US} < window_end_us + {DAY * US}""",
)
def window_late_but_allowed(spark, d):
    computed = DAILY_SUM.compute(events(spark, d))
    return computed.filter(W.is_late_but_allowed(F.col("window_end"), moment(MID_US), DAY)).select(
        "entity_id", us("window_start")
    )


@query("window_expired", f"SELECT entity_id, count(*) FILTER (window_end_us >= {MID_US}) AS kept, count(*) FILTER (window_end_us < {MID_US}) AS expired FROM ({SQL_DAILY}) GROUP BY entity_id")
def window_expired(spark, d):
    old = W.is_expired(F.col("window_end"), moment(MID_US))
    return DAILY_SUM.compute(events(spark, d)).groupBy("entity_id").agg(F.count_if(~old).alias("kept"), F.count_if(old).alias("expired"))


@query("window_stats", f"SELECT count(*) FILTER (window_end_us > {MID_US}) AS active, count(*) FILTER (window_end_us <= {MID_US}) AS triggered FROM ({SQL_DAILY})")
def window_stats(spark, d):
    return monitor.window_stats(DAILY_SUM.compute(events(spark, d)), moment(MID_US))


# --- feature sets --------------------------------------------------------------------------------------------------

FLAGSHIP = FeatureSet(
    (
        FeatureDefinition("view_count_1d", "count", "tumbling", DAY, "_count", filter_event_type="view"),
        FeatureDefinition("signup_count_1d", "count", "tumbling", DAY, "_count", filter_event_type="signup"),
        FeatureDefinition("total_spend_1d", "sum", "tumbling", DAY, "value", filter_event_type="purchase"),
        FeatureDefinition("avg_spend_1d", "avg", "tumbling", DAY, "value", filter_event_type="purchase"),
        FeatureDefinition("click_count_1d", "count", "tumbling", DAY, "_count", filter_event_type="click"),
        FeatureDefinition("distinct_clicked_1d", "distinct_count", "tumbling", DAY, "_count", filter_event_type="click"),
        FeatureDefinition("max_error_value_1d", "max", "tumbling", DAY, "value", filter_event_type="error"),
        FeatureDefinition(
            "session_event_count", "count", "session", 0, "_count", session_gap_seconds=GAP, max_session_seconds=CAP
        ),
    ),
    groups={"engagement": ("view_count_1d", "click_count_1d", "signup_count_1d"), "spend": ("total_spend_1d", "avg_spend_1d")},
)


def _sql_flagship() -> str:
    def one(name: str, agg: str, kind: str) -> str:
        return f"""SELECT entity_id, '{name}' AS feature_name, us - us % {DAY * US} AS window_start_us,
        us - us % {DAY * US} + {DAY * US} AS window_end_us, round({SQL_AGG[agg]}, 6) AS feature_value,
        count(*) AS event_count FROM ev WHERE event_type = '{kind}' GROUP BY ALL"""

    parts = [
        one("view_count_1d", "count", "view"), one("signup_count_1d", "count", "signup"),
        one("total_spend_1d", "sum", "purchase"), one("avg_spend_1d", "avg", "purchase"),
        one("click_count_1d", "count", "click"), one("distinct_clicked_1d", "distinct_count", "click"),
        one("max_error_value_1d", "max", "error"),
    ]
    sessions = SQL_CAPPED.replace("AGG", SQL_AGG["count"])
    return f"""WITH {EV}, s AS ({sessions})
    {" UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)}
    UNION ALL SELECT entity_id, 'session_event_count', window_start_us, window_end_us, feature_value, event_count FROM s"""


SQL_FLAGSHIP = _sql_flagship()


@query("features_multi", SQL_FLAGSHIP)
def features_multi(spark, d):
    computed = FLAGSHIP.compute(events(spark, d))
    return computed.select(
        "entity_id", "feature_name", us("window_start"), us("window_end"), r6("feature_value").alias("feature_value"),
        "event_count",
    )


@query(
    "feature_group_wide",
    f"""SELECT entity_id, window_start_us, window_end_us,
    coalesce(max(feature_value) FILTER (feature_name = 'view_count_1d'), 0.0) AS view_count_1d,
    coalesce(max(feature_value) FILTER (feature_name = 'click_count_1d'), 0.0) AS click_count_1d,
    coalesce(max(feature_value) FILTER (feature_name = 'signup_count_1d'), 0.0) AS signup_count_1d
    FROM ({SQL_FLAGSHIP}) WHERE feature_name IN ('view_count_1d', 'click_count_1d', 'signup_count_1d')
    GROUP BY entity_id, window_start_us, window_end_us""",
)
def feature_group_wide(spark, d):
    group = FLAGSHIP.group("engagement")
    wide = group.wide(group.compute(events(spark, d)))
    return wide.select("entity_id", us("window_start"), us("window_end"), *group)


@query(
    "features_routed",
    """SELECT * FROM (SELECT 'view_count_1d' AS feature_name, count(*) FILTER (event_type = 'view') AS routed FROM events
    UNION ALL SELECT 'signup_count_1d', count(*) FILTER (event_type = 'signup') FROM events
    UNION ALL SELECT 'total_spend_1d', count(*) FILTER (event_type = 'purchase') FROM events
    UNION ALL SELECT 'avg_spend_1d', count(*) FILTER (event_type = 'purchase') FROM events
    UNION ALL SELECT 'click_count_1d', count(*) FILTER (event_type = 'click') FROM events
    UNION ALL SELECT 'distinct_clicked_1d', count(*) FILTER (event_type = 'click') FROM events
    UNION ALL SELECT 'max_error_value_1d', count(*) FILTER (event_type = 'error') FROM events
    UNION ALL SELECT 'session_event_count', count(*) FROM events)""",
)
def features_routed(spark, d):
    return FLAGSHIP.routed(events(spark, d))


@query(
    "feature_summary",
    f"""SELECT feature_name, count(*) AS computations, count(DISTINCT entity_id) AS entities,
    round(avg(feature_value), 6) AS avg_value, round(max(feature_value), 6) AS max_value
    FROM ({SQL_FLAGSHIP}) GROUP BY feature_name""",
)
def feature_summary(spark, d):
    s = summarize(FLAGSHIP.compute(events(spark, d)))
    return s.select("feature_name", "computations", "entities", r6("avg_value").alias("avg_value"), r6("max_value").alias("max_value"))


@query(
    "features_registered",
    f"""SELECT 'b' AS feature_name, * FROM ({sql_windows("max", DAY)}) UNION ALL SELECT 'c', * FROM ({sql_windows("count", DAY)})""",
)
def features_registered(spark, d):
    """Definitions are added, replaced by name and taken out again before anything is computed."""
    daily = lambda name, agg: FeatureDefinition(name, agg, "tumbling", DAY, "value")
    fs = FeatureSet((daily("a", "sum"), daily("b", "min"))).having(daily("c", "count"), daily("b", "max")).without("a")
    if (list(fs), fs["b"].aggregation) != (["b", "c"], "max"):
        raise AssertionError(list(fs))
    out = fs.compute(events(spark, d))
    return out.select("feature_name", *[F.col(c) for c in ("entity_id", "event_count")], us("window_start"), us("window_end"), r6("feature_value").alias("feature_value"))


@query(
    "features_keyed_by_property",
    f"""WITH {EV} SELECT k AS entity_id, us - us % {DAY * US} AS window_start_us, us - us % {DAY * US} + {DAY * US} AS window_end_us,
    round(sum(value), 6) AS feature_value, count(*) AS event_count FROM ev WHERE event_type = 'purchase' GROUP BY ALL""",
)
def features_keyed_by_property(spark, d):
    f = FeatureDefinition("spend_per_product", "sum", "tumbling", DAY, "value", key_field="k", filter_event_type="purchase")
    return tidy(FeatureSet((f,)).compute(events(spark, d)))


@query(
    "backfill_range",
    f"""WITH {EV}, w AS (SELECT entity_id, us - us % {DAY * US} AS window_start_us, us - us % {DAY * US} + {DAY * US} AS window_end_us,
      round(sum(value), 6) AS feature_value, count(*) AS event_count FROM ev GROUP BY ALL)
    SELECT * FROM w WHERE window_start_us >= {MID_US} - 7 * {DAY * US} AND window_end_us <= {MID_US}""",
)
def backfill_range(spark, d):
    return tidy(monitor.backfill(DAILY_SUM, events(spark, d), MID, 7))


@query(
    "backfill_sessions",
    f"""SELECT * FROM ({SQL_CAPPED.replace("AGG", SQL_AGG["sum"])})
    WHERE window_start_us >= {MID_US} - 7 * {DAY * US} AND window_end_us < {MID_US}""",
)
def backfill_sessions(spark, d):
    f = feature("sum", "session", session_gap_seconds=GAP, max_session_seconds=CAP)
    return tidy(monitor.backfill(FeatureSet((f,)), events(spark, d), MID, 7))


# --- lateness ------------------------------------------------------------------------------------------------------

SQL_LATE = f"""{EV}, q AS (SELECT *, event_id + 7 * CAST(event_id % 11 = 0 AS INT) AS seq FROM ev),
    wm AS (SELECT *, greatest(0, max(us) OVER (ORDER BY seq, event_id ROWS UNBOUNDED PRECEDING) - 900000000) AS wm FROM q)"""


def out_of_order(spark: SparkSession, d: str) -> DataFrame:
    """The table is in time order; here every eleventh event arrives seven places late."""
    ev = events(spark, d)
    return ev.withColumn("seq", F.col("event_id") + 7 * (F.col("event_id") % 11 == 0).cast("bigint"))


def tagged(spark: SparkSession, d: str) -> DataFrame:
    return lateness.tag_lateness(out_of_order(spark, d), 900, 1800)


@query(
    "lateness_tagging",
    f"""WITH {SQL_LATE} SELECT event_id, round(wm / 1e6, 6) AS watermark, us < wm AS is_late,
    round(greatest(wm - us, 0) / 1e6, 6) AS lateness_s, wm - us > 1800000000 AS is_dropped FROM wm""",
)
def lateness_tagging(spark, d):
    return tagged(spark, d).select(
        "event_id", r6("watermark").alias("watermark"), "is_late", r6("lateness_s").alias("lateness_s"), "is_dropped"
    )


@query("late_side_output", f"WITH {SQL_LATE} SELECT event_id, entity_id, us AS ts_us FROM wm WHERE wm - us > 1800000000")
def late_side_output(spark, d):
    return lateness.late_output(tagged(spark, d)).select("event_id", F.col("user_id").alias("entity_id"), us("ts"))


@query(
    "lateness_counts",
    f"""WITH {SQL_LATE} SELECT count(*) FILTER (event_type = 'error') AS filtered,
    count(*) FILTER (event_type <> 'error' AND wm - us <= 1800000000) AS processed,
    count(*) FILTER (event_type <> 'error' AND us < wm) AS late,
    count(*) FILTER (event_type <> 'error' AND wm - us > 1800000000) AS dropped FROM wm""",
)
def lateness_counts(spark, d):
    return lateness.lateness_counts(tagged(spark, d), F.col("event_type") != "error")


@query(
    "features_on_time",
    f"""WITH {SQL_LATE} SELECT entity_id, us - us % {DAY * US} AS window_start_us, us - us % {DAY * US} + {DAY * US} AS window_end_us,
    round(sum(value), 6) AS feature_value, count(*) AS event_count FROM wm WHERE wm - us <= 1800000000 GROUP BY ALL""",
)
def features_on_time(spark, d):
    return tidy(DAILY_SUM.compute(lateness.on_time(tagged(spark, d))))


@query("lateness_processing_time", "SELECT count(*) AS processed, 0::BIGINT AS late, 0::BIGINT AS dropped, count(*) AS without_watermark FROM events")
def lateness_processing_time(spark, d):
    t = lateness.tag_lateness(out_of_order(spark, d), 5, 30, event_time=False)
    counts = lateness.lateness_counts(t).select("processed", "late", "dropped")
    without = t.agg(F.count_if(F.col("watermark").isNull()).alias("without_watermark"))
    return counts.unionByName(without, allowMissingColumns=True).agg(*[F.first(c, ignorenulls=True).alias(c) for c in (*counts.columns, *without.columns)])


@query("watermark_lag", f"SELECT round((max(epoch_us(ts)) - 900000000) / 1e6, 6) AS watermark, round(({NOW_US} - max(epoch_us(ts)) + 900000000) / 1e6, 6) AS lag_s FROM events")
def watermark_lag(spark, d):
    out = lateness.watermark_lag(events(spark, d), moment(NOW_US), 900)
    return out.select(r6("watermark").alias("watermark"), r6("lag_s").alias("lag_s"))


# --- patterns ------------------------------------------------------------------------------------------------------

SEQUENCE = PatternDefinition("browse_to_purchase", "sequence", ("view", "click", "purchase"), 72 * HOUR)
ABSENCE = PatternDefinition("abandoned", "absence", ("click", "purchase"), 48 * HOUR)
FREQUENCY = PatternDefinition("rapid_clicks", "frequency", ("click",), 48 * HOUR, min_occurrences=3)
THRESHOLD = PatternDefinition(
    "high_value", "threshold", ("purchase",), 300, threshold_field="value", threshold_value=200.0, description="Purchase of 200 or more"
)
PATTERNS = PatternSet((SEQUENCE, ABSENCE, FREQUENCY, THRESHOLD))


def last_event(ev: DataFrame) -> Column:
    """The newest event time, as a literal: one value."""
    newest = ev.agg(F.max(F.unix_micros("ts"))).first()[0]
    return moment(newest) if newest is not None else F.lit(None).cast("timestamp")


SQL_SEQ = f"""WITH {EV},
    a AS (SELECT *, count(*) FILTER (event_type = 'view') OVER (PARTITION BY entity_id ORDER BY us, event_id) AS seg
          FROM ev WHERE event_type IN ('view', 'click', 'purchase')),
    v AS (SELECT entity_id, seg, us AS t0 FROM a WHERE event_type = 'view'),
    c AS (SELECT v.entity_id, v.seg, t0, min(a.us) AS t1 FROM v JOIN a USING (entity_id, seg)
          WHERE a.event_type = 'click' AND a.us <= t0 + {72 * HOUR * US} GROUP BY ALL),
    m AS (SELECT c.entity_id, c.seg, t0, t1, min(a.us) AS t2 FROM c JOIN a USING (entity_id, seg)
          WHERE a.event_type = 'purchase' AND a.us > t1 AND a.us <= t0 + {72 * HOUR * US} GROUP BY ALL)"""


def shown(alerts: DataFrame) -> DataFrame:
    ids = F.concat_ws(",", F.transform("matched_events", lambda e: e["event_id"]))
    return alerts.select(
        "pattern_name", "severity", "entity_id", us("match_ts"), "event_count",
        r6("time_span_seconds").alias("time_span_seconds"), "message", ids.alias("event_ids"), F.to_json("metadata").alias("metadata"),
    )


@query(
    "cep_sequence",
    SQL_SEQ + """ SELECT 'browse_to_purchase' AS pattern_name, 'LOW' AS severity, m.entity_id, t2 AS match_ts_us,
    3::BIGINT AS event_count, round((t2 - t0) / 1e6, 6) AS time_span_seconds,
    'Pattern ''browse_to_purchase'' detected for entity ''' || m.entity_id || ''': sequence' AS message,
    e0.event_id || ',' || e1.event_id || ',' || e2.event_id AS event_ids, '{}' AS metadata
    FROM m JOIN ev e0 ON e0.entity_id = m.entity_id AND e0.us = t0 JOIN ev e1 ON e1.entity_id = m.entity_id AND e1.us = t1
    JOIN ev e2 ON e2.entity_id = m.entity_id AND e2.us = t2""",
)
def cep_sequence(spark, d):
    return shown(detect(events(spark, d), SEQUENCE))


SQL_ABS = f"""WITH {EV},
    f AS (SELECT *, min(us) FILTER (event_type IN ('click', 'purchase')) OVER
            (PARTITION BY entity_id ORDER BY us, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt FROM ev),
    m AS (SELECT entity_id, event_id, us + {48 * HOUR * US} AS due FROM f
          WHERE event_type = 'click' AND (nxt IS NULL OR nxt > us + {48 * HOUR * US})
            AND us + {48 * HOUR * US} <= (SELECT max(us) FROM ev))"""


@query(
    "cep_absence",
    SQL_ABS + """ SELECT 'abandoned' AS pattern_name, 'MEDIUM' AS severity, entity_id, due AS match_ts_us, 1::BIGINT AS event_count,
    0.0::DOUBLE AS time_span_seconds, 'Pattern ''abandoned'' detected for entity ''' || entity_id || ''': absence' AS message,
    CAST(event_id AS VARCHAR) AS event_ids, '{"absence_type":"purchase"}' AS metadata FROM m""",
)
def cep_absence(spark, d):
    ev = events(spark, d)
    return shown(detect(ev, ABSENCE, last_event(ev)))


SQL_FREQ = f"""WITH RECURSIVE {EV},
    r AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY us, event_id) AS rn FROM ev WHERE event_type = 'click'),
    s AS (SELECT entity_id, rn, us, [(us, event_id)] AS kept, false AS hit FROM r WHERE rn = 1
          UNION ALL
          SELECT r.entity_id, r.rn, r.us,
                 list_append(list_filter(CASE WHEN s.hit THEN [] ELSE s.kept END, lambda x: x[1] >= r.us - {48 * HOUR * US}), (r.us, r.event_id)),
                 len(list_filter(CASE WHEN s.hit THEN [] ELSE s.kept END, lambda x: x[1] >= r.us - {48 * HOUR * US})) + 1 >= 3
          FROM s JOIN r ON r.entity_id = s.entity_id AND r.rn = s.rn + 1)"""


@query(
    "cep_frequency",
    SQL_FREQ + """ SELECT 'rapid_clicks' AS pattern_name, 'MEDIUM' AS severity, entity_id, us AS match_ts_us,
    len(kept)::BIGINT AS event_count, round((us - kept[1][1]) / 1e6, 6) AS time_span_seconds,
    'Pattern ''rapid_clicks'' detected for entity ''' || entity_id || ''': frequency' AS message,
    array_to_string(list_transform(kept, lambda x: x[2]), ',') AS event_ids,
    '{"count":"' || len(kept) || '"}' AS metadata FROM s WHERE hit""",
)
def cep_frequency(spark, d):
    return shown(detect(events(spark, d), FREQUENCY))


@query(
    "cep_threshold",
    f"""WITH {EV} SELECT 'high_value' AS pattern_name, 'HIGH' AS severity, entity_id, us AS match_ts_us, 1::BIGINT AS event_count,
    0.0::DOUBLE AS time_span_seconds,
    'Pattern ''high_value'' detected for entity ''' || entity_id || ''': Purchase of 200 or more' AS message,
    CAST(event_id AS VARCHAR) AS event_ids,
    '{{"value":"' || value || '","threshold":"200.0","field":"value"}}' AS metadata
    FROM ev WHERE event_type = 'purchase' AND value >= 200""",
)
def cep_threshold(spark, d):
    return shown(detect(events(spark, d), THRESHOLD))


@query(
    "alert_summary",
    f"""SELECT 'browse_to_purchase' AS pattern_name, 'LOW' AS severity, count(*) AS alerts FROM ({SQL_SEQ} SELECT * FROM m)
    UNION ALL SELECT 'abandoned', 'MEDIUM', count(*) FROM ({SQL_ABS} SELECT * FROM m)
    UNION ALL SELECT 'rapid_clicks', 'MEDIUM', count(*) FROM ({SQL_FREQ} SELECT * FROM s WHERE hit)
    UNION ALL SELECT 'high_value', 'HIGH', count(*) FROM events WHERE event_type = 'purchase' AND value >= 200""",
)
def alerts_by_pattern(spark, d):
    ev = events(spark, d)
    return alert_summary(PATTERNS.detect(ev, last_event(ev)))


SQL_FREQ_BY_K = SQL_FREQ.replace("CAST(user_id AS VARCHAR) AS entity_id", "coalesce(json_extract_string(props, '$.k'), CAST(user_id AS VARCHAR)) AS entity_id")


@query("cep_other_key", SQL_FREQ_BY_K + " SELECT entity_id, us AS match_ts_us, array_to_string(list_transform(kept, lambda x: x[2]), ',') AS event_ids FROM s WHERE hit")
def cep_other_key(spark, d):
    p = PatternDefinition("rapid_clicks", "frequency", ("click",), 48 * HOUR, min_occurrences=3, key_field="k")
    return shown(detect(events(spark, d), p)).select("entity_id", "match_ts_us", "event_ids")


# --- feature store -------------------------------------------------------------------------------------------------

WEEK = 7 * DAY
NAMES = ["click", "view", "purchase"]


def writes(spark: SparkSession, d: str) -> DataFrame:
    """Events as feature writes that arrive ``k`` minutes after the event; ``k`` hours to live below 50, else the default."""
    raw = table(spark, d, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    ts = F.col("ts").cast("timestamp")
    return raw.select(
        F.col("user_id").cast("string").alias("entity_id"),
        F.col("event_type").alias("feature_name"),
        "value",
        ts.alias("event_time"),
        F.timestamp_micros(F.unix_micros(ts) + k.cast("bigint") * 60_000_000).alias("ingestion_time"),
        F.col("event_id").alias("seq"),
        (1 + F.col("event_id") % 5).cast("int").alias("version"),
        F.when(k < 50, k * 3600).alias("ttl_seconds"),
    )


def history(spark: SparkSession, d: str) -> DataFrame:
    return store.records(writes(spark, d), default_ttl=WEEK)


def history_with_deletions(spark: SparkSession, d: str) -> DataFrame:
    """Costly errors delete the user's purchases; costly signups delete the user."""
    h = history(spark, d)
    w = writes(spark, d)
    features = w.filter((F.col("feature_name") == "error") & (F.col("value") > 120)).withColumn("feature_name", F.lit("purchase"))
    entities = w.filter((F.col("feature_name") == "signup") & (F.col("value") > 200)).drop("feature_name")
    return h.unionByName(store.tombstones(features)).unionByName(store.tombstones(entities))


SQL_HIST = f"""h AS (
  SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type AS feature_name, value, epoch_us(ts) AS et,
         epoch_us(ts) + k * 60000000 AS it, event_id AS seq, 1 + event_id % 5 AS version,
         CASE WHEN k > 0 AND k < 50 THEN k * 3600 ELSE {WEEK} END AS ttl,
         epoch_us(ts) + CASE WHEN k > 0 AND k < 50 THEN k * 3600 ELSE {WEEK} END * 1000000 AS ex
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events))"""
SQL_ONLINE = f"""{SQL_HIST}, o AS (
  SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY it DESC, seq DESC) = 1)"""
SQL_DEL = f"""{SQL_HIST},
  df AS (SELECT entity_id, max((it, seq)) AS x FROM h WHERE feature_name = 'error' AND value > 120 GROUP BY entity_id),
  de AS (SELECT entity_id, max((it, seq)) AS x FROM h WHERE feature_name = 'signup' AND value > 200 GROUP BY entity_id),
  alive AS (SELECT h.* FROM h LEFT JOIN de USING (entity_id) WHERE de.x IS NULL OR (h.it, h.seq) > de.x),
  od AS (SELECT a.* FROM (SELECT * FROM alive QUALIFY row_number() OVER
           (PARTITION BY entity_id, feature_name ORDER BY it DESC, seq DESC) = 1) a
         LEFT JOIN df ON df.entity_id = a.entity_id AND a.feature_name = 'purchase'
         WHERE df.x IS NULL OR (a.it, a.seq) > df.x)"""


def view(df: DataFrame) -> DataFrame:
    return df.select("entity_id", "feature_name", "value", us("event_time"), F.col("version").cast("bigint").alias("version"))


@query("store_online", f"WITH {SQL_ONLINE} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM o")
def store_online(spark, d):
    return view(store.online(history(spark, d)))


@query(
    "store_online_by_event_time",
    f"""WITH {SQL_HIST} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM h
    QUALIFY row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY et DESC, it DESC, seq DESC) = 1""",
)
def store_online_by_event_time(spark, d):
    return view(store.online(history(spark, d), by_event_time=True))


@query("store_ttl", f"WITH {SQL_ONLINE} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM o WHERE ex >= {NOW_US}")
def store_ttl(spark, d):
    return view(store.get_features(store.online(history(spark, d)), moment(NOW_US)))


@query("store_expired", f"WITH {SQL_ONLINE} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM o WHERE ex < {NOW_US}")
def store_expired(spark, d):
    return view(store.expired(store.online(history(spark, d)), moment(NOW_US)))


@query(
    "store_versions",
    f"""WITH {SQL_HIST} SELECT entity_id, feature_name, value, version, et AS event_time_us,
    row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY it DESC, seq DESC) AS version_rank FROM h QUALIFY version_rank <= 10""",
)
def store_versions(spark, d):
    v = store.versions(history(spark, d))
    return v.select(
        "entity_id", "feature_name", "value", F.col("version").cast("bigint").alias("version"), us("event_time"),
        F.col("version_rank").cast("bigint").alias("version_rank"),
    )


@query(
    "store_batch_get",
    f"""WITH {SQL_ONLINE}, c AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id FROM customer),
    v AS (SELECT * FROM o WHERE ex >= {NOW_US})
    SELECT c.entity_id, max(value) FILTER (feature_name = 'click') AS click, max(value) FILTER (feature_name = 'view') AS view,
    max(value) FILTER (feature_name = 'purchase') AS purchase FROM c LEFT JOIN v USING (entity_id) GROUP BY c.entity_id""",
)
def store_batch_get(spark, d):
    asked = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"))
    return store.batch_get(store.online(history(spark, d)), asked, NAMES, moment(NOW_US))


@query("store_delete", f"WITH {SQL_DEL} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM od")
def store_delete(spark, d):
    return view(store.online(history_with_deletions(spark, d)))


@query("store_lists", f"WITH {SQL_ONLINE} SELECT entity_id, feature_name FROM o WHERE ex >= {NOW_US}")
def store_lists(spark, d):
    return store.list_features(store.online(history(spark, d)), moment(NOW_US))


@query("store_entities", f"WITH {SQL_DEL} SELECT DISTINCT entity_id FROM od")
def store_entities(spark, d):
    return store.list_entities(store.online(history_with_deletions(spark, d)))


@query("store_counts", f"WITH {SQL_DEL} SELECT count(DISTINCT entity_id) AS entities, count(*) AS features FROM od")
def store_counts(spark, d):
    return store.counts(store.online(history_with_deletions(spark, d)))


def lookups(spark: SparkSession, d: str) -> DataFrame:
    """Every customer asks for three features; most customers are unknown to the store."""
    names = F.explode(F.array(*[F.lit(n) for n in NAMES]))
    return table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"), names.alias("feature_name"))


SQL_ASK = f"""ask AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id, unnest({NAMES}) AS feature_name FROM customer)"""


@query(
    "store_hit_rate",
    f"""WITH {SQL_ONLINE}, {SQL_ASK}, known AS (SELECT DISTINCT entity_id FROM o),
    x AS (SELECT ask.*, known.entity_id IS NOT NULL AS known, coalesce(o.ex >= {NOW_US}, false) AS hit
          FROM ask LEFT JOIN known USING (entity_id) LEFT JOIN o USING (entity_id, feature_name)),
    c AS (SELECT count(*) FILTER (known AND hit) AS hits,
                 count(*) FILTER (known AND NOT hit) + count(DISTINCT entity_id) FILTER (NOT known) AS misses FROM x)
    SELECT hits, misses, round(hits / (hits + misses), 4) AS hit_rate FROM c""",
)
def store_hit_rate(spark, d):
    return store.hit_rate(store.online(history(spark, d)), lookups(spark, d), moment(NOW_US))


@query(
    "store_point_in_time",
    f"""WITH {SQL_HIST},
    spine AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, event_id, epoch_us(ts) + 3600000000 AS t,
                     unnest(['click', 'view']) AS feature_name FROM events WHERE event_type = 'purchase'),
    p AS (SELECT * FROM h WHERE feature_name IN ('click', 'view'))
    SELECT s.entity_id, s.event_id, s.feature_name, p.value, p.et AS value_time_us
    FROM spine s ASOF LEFT JOIN p ON s.entity_id = p.entity_id AND s.feature_name = p.feature_name AND s.t >= p.et""",
)
def store_point_in_time(spark, d):
    buys = events(spark, d).filter(F.col("event_type") == "purchase")
    spine = buys.select(
        F.col("user_id").alias("entity_id"), "event_id", F.timestamp_micros(F.unix_micros("ts") + 3_600_000_000).alias("ts")
    )
    got = store.at_time(history(spark, d), spine, ["click", "view"])
    return got.select("entity_id", "event_id", "feature_name", "value", us("value_time"))


@query(
    "store_snapshot",
    f"""WITH {SQL_ONLINE} SELECT entity_id, count(*) AS features, round(sum(value), 6) AS total FROM o WHERE ex >= {NOW_US} GROUP BY entity_id""",
)
def store_snapshot(spark, d):
    nested = store.nested_snapshot(store.online(history(spark, d)), moment(NOW_US))
    values = F.transform(F.map_values("features"), lambda r: r["value"])
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return nested.select("entity_id", F.size("features").cast("bigint").alias("features"), r6(total).alias("total"))


@query(
    "store_log_lines",
    f"WITH {SQL_HIST} SELECT entity_id, feature_name, round(value, 6) AS value, round(et / 1e6, 6) AS timestamp, version FROM h",
)
def store_log_lines(spark, d):
    lines = store.log_lines(history(spark, d))
    got = lines.select(
        F.from_json("value", "entity_id string, feature_name string, value double, timestamp double, version long").alias("r")
    )
    return got.select("r.entity_id", "r.feature_name", r6("r.value").alias("value"), r6("r.timestamp").alias("timestamp"), "r.version")


@query(
    "offline_time_range",
    f"""WITH {SQL_HIST} SELECT entity_id, feature_name, value, et AS event_time_us,
    row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY et DESC) AS newest_rank FROM h
    WHERE et BETWEEN {MID_US - WEEK * US} AND {MID_US} QUALIFY newest_rank <= 3""",
)
def offline_time_range(spark, d):
    out = store.time_range(history(spark, d), moment(MID_US - WEEK * US), moment(MID_US), limit=3)
    return out.select("entity_id", "feature_name", "value", us("event_time"), F.col("newest_rank").cast("bigint").alias("newest_rank"))


@query(
    "offline_latest",
    f"""WITH {SQL_HIST} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM h
    QUALIFY row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY et DESC, it DESC, seq DESC) = 1""",
)
def offline_latest(spark, d):
    return view(store.latest(history(spark, d)))


# A store folder: the online target fails for the first batch, users are deleted, the folder is compacted, the failed batch
# is retried, and a last batch comes after the deletion.
LATE_US = MID_US + WEEK * US
SQL_KEPT = """k AS (SELECT *, row_number() OVER (PARTITION BY entity_id, feature_name, et ORDER BY seq) AS n FROM h)"""


def _store_folder(spark: SparkSession, d: str, steps) -> FeatureStore:
    """A folder with three batches of writes; ``steps`` runs before the last one."""
    path = runtime.scratch_path(spark, "store")
    w, et = writes(spark, d).drop("ingestion_time"), F.unix_micros("event_time")

    def first_fails(rows: DataFrame, target: str, batch: str) -> None:
        if target.endswith("online") and batch.startswith("writer=early/"):
            raise OSError("the online target is down")
        write_batch(rows, target, batch)

    def add(name: str, part: DataFrame, at_us: int) -> None:
        sink = StoreSink(path, on_failure="queue_retry", default_ttl=WEEK, now=moment(at_us), convert=lambda df: df, writer=first_fails, name=name)
        for _ in range(2):  # a batch may come again
            sink(part, 0)

    folder = FeatureStore(spark, path)
    add("early", w.filter(et < MID_US), NOW_US)
    add("middle", w.filter((et >= MID_US) & (et < LATE_US)), NOW_US + US)
    steps(folder)
    add("late", w.filter(et >= LATE_US), NOW_US + 9 * US)
    return folder


@query(
    "store_deletions_hold",
    f"""WITH {SQL_HIST}, {SQL_KEPT}, gone AS (SELECT DISTINCT entity_id FROM h WHERE feature_name = 'signup' AND value > 200)
    SELECT entity_id, feature_name, value, et AS event_time_us, version FROM k WHERE n = 1
    AND (et >= {LATE_US} OR entity_id NOT IN (SELECT entity_id FROM gone)) AND NOT (et < {LATE_US} AND feature_name = 'error')
    QUALIFY row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY et DESC) = 1""",
)
def store_deletions_hold(spark, d):
    w = writes(spark, d)

    def steps(folder: FeatureStore) -> None:
        users = w.filter((F.col("feature_name") == "signup") & (F.col("value") > 200)).select("entity_id").distinct()
        folder.delete(users, moment(NOW_US + 2 * US))
        folder.delete(w.filter(F.col("feature_name") == "error").select("entity_id", "feature_name").distinct(), moment(NOW_US + 3 * US))
        folder.compact()
        folder.compact(moment(NOW_US - 90 * DAY * US))
        folder.retry_failed()
        folder.compact()

    return view(_store_folder(spark, d, steps).online())


@query(
    "offline_range_in_folder",
    f"""WITH {SQL_HIST}, {SQL_KEPT}, gone AS (SELECT DISTINCT entity_id FROM h WHERE feature_name = 'signup' AND value > 200)
    SELECT entity_id, feature_name, value, et AS event_time_us, row_number() OVER (PARTITION BY entity_id, feature_name ORDER BY et DESC) AS newest_rank FROM k
    WHERE n = 1 AND et BETWEEN {MID_US - WEEK * US} AND {MID_US + 2 * WEEK * US} AND (et >= {LATE_US} OR entity_id NOT IN (SELECT entity_id FROM gone))
    QUALIFY newest_rank <= 3""",
)
def offline_range_in_folder(spark, d):
    w = writes(spark, d)
    users = w.filter((F.col("feature_name") == "signup") & (F.col("value") > 200)).select("entity_id").distinct()
    folder = _store_folder(spark, d, lambda folder: folder.delete(users, moment(NOW_US + 2 * US)))
    out = folder.time_range(moment(MID_US - WEEK * US), moment(MID_US + 2 * WEEK * US), limit=3)
    return out.select("entity_id", "feature_name", "value", us("event_time"), F.col("newest_rank").cast("bigint").alias("newest_rank"))


@query(
    "offline_history_dropped",
    f"""WITH {SQL_HIST}, {SQL_KEPT} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM k
    WHERE n = 1 AND et >= {MID_US - 12 * HOUR * US}""",
)
def offline_history_dropped(spark, d):
    folder = _store_folder(spark, d, lambda folder: None)
    folder.drop_history_before(MID.date())
    return view(folder.history())


@query("offline_entity_index", f"WITH {SQL_HIST} SELECT entity_id, feature_name, max(et) AS last_updated_us FROM h GROUP BY ALL")
def offline_entity_index(spark, d):
    return store.entity_index(history(spark, d)).select("entity_id", "feature_name", us("last_updated"))


@query("offline_retention", f"WITH {SQL_HIST} SELECT entity_id, feature_name, seq FROM h WHERE it >= {NOW_US - 14 * DAY * US}")
def offline_retention(spark, d):
    return store.retained(history(spark, d), moment(NOW_US), 14 * DAY).select("entity_id", "feature_name", "seq")


@query(
    "online_ttl_remaining",
    f"""WITH {SQL_ONLINE}, {SQL_ASK} SELECT entity_id, feature_name,
    CASE WHEN o.ex IS NULL OR o.ex < {NOW_US} THEN -2 ELSE (o.ex - {NOW_US}) // 1000000 END AS ttl_remaining
    FROM ask LEFT JOIN o USING (entity_id, feature_name)""",
)
def online_ttl_remaining(spark, d):
    return store.ttl_remaining(store.online(history(spark, d)), lookups(spark, d), moment(NOW_US))


@query(
    "online_kv_export",
    f"""WITH {SQL_ONLINE} SELECT 'feature:' || entity_id || ':' || feature_name AS key, round(value, 6) AS v,
    version AS ver, round(et / 1e6, 6) AS ts, ttl AS ttl_seconds FROM o""",
)
def online_kv_export(spark, d):
    kv = store.kv_pairs(store.online(history(spark, d)))
    body = F.from_json("value", "v double, ver long, ts double").alias("b")
    return kv.select("key", body, F.col("ttl_seconds").cast("bigint").alias("ttl_seconds")).select(
        "key", r6("b.v").alias("v"), "b.ver", r6("b.ts").alias("ts"), "ttl_seconds"
    )


@query("online_version", f"WITH {SQL_DEL} SELECT entity_id, feature_name, version FROM od")
def online_version(spark, d):
    return store.stored_version(history_with_deletions(spark, d)).select(
        "entity_id", "feature_name", F.col("version").cast("bigint").alias("version")
    )


# --- two copies ----------------------------------------------------------------------------------------------------


def copies(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Online without what has expired by the end, offline without errors."""
    h = history(spark, d)
    on = store.unexpired(store.online(h), moment(NOW_US))
    return on, store.latest(h.filter(F.col("feature_name") != "error"))


SQL_COPIES = f"""{SQL_ONLINE}, onl AS (SELECT * FROM o WHERE ex >= {NOW_US}),
    off AS (SELECT * FROM h WHERE feature_name <> 'error' QUALIFY row_number() OVER
            (PARTITION BY entity_id, feature_name ORDER BY et DESC, it DESC, seq DESC) = 1),
    j AS (SELECT coalesce(n.entity_id, f.entity_id) AS entity_id, coalesce(n.feature_name, f.feature_name) AS feature_name,
                 n.value AS nv, f.value AS fv, n.et AS net, f.et AS fet, n.entity_id IS NULL AS nn, f.entity_id IS NULL AS fn
          FROM onl n FULL OUTER JOIN off f ON n.entity_id = f.entity_id AND n.feature_name = f.feature_name),
    rep AS (SELECT *, CASE WHEN nn THEN 'Missing from online store' WHEN fn THEN 'Missing from offline store'
              WHEN abs(net - fet) > 60000000 THEN 'Temporal drift: ' || printf('%.1f', abs(net - fet) / 1e6) || 's'
              WHEN nv <> fv THEN 'Value mismatch' ELSE '' END AS details FROM j)"""


@query(
    "dual_consistency",
    f"""WITH {SQL_COPIES} SELECT entity_id, feature_name,
    CASE WHEN details LIKE 'Temporal drift%' THEN 'Temporal drift' ELSE details END AS details, details = '' AS is_consistent,
    nv AS online_value, fv AS offline_value, round(coalesce(abs(net - fet) / 1e6, 0), 6) AS drift_seconds FROM rep""",
)
def dual_consistency(spark, d):
    rep = dual.consistency(*copies(spark, d))
    kind = F.when(F.col("details").startswith("Temporal drift"), "Temporal drift").otherwise(F.col("details"))
    return rep.select(
        "entity_id", "feature_name", kind.alias("details"), "is_consistent", "online_value", "offline_value",
        r6("drift_seconds").alias("drift_seconds"),
    )


@query(
    "dual_read_fallback",
    f"""WITH {SQL_COPIES} SELECT entity_id, feature_name, coalesce(nv, fv) AS value, coalesce(net, fet) AS event_time_us,
    CASE WHEN nn THEN 'offline' ELSE 'online' END AS origin FROM j""",
)
def dual_read_fallback(spark, d):
    got = dual.read_with_fallback(*copies(spark, d))
    return got.select("entity_id", "feature_name", "value", us("event_time"), "origin")


@query("dual_backfill", f"WITH {SQL_COPIES} SELECT entity_id, feature_name, fv AS value, fet AS event_time_us FROM j WHERE nn")
def dual_backfill(spark, d):
    return dual.backfill_rows(*copies(spark, d)).select("entity_id", "feature_name", "value", us("event_time"))


@query("dual_repair", f"WITH {SQL_COPIES} SELECT entity_id, feature_name, fv AS value, fet AS event_time_us FROM rep WHERE details <> '' AND NOT fn")
def dual_repair(spark, d):
    return dual.repair_rows(*copies(spark, d)).select("entity_id", "feature_name", "value", us("event_time"))


@query(
    "dual_idempotent",
    f"""WITH {SQL_HIST}, again AS (SELECT * FROM h WHERE et >= {MID_US - DAY * US}), seen AS (SELECT * FROM h WHERE et < {MID_US})
    SELECT DISTINCT entity_id, feature_name, et AS event_time_us FROM again a
    WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.entity_id = a.entity_id AND s.feature_name = a.feature_name AND s.et = a.et)""",
)
def dual_idempotent(spark, d):
    h = history(spark, d)
    again = h.filter(F.col("event_time") >= moment(MID_US - DAY * US))
    new = dual.unseen(again.unionByName(again), h.filter(F.col("event_time") < moment(MID_US)))
    return new.select("entity_id", "feature_name", us("event_time"))


@query(
    "sink_dedup",
    f"""WITH {SQL_HIST} SELECT DISTINCT ON (entity_id, feature_name, et - et % {DAY * US}) entity_id, feature_name,
    et - et % {DAY * US} AS day_us, value, version FROM h ORDER BY entity_id, feature_name, et - et % {DAY * US}, it, seq""",
)
def sink_dedup(spark, d):
    day = F.unix_micros("event_time") - F.unix_micros("event_time") % (DAY * US)
    out = dual.dedup(history(spark, d).withColumn("day_us", day), ["entity_id", "feature_name", "day_us"])
    return out.select("entity_id", "feature_name", "day_us", "value", F.col("version").cast("bigint").alias("version"))


@query("sink_last_per_feature", f"WITH {SQL_ONLINE} SELECT entity_id, feature_name, value, et AS event_time_us, version FROM o")
def sink_last_per_feature(spark, d):
    return view(dual.last_per_feature(history(spark, d)))


# --- messages ------------------------------------------------------------------------------------------------------


def messages(spark: SparkSession, d: str, strategy: str = "key_hash") -> DataFrame:
    ev = events(spark, d)
    payload = ev.select(
        F.col("user_id").alias("entity_id"), F.col("event_type").alias("feature_name"),
        F.col("properties.value").alias("feature_value"), (F.unix_micros("ts") / 1e6).alias("timestamp"),
        (1 + F.col("event_id") % 3).alias("schema_version"), F.concat(F.lit("c-"), F.col("event_id").cast("string")).alias("correlation_id"),
        F.create_map(F.lit("k"), F.col("properties.k")).alias("metadata"),
    )
    return wire.encode(payload, "features", strategy, headers={"origin": "events"})


@query(
    "wire_roundtrip",
    f"""WITH {EV} SELECT entity_id, event_type AS feature_name, round(value, 6) AS feature_value, round(us / 1e6, 6) AS timestamp,
    1 + event_id % 3 AS schema_version, 'c-' || event_id AS correlation_id, k, 'feature_update' AS event_type, entity_id AS key,
    'c-' || event_id || '|' || (1 + event_id % 3) || '|feature_update|events' AS headers FROM ev""",
)
def wire_roundtrip(spark, d):
    got = wire.good(wire.decode(messages(spark, d)))
    h = [F.col("headers")[n] for n in ("correlation_id", "schema_version", "event_type", "origin")]
    return got.select(
        "entity_id", "feature_name", r6(F.try_variant_get("feature_value", "$", "double")).alias("feature_value"),
        r6("timestamp").alias("timestamp"), "schema_version", "correlation_id", F.col("metadata")["k"].alias("k"), "event_type",
        "key", F.concat_ws("|", *h).alias("headers"),
    )


def damaged(spark: SparkSession, d: str) -> DataFrame:
    """Messages of three event types are spoiled: wrong first byte, broken JSON, bytes that are not text."""
    ev = messages(spark, d).withColumn("kind", F.get_json_object(F.substring("value", 6, 1 << 30).cast("string"), "$.feature_name"))
    body = F.substring("value", 6, 1 << 30)
    spoiled = (
        F.when(F.col("kind") == "error", F.concat(F.lit(b"\x01"), F.substring("value", 2, 1 << 30)))
        .when(F.col("kind") == "signup", F.substring("value", 1, 20))
        .when(F.col("kind") == "view", F.concat(F.substring("value", 1, 5), F.lit(b"\xff\xfe"), body))
        .otherwise(F.col("value"))
    )
    return ev.withColumn("value", spoiled)


@query(
    "wire_dead_letter",
    """SELECT CASE event_type WHEN 'error' THEN 'invalid magic byte' WHEN 'signup' THEN 'invalid JSON' ELSE 'invalid text' END AS _error,
    CAST(user_id AS VARCHAR) AS key, count(*) AS messages FROM events WHERE event_type IN ('error', 'signup', 'view') GROUP BY ALL""",
)
def wire_dead_letter(spark, d):
    bad = wire.dead_letters(wire.decode(damaged(spark, d)))
    return bad.groupBy("_error", "key").agg(F.count(F.lit(1)).alias("messages"))


@query("wire_good_after_damage", "SELECT event_type AS feature_name, count(*) AS messages FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL")
def wire_good_after_damage(spark, d):
    return wire.good(wire.decode(damaged(spark, d))).groupBy("feature_name").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "wire_schema_defaults",
    f"""WITH {EV} SELECT event_id, CASE WHEN event_type = 'error' THEN 'missing field: correlation_id' ELSE '' END AS error,
    'feature_update' AS event_type, 0::BIGINT AS metadata_size FROM ev""",
)
def wire_schema_defaults(spark, d):
    ev = events(spark, d)
    old = F.to_json(
        F.struct(
            F.col("user_id").alias("entity_id"), F.col("event_type").alias("feature_name"),
            F.col("properties.value").alias("feature_value"), F.col("event_id").cast("double").alias("timestamp"),
            F.when(F.col("event_type") != "error", F.lit("c")).alias("correlation_id"),
        )
    )
    msgs = ev.select(F.concat(wire.header(F.lit(1)), F.encode(old, "UTF-8")).alias("value"))
    got = wire.decode(msgs)
    return got.select(
        F.col("timestamp").cast("bigint").alias("event_id"), F.coalesce("_error", F.lit("")).alias("error"), "event_type",
        F.size("metadata").cast("bigint").alias("metadata_size"),
    )


# Version 2 has one field more, version 3 one less and a default for the correlation id.
SCHEMA_VERSIONS = {
    1: wire.V1, 2: (*wire.V1, wire.Field("unit", "string", "ms")),
    3: (*[wire.Field("correlation_id", "string", "none") if f.name == "correlation_id" else f for f in wire.V1 if f.name != "event_type"], wire.Field("unit", "string", "us")),
}


@query(
    "wire_schema_versions",
    f"""WITH {EV}, v AS (SELECT *, 1 + event_id % 4 AS version FROM ev)
    SELECT us AS timestamp_us, version, CASE WHEN version < 3 THEN 'kind-' || event_type ELSE 'feature_update' END AS event_type,
    CASE WHEN version = 1 THEN 'ms' WHEN k::INT < 50 THEN 'unit-' || k WHEN version = 2 THEN 'ms' ELSE 'us' END AS unit,
    CASE WHEN k::INT % 3 > 0 THEN 'c-' || event_id WHEN version >= 3 THEN 'none' ELSE '' END AS correlation_id,
    CASE WHEN k::INT % 3 = 0 AND version < 3 THEN 'missing field: correlation_id' ELSE '' END AS error FROM v""",
)
def wire_schema_versions(spark, d):
    ev, k = events(spark, d), F.col("properties.k").cast("int")
    body = F.to_json(F.struct(
        F.col("user_id").alias("entity_id"), F.col("event_type").alias("feature_name"), F.col("properties.value").alias("feature_value"),
        (F.unix_micros("ts") / 1e6).alias("timestamp"), F.concat(F.lit("kind-"), "event_type").alias("event_type"),
        F.when(k < 50, F.concat(F.lit("unit-"), k.cast("string"))).alias("unit"), F.when(k % 3 > 0, F.concat(F.lit("c-"), F.col("event_id").cast("string"))).alias("correlation_id"),
    ))
    msgs = ev.select(F.concat(wire.header(1 + F.col("event_id") % 4), F.encode(body, "UTF-8")).alias("value"))
    got = wire.decode(msgs, SCHEMA_VERSIONS, reader=2)
    return got.select(
        F.round(F.col("timestamp") * 1e6).cast("bigint").alias("timestamp_us"), F.col("schema_version").alias("version"), "event_type", "unit",
        F.coalesce("correlation_id", F.lit("")).alias("correlation_id"), F.coalesce("_error", F.lit("")).alias("error"),
    )


# Event times to the full six hours, so that many are equal; arrival is in the reverse order of the event numbers.
TIED = f"""tied AS (SELECT CAST(user_id AS VARCHAR) AS entity_id, event_type, value, event_id,
    epoch_us(ts) - epoch_us(ts) % {6 * HOUR * US} AS us, 1000000000 - event_id AS arrival FROM events)"""


def broker_events(spark: SparkSession, d: str) -> DataFrame:
    """Messages in files with the columns of a broker, read back as events."""
    us6 = F.unix_micros("ts") - F.unix_micros("ts") % (6 * HOUR * US)
    ev = events(spark, d)
    payload = ev.select(
        F.col("user_id").alias("entity_id"), F.col("event_type").alias("feature_name"), F.col("properties.value").alias("feature_value"),
        (us6 / 1e6).alias("timestamp"), F.col("event_id").cast("string").alias("correlation_id"), "event_id",
    )
    sent = wire.encode(payload, "features").select("key", "value", "headers", "topic")
    number = F.get_json_object(F.substring("value", 6, 1 << 30).cast("string"), "$.correlation_id").cast("bigint")
    place = sent.withColumns({"partition": F.pmod(F.hash("key"), F.lit(4)), "offset": 1_000_000_000 - number, "timestamp": F.lit(None).cast("timestamp")})
    path = runtime.scratch_path(spark, "broker")
    place.write.parquet(path)
    return wire.as_events(wire.good(wire.decode(spark.read.schema(place.schema).parquet(path))))


@query(
    "broker_order_last",
    f"""WITH {TIED} SELECT entity_id, us - us % {DAY * US} AS window_start_us, us - us % {DAY * US} + {DAY * US} AS window_end_us,
    round(arg_max(value, (us, arrival)), 6) AS feature_value, count(*) AS event_count FROM tied GROUP BY ALL""",
)
def broker_order_last(spark, d):
    f = feature("last_value", "tumbling", window_size_seconds=DAY)
    return tidy(FeatureSet((f,)).compute(broker_events(spark, d)))


@query(
    "broker_order_absence",
    f"""WITH {TIED}, f AS (SELECT *, lead(us) OVER (PARTITION BY entity_id ORDER BY us, arrival) AS nxt FROM tied WHERE event_type IN ('click', 'purchase'))
    SELECT entity_id, us + {48 * HOUR * US} AS match_ts_us, CAST(event_id AS VARCHAR) AS event_ids FROM f
    WHERE event_type = 'click' AND (nxt IS NULL OR nxt > us + {48 * HOUR * US})""",
)
def broker_order_absence(spark, d):
    return shown(detect(broker_events(spark, d), ABSENCE)).select("entity_id", "match_ts_us", "event_ids")


@query(
    "partition_keys",
    f"""WITH {EV} SELECT event_id, entity_id AS key_hash, md5(entity_id || ':' || event_type) AS feature_group, '' AS round_robin FROM ev""",
)
def partition_keys(spark, d):
    ev = events(spark, d).select("event_id", F.col("user_id").alias("entity_id"), F.col("event_type").alias("feature_name"))
    return ev.select("event_id", *[wire.partition_key(s).alias(s) for s in ("key_hash", "feature_group", "round_robin")])


# --- metrics -------------------------------------------------------------------------------------------------------


def samples(spark: SparkSession, d: str) -> DataFrame:
    return events(spark, d).select("ts", "event_id", "event_type", F.col("properties.value").alias("value"))


SQL_LATENCY = """SELECT count(*) AS count, round(avg(value), 3) AS mean_ms, round(median(value), 3) AS median_ms,
    round(CASE WHEN count(*) < 20 THEN max(value) ELSE list_sort(list(value))[CAST(floor(count(*) * 95 / 100) AS INT) + 1] END, 3) AS p95_ms,
    round(CASE WHEN count(*) < 100 THEN max(value) ELSE list_sort(list(value))[CAST(floor(count(*) * 99 / 100) AS INT) + 1] END, 3) AS p99_ms,
    round(min(value), 3) AS min_ms, round(max(value), 3) AS max_ms"""


@query("latency_summary", SQL_LATENCY + " FROM (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)")
def latency_summary(spark, d):
    return monitor.latency_summary(samples(spark, d), tie="event_id")


@query(
    "latency_by_type",
    SQL_LATENCY.replace("SELECT", "SELECT event_type,", 1)
    + """ FROM (SELECT event_type, value FROM events QUALIFY row_number() OVER
    (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) <= 1000) GROUP BY event_type""",
)
def latency_by_type(spark, d):
    return monitor.latency_summary(samples(spark, d), tie="event_id", keys=["event_type"])


@query(
    "throughput",
    f"""WITH r AS (SELECT epoch_us(ts) AS us FROM events WHERE epoch_us(ts) BETWEEN {MID_US - DAY * US} AND {MID_US})
    SELECT count(*) AS count_in_window, round(count(*) / (({MID_US} - min(us)) / 1e6), 6) AS rate FROM r""",
)
def throughput(spark, d):
    out = monitor.throughput(samples(spark, d), moment(MID_US), DAY)
    return out.select("count_in_window", r6("rate").alias("rate"))


@query(
    "throughput_by_interval",
    f"""SELECT epoch_us(ts) - epoch_us(ts) % {HOUR * US} AS interval_start_us, count(*) AS events,
    round(count(*) / 3600.0, 6) AS rate FROM events GROUP BY ALL""",
)
def throughput_by_interval(spark, d):
    out = monitor.throughput_by_interval(samples(spark, d), HOUR)
    return out.select(us("interval_start"), "events", r6("rate").alias("rate"))


def as_computed(spark: SparkSession, d: str) -> DataFrame:
    """Writes seen as computed features."""
    return writes(spark, d).select(
        "entity_id", "feature_name", F.col("value").alias("feature_value"), F.col("event_time").alias("window_end"),
        F.col("ingestion_time").alias("computed_at"), "seq",
    )


@query(
    "freshness",
    f"WITH {SQL_HIST} SELECT feature_name, round(({NOW_US + DAY * US} - max(it)) / 1e6, 2) AS freshness_s FROM h GROUP BY feature_name",
)
def freshness(spark, d):
    return monitor.freshness(as_computed(spark, d), moment(NOW_US + DAY * US))


@query(
    "backpressure",
    """WITH s AS (SELECT least(value / 100.0, 1.0) AS u FROM events ORDER BY ts DESC, event_id DESC LIMIT 100), a AS (SELECT avg(u) AS a, max(u) AS m, count(*) AS n FROM s)
    SELECT CASE WHEN a > 0.9 THEN 'critical' WHEN a > 0.7 THEN 'high' WHEN a > 0.5 THEN 'moderate' ELSE 'none' END AS level,
    round(a, 3) AS avg_utilization, round(m, 3) AS max_utilization, n AS samples FROM a""",
)
def backpressure(spark, d):
    use = samples(spark, d).withColumn("value", F.least(F.col("value") / 100.0, F.lit(1.0)))
    return monitor.backpressure(use, tie="event_id")


@query(
    "errors",
    f"""WITH {EV} SELECT CASE WHEN value >= 50 THEN 'timeout' ELSE 'parse_error' END AS error_type, count(*) AS errors
    FROM ev WHERE event_type = 'error' GROUP BY ALL""",
)
def errors(spark, d):
    kind = F.when(F.col("value") >= 50, "timeout").otherwise("parse_error")
    return monitor.errors(samples(spark, d), F.col("event_type") == "error", kind)


@query(
    "error_rate",
    """SELECT count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type <> 'error') AS processed,
    round(count(*) FILTER (event_type = 'error') / greatest(count(*) FILTER (event_type <> 'error'), 1), 6) AS error_rate FROM events""",
)
def error_rate(spark, d):
    is_error = F.col("event_type") == "error"
    return monitor.error_rate(samples(spark, d), is_error, ~is_error)


@query(
    "metrics_report",
    f"""WITH {SQL_LATE}, lat AS ({SQL_LATENCY} FROM (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)),
    win AS (SELECT entity_id, us - us % {DAY * US} + {DAY * US} AS e, sum(value) AS v FROM ev GROUP BY ALL),
    flat AS ({SQL_LATENCY.replace("value", "v")} FROM (SELECT v FROM win ORDER BY e DESC, v DESC LIMIT 1000)),
    bad AS (SELECT CASE WHEN value >= 50 THEN 'timeout' ELSE 'parse_error' END AS t, count(*) AS n FROM ev WHERE event_type = 'error' GROUP BY ALL),
    used AS (SELECT avg(u) AS a, max(u) AS m, count(*) AS n FROM (SELECT least(value / 100.0, 1.0) AS u FROM events ORDER BY ts DESC, event_id DESC LIMIT 100)),
    c AS (SELECT 0::BIGINT AS filtered, (SELECT count(*) FROM wm WHERE wm - us <= 1800000000) AS processed,
    (SELECT count(*) FROM wm WHERE us < wm) AS late, (SELECT count(*) FROM wm WHERE wm - us > 1800000000) AS dropped,
    (SELECT count(*) FROM win) AS features_computed, (SELECT count(*) FROM win WHERE e > {NOW_US}) AS windows_active,
    (SELECT count(*) FROM win WHERE e <= {NOW_US}) AS windows_triggered)
    SELECT c.*, lat.count AS latency_samples, lat.mean_ms, lat.p95_ms, lat.p99_ms, flat.median_ms AS feature_median_ms,
    (SELECT round(count(*) / (({NOW_US} - min(us)) / 1e6), 6) FROM ev WHERE us BETWEEN {NOW_US - 3 * DAY * US} AND {NOW_US}) AS throughput_eps,
    (SELECT round(count(*) / (({NOW_US} - min(e)) / 1e6), 6) FROM win WHERE e BETWEEN {NOW_US - 3 * DAY * US} AND {NOW_US}) AS throughput_fps,
    (SELECT sum(n)::BIGINT FROM bad) AS errors, (SELECT string_agg(t || '=' || n, ',' ORDER BY t) FROM bad) AS errors_by_type,
    round((SELECT sum(n) FROM bad) / c.processed, 6) AS error_rate, (SELECT round(({NOW_US} - max(e)) / 1e6, 2) FROM win) AS freshness_s,
    CASE WHEN a > 0.9 THEN 'critical' WHEN a > 0.7 THEN 'high' WHEN a > 0.5 THEN 'moderate' ELSE 'none' END AS backpressure,
    round(a, 3) AS avg_utilization, round(m, 3) AS max_utilization, used.n AS backpressure_samples FROM c, lat, flat, used""",
)
def metrics_report(spark, d):
    v = F.col("properties.value")
    rep = monitor.report(
        tagged(spark, d).withColumn("value", v), DAILY_SUM.compute(events(spark, d)), moment(NOW_US), window_seconds=3 * DAY,
        is_error=F.col("event_type") == "error", error_type=F.when(v >= 50, "timeout").otherwise("parse_error"),
        utilization=F.least(v / 100.0, F.lit(1.0)), feature_latency="feature_value",
    )
    by_type = F.array_join(F.transform(F.map_entries("errors_by_type"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return rep.select(
        "filtered", "processed", "late", "dropped", "features_computed", "windows_active", "windows_triggered", "latency_samples", "mean_ms", "p95_ms", "p99_ms",
        "feature_median_ms", r6("throughput_eps").alias("throughput_eps"), r6("throughput_fps").alias("throughput_fps"), "errors", by_type.alias("errors_by_type"),
        "error_rate", F.map_values("freshness")[0].alias("freshness_s"), "backpressure", "avg_utilization", "max_utilization", "backpressure_samples",
    )


@query(
    "alert_limits",
    f"""WITH lat AS ({SQL_LATENCY} FROM (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)),
    er AS (SELECT round(count(*) FILTER (event_type = 'error') / greatest(count(*) FILTER (event_type <> 'error'), 1), 6) AS error_rate FROM events)
    SELECT error_rate, p99_ms, error_rate > 0.01 AS error_rate_exceeded, p99_ms > 100 AS p99_exceeded FROM lat, er""",
)
def alert_limits(spark, d):
    s = samples(spark, d)
    is_error = F.col("event_type") == "error"
    both = monitor.error_rate(s, is_error, ~is_error).unionByName(monitor.latency_summary(s, tie="event_id"), allowMissingColumns=True)
    both = both.agg(F.max("error_rate").alias("error_rate"), F.max("p99_ms").alias("p99_ms"))
    return monitor.alert_limits(both)


# --- quality -------------------------------------------------------------------------------------------------------


@query(
    "dq_nulls",
    """WITH e AS (SELECT CAST(c_custkey AS VARCHAR) AS entity_id FROM customer), n AS (SELECT unnest(['click', 'view', 'purchase', 'refund']) AS feature_name),
    have AS (SELECT event_type AS feature_name, count(DISTINCT user_id) AS present FROM events
             WHERE CAST(user_id AS VARCHAR) IN (SELECT entity_id FROM e) GROUP BY event_type)
    SELECT feature_name, (SELECT count(*) FROM e) AS expected, coalesce(present, 0) AS present,
    round(1 - coalesce(present, 0) / (SELECT count(*) FROM e), 6) AS null_ratio,
    1 - coalesce(present, 0) / (SELECT count(*) FROM e) > 0.05 AS exceeded FROM n LEFT JOIN have USING (feature_name)""",
)
def dq_nulls(spark, d):
    expected = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("entity_id"))
    out = monitor.null_ratio(as_computed(spark, d), expected, [*NAMES, "refund"])
    return out.select("feature_name", "expected", "present", r6("null_ratio").alias("null_ratio"), "exceeded")


@query(
    "dq_staleness",
    f"""WITH {SQL_HIST} SELECT feature_name, round(({NOW_US + DAY * US} - max(it)) / 1e6, 2) AS freshness_s,
    round(({NOW_US + DAY * US} - max(it)) / 1e6, 2) > 86400 AS stale FROM h GROUP BY feature_name""",
)
def dq_staleness(spark, d):
    return monitor.staleness(as_computed(spark, d), moment(NOW_US + DAY * US), DAY)


@query(
    "dq_drift",
    f"""WITH {SQL_HIST},
    r AS (SELECT feature_name, value, row_number() OVER (PARTITION BY feature_name ORDER BY et DESC, seq DESC) AS rn FROM h QUALIFY rn <= 2000),
    e AS (SELECT feature_name, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]) AS e FROM r WHERE rn > 1000 GROUP BY feature_name),
    b AS (SELECT feature_name, rn <= 1000 AS now, len(list_filter(e.e, lambda x: x < r.value)) AS bin FROM r JOIN e USING (feature_name)),
    g AS (SELECT n.feature_name, bins.bin, count(*) FILTER (b.now AND b.bin = bins.bin) AS a, count(*) FILTER (NOT b.now AND b.bin = bins.bin) AS z
          FROM (SELECT DISTINCT feature_name FROM b) n, (SELECT unnest(range(10)) AS bin) bins JOIN b ON b.feature_name = n.feature_name GROUP BY ALL),
    t AS (SELECT feature_name, count(*) FILTER (now) AS current, count(*) FILTER (NOT now) AS baseline FROM b GROUP BY feature_name),
    p AS (SELECT feature_name, current, baseline, round(sum(((a + 0.5) / (current + 5) - (z + 0.5) / (baseline + 5))
      * ln(((a + 0.5) / (current + 5)) / ((z + 0.5) / (baseline + 5)))), 6) AS psi
    FROM g JOIN t USING (feature_name) GROUP BY ALL)
    SELECT *, psi > 0.1 AS drifted FROM p""",
)
def dq_drift(spark, d):
    out = monitor.drift(as_computed(spark, d), tie="seq")
    return out.select("feature_name", "current", "baseline", r6("psi").alias("psi"), "drifted")


@query(
    "reconcile",
    f"""WITH a AS ({SQL_DAILY}), s AS (SELECT entity_id, window_end_us, CASE WHEN feature_value >= 300 THEN feature_value + 0.01 ELSE feature_value END AS v
      FROM a WHERE window_end_us <= {MID_US})
    SELECT entity_id, window_end_us, CASE WHEN v IS NULL THEN 'missing_stored' WHEN abs(feature_value - v) <= 0.001 THEN 'match' ELSE 'mismatch' END AS status
    FROM a LEFT JOIN s USING (entity_id, window_end_us)""",
)
def reconcile(spark, d):
    fresh = DAILY_SUM.compute(events(spark, d))
    v = F.col("feature_value")
    stored = fresh.filter(F.col("window_end") <= moment(MID_US)).withColumn("feature_value", F.when(r6(v) >= 300, v + 0.01).otherwise(v))
    out = monitor.reconcile(fresh, stored, sample_rate=1.0)
    return out.select("entity_id", us("window_end"), "status")


# --- streams -------------------------------------------------------------------------------------------------------


def event_stream(spark: SparkSession, d: str) -> DataFrame:
    """The events table as a stream of files."""
    schema = table(spark, d, "events").schema
    raw = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    return as_events(raw)


def _drained(features: FeatureSet, spark: SparkSession, d: str) -> DataFrame:
    return tidy(drain(stream_all(features, event_stream(spark, d), 600)))


def _closed(sql: str, behind: int) -> str:
    """Windows closed by the stream's watermark, which has millisecond resolution."""
    return f"""SELECT * FROM ({sql}) WHERE window_end_us <=
    (SELECT (max(epoch_us(ts)) // 1000) * 1000 - {behind * US} FROM events)"""


def _register_streams() -> None:
    def add(name: str, f: FeatureDefinition, sql: str) -> None:
        query(name, _closed(sql, 630))(lambda spark, d: _drained(FeatureSet((f,)), spark, d))

    base = {"session_gap_seconds": GAP}
    add("stream_tumbling", feature("avg", "tumbling", window_size_seconds=DAY), sql_windows("avg", DAY))
    add("stream_tumbling_distinct", feature("distinct_count", "tumbling", window_size_seconds=DAY), sql_windows("distinct_count", DAY))
    add("stream_sliding_distinct", feature("distinct_count", "sliding", window_size_seconds=DAY, slide_seconds=6 * HOUR), sql_windows("distinct_count", DAY, 6 * HOUR))
    add("stream_sliding", feature("sum", "sliding", window_size_seconds=DAY, slide_seconds=6 * HOUR), sql_windows("sum", DAY, 6 * HOUR))
    add("stream_session", feature("count", "session", **base, max_session_seconds=None), sql_sessions("count", GAP * US))


_register_streams()


# A session is emitted when a later event of the user closes it, or when the watermark passes its end.
SQL_STREAM_CAPPED = f"""SELECT * EXCLUDE (nxt) FROM (
    SELECT *, lead(window_start_us) OVER (PARTITION BY entity_id ORDER BY window_start_us) AS nxt
    FROM (CAPPED))
    WHERE nxt IS NOT NULL
          AND nxt <= (SELECT (max(epoch_us(ts)) // 1000) * 1000 - {630 * US} FROM events)
       OR window_end_us + 1 <= (SELECT (max(epoch_us(ts)) // 1000) * 1000 - {630 * US} FROM events)"""


def _register_capped_streams() -> None:
    for agg in ("count", "stddev", "first_value", "last_value", "distinct_count", "percentile"):
        f = feature(agg, "session", session_gap_seconds=GAP, max_session_seconds=CAP)
        name = "stream_session_capped" + ("" if agg == "count" else f"_{agg}")
        query(name, SQL_STREAM_CAPPED.replace("CAPPED", SQL_CAPPED.replace("AGG", SQL_AGG[agg])))(
            lambda spark, d, f=f: _drained(FeatureSet((f,)), spark, d)
        )


_register_capped_streams()


# Arrival is up to an hour after the event; one write per week of arrivals, in as many files as a micro-batch reads, so
# files can bring events in any order within a week, and the watermark waits for eight days. Micro-batches are as many as
# weeks, whatever the size of the table.
WAIT = 8 * DAY


def disordered_stream(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "events")
    arrival = F.unix_micros(F.col("ts").cast("timestamp")) + F.pmod(F.xxhash64("event_id"), F.lit(3600)) * US
    late = raw.withColumn("__week", F.floor(arrival / (7 * DAY * US)))
    path = runtime.scratch_path(spark, "disordered")
    first, last = late.agg(F.min("__week"), F.max("__week")).first()
    files = spark.sparkContext.defaultParallelism
    for week in range(first, last + 1) if first is not None else ():
        late.filter(F.col("__week") == week).drop("__week").repartition(files).write.mode("append").parquet(path)
    return as_events(spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", files).parquet(path))


def _passed(sql: str, column: str, types: tuple[str, ...]) -> str:
    """Rows that the watermark of the pattern's own events has passed."""
    kinds = ", ".join(f"'{t}'" for t in types)
    return f"""SELECT * FROM ({sql}) WHERE {column} <=
    (SELECT (max(epoch_us(ts)) // 1000) * 1000 - {WAIT * US} FROM events WHERE event_type IN ({kinds}))"""


def _register_disordered() -> None:
    for name, p in (("sequence", SEQUENCE), ("absence", ABSENCE), ("frequency", FREQUENCY)):
        query(f"stream_{name}_disordered", _passed(ORACLES[f"cep_{name}"], "match_ts_us", p.event_types))(
            lambda spark, d, p=p: shown(drain(stream_pattern(disordered_stream(spark, d), p, WAIT)))
        )
    f = feature("last_value", "session", session_gap_seconds=GAP, max_session_seconds=CAP)
    sql = SQL_STREAM_CAPPED.replace("CAPPED", SQL_CAPPED.replace("AGG", SQL_AGG["last_value"])).replace(str(630 * US), str((WAIT + 30) * US))
    query("stream_session_disordered", sql)(lambda spark, d: tidy(drain(stream_all(FeatureSet((f,)), disordered_stream(spark, d), WAIT))))


_register_disordered()


@query("stream_windows_open", sql_windows("sum", DAY))
def stream_windows_open(spark, d):
    path, checkpoint = runtime.scratch_path(spark, "open-windows"), runtime.scratch_path(spark, "open-windows-state")
    f = FeatureSet((feature("sum", "tumbling", window_size_seconds=DAY),))
    for q in update_windows(f, disordered_stream(spark, d), path, checkpoint, WAIT, availableNow=True):
        q.awaitTermination()
    return tidy(current_windows(spark, path))


@query(
    "stream_windows_active",
    f"""WITH w AS (SELECT *, window_end_us > {MID_US} AS open FROM ({sql_windows("count", 6 * HOUR)}))
    SELECT entity_id, count(*) FILTER (open) AS open, count(*) FILTER (NOT open) AS closed FROM w GROUP BY entity_id""",
)
def stream_windows_active(spark, d):
    path, checkpoint = runtime.scratch_path(spark, "open-windows"), runtime.scratch_path(spark, "open-windows-state")
    f = FeatureSet((feature("count", "tumbling", window_size_seconds=6 * HOUR),))
    for q in update_windows(f, event_stream(spark, d), path, checkpoint, 600, availableNow=True):
        q.awaitTermination()
    closed = W.is_ready(F.col("window_end"), moment(MID_US))
    return current_windows(spark, path).groupBy("entity_id").agg(F.count_if(~closed).alias("open"), F.count_if(closed).alias("closed"))


@query(
    "session_open_closed",
    f"""SELECT entity_id, count(*) FILTER (window_end_us <= {MID_US}) AS closed, count(*) FILTER (window_end_us > {MID_US}) AS open
    FROM ({sql_sessions("count", GAP * US)}) GROUP BY entity_id""",
)
def session_open_closed(spark, d):
    f = FeatureSet((feature("count", "session", session_gap_seconds=GAP, max_session_seconds=None),))
    closed = W.is_ready(F.col("window_end"), moment(MID_US))
    return f.compute(events(spark, d)).groupBy("entity_id").agg(F.count_if(closed).alias("closed"), F.count_if(~closed).alias("open"))


SQL_STORED = _closed(sql_windows("sum", DAY), 630)


def _stored_stream(spark: SparkSession, d: str, strategy: str, failing: str = ""):
    """Daily sums of a stream in a store folder; every batch comes twice, as after a failure, and one target may be down."""
    path, checkpoint = runtime.scratch_path(spark, "stored"), runtime.scratch_path(spark, "stored-state")

    def writer(rows: DataFrame, target: str, batch: str) -> None:
        if failing and target.endswith(failing):
            raise OSError(f"{failing} is down")
        write_batch(rows, target, batch)

    sink = StoreSink(path, strategy, "queue_retry", now=moment(NOW_US), writer=writer)
    seen: list[int] = []

    def twice(batch: DataFrame, batch_id: int) -> None:
        for _ in range(2):
            sink(batch, batch_id)
        seen.append(batch_id)

    start(stream_all(FeatureSet((feature("sum", "tumbling", window_size_seconds=DAY),)), event_stream(spark, d), 600), twice, checkpoint, availableNow=True).awaitTermination()
    return FeatureStore(spark, path), sink, seen


def _stored_view(rows: DataFrame) -> DataFrame:
    return rows.select("entity_id", us("event_time").alias("window_end_us"), r6("value").alias("feature_value"), F.col("metadata")["event_count"].cast("bigint").alias("event_count"))


@query("sink_exactly_once", f"SELECT entity_id, window_end_us, feature_value, event_count FROM ({SQL_STORED})")
def sink_exactly_once(spark, d):
    return _stored_view(_stored_stream(spark, d, "sync_both")[0].history())


@query(
    "sink_failed_target",
    f"""SELECT entity_id, window_end_us, feature_value, event_count FROM ({SQL_STORED})
    QUALIFY row_number() OVER (PARTITION BY entity_id ORDER BY window_end_us DESC) = 1""",
)
def sink_failed_target(spark, d):
    """The online target is down for the whole stream and is written from the queue afterwards."""
    folder, _, _ = _stored_stream(spark, d, "offline_first", "online")
    folder.retry_failed()
    return _stored_view(folder.online())


@query("sink_counters", f"SELECT count(*)::BIGINT AS records_written, 0::BIGINT AS batch_errors FROM ({SQL_STORED})")
def sink_counters(spark, d):
    """What a sink has counted over a stream: a batch that is repeated counts once."""
    folder, sink, seen = _stored_stream(spark, d, "online_first")
    counted = folder.history().limit(0).agg(F.lit(sink.metrics["records_written"]).cast("bigint").alias("records_written"), F.lit(sink.metrics["batch_errors"]).cast("bigint").alias("batch_errors"))
    if sink.metrics["batches"] != len(seen):
        raise AssertionError(sink.metrics)
    return counted


@query("stream_handled_batches", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def stream_handled_batches(spark, d):
    """Every micro-batch is handed to a function, which writes it by its number."""
    path, checkpoint = runtime.scratch_path(spark, "handled"), runtime.scratch_path(spark, "handled-state")

    def handler(batch: DataFrame, batch_id: int) -> None:
        batch.select("event_id", "event_type").write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    rows.handle_batches(disordered_stream(spark, d), handler, checkpoint, availableNow=True).awaitTermination()
    return monitor.event_types(spark.read.schema("event_id long, event_type string, batch_id long").parquet(path))


@query(
    "stream_dedup_disordered",
    f"""WITH {EV}, r AS (SELECT entity_id, event_type AS feature_name, us - us % {DAY * US} AS day_us, event_id, value FROM ev)
    SELECT entity_id, feature_name, day_us, event_id, value FROM r
    WHERE day_us <= (SELECT max(day_us) FROM r) - {WAIT * US}
    QUALIFY row_number() OVER (PARTITION BY entity_id, feature_name, day_us ORDER BY event_id) = 1""",
)
def stream_dedup_disordered(spark, d):
    day = F.timestamp_micros(F.unix_micros("ts") - F.unix_micros("ts") % (DAY * US))
    rec = disordered_stream(spark, d).select(
        F.col("user_id").alias("entity_id"), F.col("event_type").alias("feature_name"), day.alias("window_end"), "event_id", F.col("properties.value").alias("value")
    )
    out = drain(dedup_stream(rec, within_seconds=WAIT, order=F.col("event_id")))
    return out.select("entity_id", "feature_name", F.unix_micros("window_end").alias("day_us"), "event_id", "value")


@query(
    "keyed_state",
    f"""WITH {EV}, s AS (SELECT *, sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY us, event_id) AS n,
    lag(event_type) OVER (PARTITION BY entity_id ORDER BY us, event_id) AS before FROM ev)
    SELECT entity_id, event_id, n::BIGINT AS purchases, coalesce(before, '') AS before FROM s WHERE event_type = 'purchase'""",
)
def keyed_state(spark, d):
    """The number of purchases and the event before each, from state that a user's function keeps per key."""
    rows = events(spark, d).select(F.col("user_id").alias("entity_id"), "event_id", "event_type", "ts", "seq")

    def count(key, batch, state):
        n, before, out = state.get("n", 0), state.get("before", ""), []
        for event_id, kind in zip(batch["event_id"], batch["event_type"]):
            if kind == "purchase":
                n += 1
                out.append((key, int(event_id), n, before))
            before = kind
        state.set("n", n)
        state.set("before", before)
        return pd.DataFrame(out, columns=["entity_id", "event_id", "purchases", "before"])

    return with_state(rows, count, "entity_id string, event_id long, purchases long, before string", order=("ts", "seq"))


@query(
    "stream_patterns",
    f"""WITH w AS (SELECT (max(epoch_us(ts)) // 1000) * 1000 AS upto FROM events WHERE event_type = 'click')
    SELECT 'browse_to_purchase' AS pattern_name, entity_id, t2 AS match_ts_us FROM ({SQL_SEQ} SELECT * FROM m), w WHERE t2 <= upto
    UNION ALL SELECT 'abandoned', entity_id, due FROM ({SQL_ABS} SELECT * FROM m), w WHERE due <= upto
    UNION ALL SELECT 'rapid_clicks', entity_id, us FROM ({SQL_FREQ} SELECT * FROM s WHERE hit), w WHERE us <= upto
    UNION ALL SELECT 'high_value', CAST(user_id AS VARCHAR), epoch_us(ts) FROM events WHERE event_type = 'purchase' AND value >= 200""",
)
def patterns_on_stream(spark, d):
    alerts = drain(stream_patterns(event_stream(spark, d), PATTERNS, 0))
    return alerts.select("pattern_name", "entity_id", us("match_ts"))
