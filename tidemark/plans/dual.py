"""Two copies of the same features: comparing, reading with fallback, repairing (DUAL-2..5, SINK-2, SINK-3)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.joins import join_on
from tidemark.plans.store import KEYS, WRITE_ORDER

MAX_DRIFT_SECONDS = 60.0


def _text(value: Column, value_json: Column) -> Column:
    return F.coalesce(value.cast("string"), value_json)


def _side(view: DataFrame, prefix: str) -> DataFrame:
    cols = [c for c in view.columns if c not in KEYS]
    return view.select(*KEYS, F.struct(*[F.col(c) for c in cols]).alias(prefix))


def paired(online: DataFrame, offline: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Both copies side by side, one row per key: structs ``online`` and ``offline``, null where a copy lacks the key.

    Both sides have one row per key, so the join is free of skew. ``requests`` adds keys that neither side knows.
    """
    both = _side(online, "online").join(_side(offline, "offline"), KEYS, "full_outer")
    return both if requests is None else join_on(requests.select(*KEYS).distinct(), both, KEYS)


def consistency(
    online: DataFrame, offline: DataFrame, requests: DataFrame | None = None, max_drift: float = MAX_DRIFT_SECONDS
) -> DataFrame:
    """Report per key (DUAL-4); drift beyond the limit overrides a value mismatch."""
    on, off = F.col("online"), F.col("offline")
    drift = F.abs(F.unix_micros("online.event_time") - F.unix_micros("offline.event_time")) / F.lit(1e6)
    differs = ~_text(F.col("online.value"), F.col("online.value_json")).eqNullSafe(
        _text(F.col("offline.value"), F.col("offline.value_json"))
    )
    details = (
        F.when(on.isNull() & off.isNull(), "Both stores empty")
        .when(on.isNull(), "Missing from online store")
        .when(off.isNull(), "Missing from offline store")
        .when(drift > max_drift, F.format_string("Temporal drift: %.1fs", drift))
        .when(differs, "Value mismatch")
        .otherwise("")
    )
    report = paired(online, offline, requests).select(
        *KEYS,
        details.alias("details"),
        F.col("online.value").alias("online_value"),
        F.col("offline.value").alias("offline_value"),
        F.col("online.version").alias("online_version"),
        F.col("offline.version").alias("offline_version"),
        F.coalesce(drift, F.lit(0.0)).alias("drift_seconds"),
    )
    return report.withColumn("is_consistent", F.col("details").isin("", "Both stores empty"))


def read_with_fallback(online: DataFrame, offline: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Online value, or else the offline one, with its ``origin`` (DUAL-3)."""
    both = paired(online, offline, requests)
    pick = lambda c: F.coalesce(F.col(f"online.{c}"), F.col(f"offline.{c}"))
    origin = F.when(F.col("online").isNotNull(), "online").when(F.col("offline").isNotNull(), "offline")
    from_online = F.col("online").isNotNull()
    one = lambda c: F.when(from_online, F.col(f"online.{c}")).otherwise(F.col(f"offline.{c}"))
    return both.select(
        *KEYS, one("value").alias("value"), one("value_json").alias("value_json"), pick("version").alias("version"),
        pick("event_time").alias("event_time"), origin.alias("origin"),
    )


def backfill_rows(online: DataFrame, offline: DataFrame, requests: DataFrame | None = None) -> DataFrame:
    """Offline records to be written to the online copy because it lacks them (DUAL-3)."""
    missing = join_on(offline, online.select(*KEYS), KEYS, "left_anti")
    return missing if requests is None else join_on(missing, requests.select(*KEYS).distinct(), KEYS, "left_semi")


def repair_rows(online: DataFrame, offline: DataFrame, source: str = "offline", max_drift: float = MAX_DRIFT_SECONDS) -> DataFrame:
    """Records to append to the other side, for every inconsistent key the source side has (DUAL-5)."""
    if source not in ("online", "offline"):
        raise ValueError("source must be 'online' or 'offline'")
    bad = consistency(online, offline, max_drift=max_drift).filter(~F.col("is_consistent")).select(*KEYS)
    return join_on(online if source == "online" else offline, bad, KEYS, "left_semi")


def _first(rows: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key. Spark applies the limit within each task before the shuffle, so a key with many rows sends few."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__at", F.row_number().over(w)).filter(F.col("__at") == 1).drop("__at")


def dedup(rows: DataFrame, keys: Sequence[str], order: Column | None = None) -> DataFrame:
    """The first row per key, with all of its own columns (SINK-2, SINK-3, D-14)."""
    by = [F.col(c) for c in WRITE_ORDER] if order is None else [order]
    return _first(rows, keys, [c.asc_nulls_last() for c in by])


def last_per_feature(rows: DataFrame, order: Column | Sequence[Column] | None = None) -> DataFrame:
    """The last row per (entity, feature), keeping its own time, version and TTL (SINK-3)."""
    by = [F.col(c) for c in WRITE_ORDER] if order is None else [order] if isinstance(order, Column) else order
    return _first(rows, KEYS, [c.desc_nulls_last() for c in by])


def unseen(writes: DataFrame, history: DataFrame) -> DataFrame:
    """Writes whose (entity, feature, event time) is new: first of equal writes, not in the history (DUAL-2)."""
    key = [*KEYS, "event_time"]
    return join_on(dedup(writes, key), history.select(*key), key, "left_anti")
