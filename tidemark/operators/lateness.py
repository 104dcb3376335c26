"""Watermark and lateness of a recorded stream (TIME-1..8).

In a replay the watermark is a running maximum over arrival order, without a key: the whole table is one ordered
sequence. It is cut into slices of arrival order, and the maximum of earlier slices is carried over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import MICROS, micros, to_epoch
from tidemark.operators.slices import Running, running, with_slices


def tag_lateness(
    events: DataFrame, delay_seconds: float = 5.0, allowed_seconds: float = 30.0, order: str = "seq",
    tie: str = "event_id", event_time: bool = True, row_limit: int | None = None, start_micros: int = 0,
) -> DataFrame:
    """Add ``watermark`` (epoch seconds), ``is_late``, ``lateness_s`` and ``is_dropped`` to each event.

    The watermark never regresses and starts at ``start_micros``; an event first advances it and is then judged by it. In
    processing-time mode (``event_time=False``) there is no watermark and nothing is late.
    """
    if not event_time:
        none = F.lit(False)
        return events.select(
            "*", F.lit(None).cast("double").alias("watermark"), none.alias("is_late"), F.lit(0.0).alias("lateness_s"),
            none.alias("is_dropped"),
        )
    rows = events.withColumn("__us", F.unix_micros("ts"))
    cut, piece = with_slices(rows, [], order, row_limit)
    order_by = list(dict.fromkeys([order, tie]))
    run = running(cut, [], order_by, piece, {"__max": Running("max", F.col("__us"))})
    wm = F.greatest(F.lit(start_micros), F.col("__max") - F.lit(micros(delay_seconds)))
    behind = wm - F.col("__us")
    return run.select(
        *events.columns,
        (wm / F.lit(float(MICROS))).alias("watermark"),
        (behind > 0).alias("is_late"),
        (F.greatest(behind, F.lit(0)) / F.lit(float(MICROS))).alias("lateness_s"),
        (behind > F.lit(micros(allowed_seconds))).alias("is_dropped"),
    )


def on_time(tagged: DataFrame) -> DataFrame:
    """Events that are processed: on time, or late within the allowance (TIME-3)."""
    return tagged.filter(~F.col("is_dropped"))


def late_output(tagged: DataFrame) -> DataFrame:
    """Side output: events beyond the allowed lateness (TIME-4, ROW-6)."""
    return tagged.filter("is_dropped")


def lateness_counts(tagged: DataFrame, kept: Column | None = None) -> DataFrame:
    """One row: filtered, processed, late and dropped events (TIME-8). ``kept`` is the filter condition, if any."""
    kept = F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))
    return tagged.agg(
        F.count_if(~kept).alias("filtered"),
        F.count_if(kept & ~F.col("is_dropped")).alias("processed"),
        F.count_if(kept & F.col("is_late")).alias("late"),
        F.count_if(kept & F.col("is_dropped")).alias("dropped"),
    )


def watermark_lag(events: DataFrame, now: Column, delay_seconds: float = 5.0) -> DataFrame:
    """Final watermark and how far it is behind ``now``, in seconds (TIME-7)."""
    wm = F.greatest(F.lit(0.0), F.max(to_epoch(F.col("ts"))) - F.lit(float(delay_seconds)))
    return events.agg(wm.alias("watermark")).withColumn("lag_s", to_epoch(now) - F.col("watermark"))


