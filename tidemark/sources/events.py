"""Event records as DataFrames (SRC-6)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import from_epoch, to_epoch

# An event as a JSON record; properties stay JSON text.
RECORD = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("properties", T.StringType()),
])


def from_records(df: DataFrame) -> DataFrame:
    """(event_id, user_id, event_type, timestamp, properties) with float epoch seconds to events."""
    rest = [c for c in df.columns if c not in ("event_id", "user_id", "event_type", "timestamp", "properties")]
    return df.select(
        "event_id", "user_id", "event_type", from_epoch(F.col("timestamp")).alias("ts"), "properties", *rest
    )


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Events from JSON lines."""
    return from_records(spark.read.schema(RECORD).json(path))


def to_json_records(events: DataFrame) -> DataFrame:
    """Events as one JSON text per row, in column ``value``; structured properties become a JSON object."""
    kind = events.schema["properties"].dataType
    props = F.col("properties")
    if isinstance(kind, T.StringType):
        props = F.parse_json(props)
    record = F.struct(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        to_epoch(F.col("ts")).alias("timestamp"),
        props.alias("properties"),
    )
    return events.select(F.to_json(record).alias("value"))


def parse_json_records(lines: DataFrame) -> DataFrame:
    """The inverse of ``to_json_records``."""
    return from_records(lines.select(F.from_json("value", RECORD).alias("r")).select("r.*"))


def map_columns(
    df: DataFrame, *, event_id: str, user_id: str, event_type: str, ts: str, properties: Mapping[str, Column],
    seq: str | None = None,
) -> DataFrame:
    """Any table as events.

    Properties become a struct of typed columns: fields that a query does not use are not read.
    """
    return df.select(
        F.col(event_id).alias("event_id"),
        F.col(user_id).cast("string").alias("user_id"),
        F.col(event_type).alias("event_type"),
        F.col(ts).cast("timestamp").alias("ts"),
        F.struct(*[c.alias(n) for n, c in properties.items()]).alias("properties"),
        *([F.col(seq).alias("seq")] if seq else []),
    )
