"""Row operators (ROW-1..9), applied in the order they are written (D-1).

Conditions and projections are Columns, so they reach the scan. Python callables work on Arrow batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

Batches = Iterator[pd.DataFrame]


def keep(events: DataFrame, condition: Column, observation: Observation | None = None) -> DataFrame:
    """Events for which the condition is true (ROW-1); the observation counts ``processed`` and ``filtered``."""
    passes = F.coalesce(condition, F.lit(False))
    if observation is not None:
        events = events.observe(
            observation, F.count_if(passes).alias("processed"), F.count_if(~passes).alias("filtered")
        )
    return events.filter(condition)


def transform(events: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Replace or add columns (ROW-2)."""
    return events.withColumns(dict(columns))


def transform_batches(
    events: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: T.StructType | str | None = None
) -> DataFrame:
    """Apply a Python function to Arrow batches: one row to one, none or several (ROW-2, ROW-3)."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield fn(batch)

    return events.mapInPandas(run, schema or events.schema)


def expand(events: DataFrame, items: Column, as_name: str = "item") -> DataFrame:
    """One row per array element; an empty or missing array gives none (ROW-3)."""
    return events.select("*", F.explode(items).alias(as_name))


def key_by(events: DataFrame, key: Column) -> DataFrame:
    """Set the partition key of the operators that follow (ROW-4)."""
    return events.withColumn("entity_id", F.coalesce(key.cast("string"), F.lit("")))


def handle_batches(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str, **trigger):
    """Hand every micro-batch to a function (ROW-5)."""
    writer = stream.writeStream.foreachBatch(handler).option("checkpointLocation", checkpoint)
    return writer.trigger(**trigger).start() if trigger else writer.start()
