"""Named values per key for user functions on streams (ROW-9)."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle


class KeyState:
    """State of the current key: any JSON value under a name."""

    def __init__(self, values: Any) -> None:
        self._values = values

    def get(self, name: str, default: Any = None) -> Any:
        return json.loads(self._values.getValue((name,))[0]) if self._values.containsKey((name,)) else default

    def set(self, name: str, value: Any) -> None:
        self._values.updateValue((name,), (json.dumps(value),))

    def clear(self) -> None:
        self._values.clear()


Handler = Callable[[str, pd.DataFrame, KeyState], pd.DataFrame]


class _Handler(StatefulProcessor):
    def __init__(self, fn: Handler) -> None:
        self.fn = fn

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = KeyState(handle.getMapState("values", "name string", "value string"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for batch in rows:
            out = self.fn(key[0], batch, self.state)
            if out is not None and len(out):
                yield out

    def close(self) -> None:
        pass


def with_state(rows: DataFrame, fn: Handler, schema: T.StructType, key: str = "entity_id", order: Sequence[str] = ("ts",)) -> DataFrame:
    """Apply ``fn(key, rows, state)`` to the rows of each key; rows come in Arrow batches.

    On a stream each micro-batch brings rows as they arrive. A table's rows come in ``order``, so the same function gives
    in batch what it gives on a stream whose rows arrive in that order. No key's rows are held in memory together.
    """
    keyed = rows.withColumn(key, F.col(key).cast("string"))
    if not rows.isStreaming:
        # State in a table's query needs the coordinator of state, which Spark starts with its stream manager.
        _ = rows.sparkSession.streams.active
        # Sorting by key is what grouping asks for; the finer order within a key stays.
        keyed = keyed.repartition(key).sortWithinPartitions(key, *order)
    return keyed.groupBy(key).transformWithStateInPandas(_Handler(fn), schema, "Append", "None")
