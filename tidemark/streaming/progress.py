"""Metrics of running streams as samples ``(ts, kind, name, value)`` (MET-4, MET-6, MET-7, TIME-7)."""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidemark import runtime

SAMPLE = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("kind", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


class ProgressLog(StreamingQueryListener):
    """Appends a few numbers per micro-batch to a folder, one small JSON file each; the driver keeps nothing.

    Without a path a new folder is made in the shared one. Read it with ``frame`` or as a table of its own.
    """

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self._spark = spark
        self.path = path or runtime.scratch_path(spark, "progress")

    def _append(self, samples: list[tuple[datetime, str, str, float]]) -> None:
        lines = "".join(json.dumps({"ts": t.isoformat(), "kind": k, "name": n, "value": v}) + "\n" for t, k, n, v in samples)
        where = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{uuid.uuid4().hex}.json")
        out = where.getFileSystem(self._spark._jsc.hadoopConfiguration()).create(where)
        out.write(bytearray(lines.encode()))
        out.close()

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        at = datetime.fromisoformat(p.timestamp.replace("Z", "+00:00"))
        name = p.name or str(p.id)
        numbers = {
            "input_rows": p.numInputRows,
            "input_rate": p.inputRowsPerSecond,
            "processed_rate": p.processedRowsPerSecond,
            "batch_ms": p.batchDuration,
            "state_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "state_rows_removed": sum(s.numRowsRemoved for s in p.stateOperators),
            "rows_dropped_late": sum(s.numRowsDroppedByWatermark for s in p.stateOperators),
        }
        if p.processedRowsPerSecond:
            # How much of its capacity the query uses.
            numbers["utilization"] = min(p.inputRowsPerSecond / p.processedRowsPerSecond, 1.0)
        mark = p.eventTime.get("watermark") if p.eventTime else None
        if mark:
            reached = datetime.fromisoformat(mark.replace("Z", "+00:00"))
            numbers["watermark_lag_s"] = (at - reached).total_seconds()
        self._append([(at, kind, name, float(v)) for kind, v in numbers.items() if v is not None and v == v])

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass

    def frame(self, spark: SparkSession) -> DataFrame:
        """The samples so far."""
        where = self._spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self._spark._jsc.hadoopConfiguration()).exists(where):
            return spark.createDataFrame([], SAMPLE)
        return spark.read.schema(SAMPLE).json(self.path)
