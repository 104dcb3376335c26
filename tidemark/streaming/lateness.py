"""Late events of a stream as a second output (TIME-4, ROW-6)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from tidemark.functions.columns import MICROS
from tidemark.operators.lateness import late_output, on_time, tag_lateness

Handler = Callable[[DataFrame, int], None]


@dataclass
class LateSplit:
    """A ``foreachBatch`` function: events in time go to one handler, dropped ones to the other.

    The watermark reached by a batch is one number. It is kept below ``path`` under the batch id, so a repeated batch
    starts from the same watermark.
    """

    path: str
    handler: Handler
    late_handler: Handler
    delay_seconds: float = 5.0
    allowed_seconds: float = 30.0
    order: str = "seq"

    def __call__(self, events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        before = 0.0
        if batch_id > 0:
            before = spark.read.parquet(f"{self.path}/batch_id={batch_id - 1}").first()["watermark"]
        tagged = tag_lateness(
            events, self.delay_seconds, self.allowed_seconds, self.order, start_micros=round(before * MICROS)
        ).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.handler(on_time(tagged), batch_id)
            self.late_handler(late_output(tagged), batch_id)
            reached = tagged.agg(F.coalesce(F.max("watermark"), F.lit(before)).alias("watermark"))
            reached.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch_id}")
        finally:
            tagged.unpersist()
