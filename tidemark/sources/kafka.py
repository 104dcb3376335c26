"""Kafka as source and sink (SRC-1, SRC-2, SRC-11). Needs Spark's Kafka package on the class path."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidemark.sources.wire import dead_letters, decode, good


def read_stream(
    spark: SparkSession, servers: str, topics: Sequence[str], max_offsets: int | None = None,
    starting: str = "earliest", options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A stream of decoded messages (SRC-1)."""
    reader = spark.readStream.format("kafka").options(**(options or {}))
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    reader = reader.option("startingOffsets", starting).option("includeHeaders", "true")
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return decode(reader.load())


def read_range(
    spark: SparkSession, servers: str, topics: Sequence[str], starting: str = "earliest", ending: str = "latest",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """A bounded pull (SRC-2)."""
    reader = spark.read.format("kafka").options(**(options or {}))
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", ",".join(topics))
    reader = reader.option("startingOffsets", starting).option("endingOffsets", ending)
    return decode(reader.option("includeHeaders", "true").load())


def consume(
    decoded: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str, interval: str = "5 seconds",
    dead: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Hand batches to a function; offsets advance only after it returns, a failed batch is repeated (SRC-1, D-16).

    With ``dead``, messages that could not be decoded go there and only good ones are processed (SRC-5).
    """

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            process(good(batch), batch_id)
            dead(dead_letters(batch), batch_id)
        finally:
            batch.unpersist()

    writer = decoded.writeStream.foreachBatch(process if dead is None else split)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def write_batch(messages: DataFrame, servers: str) -> None:
    """Publish encoded messages (SRC-11)."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).save()


def write_stream(messages: DataFrame, servers: str, checkpoint: str) -> StreamingQuery:
    """Publish a stream of encoded messages (SRC-11)."""
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
    return writer.option("checkpointLocation", checkpoint).start()
