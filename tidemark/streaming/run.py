"""Starting streams: settings for state, and draining a bounded source into a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark import runtime

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def state_settings(spark: SparkSession) -> dict[str, str]:
    """RocksDB state, and on a local session no more state partitions than cores."""
    values = {"spark.sql.streaming.stateStore.providerClass": STATE_STORE}
    if spark.sparkContext.master.startswith("local"):
        values["spark.sql.shuffle.partitions"] = str(min(8, spark.sparkContext.defaultParallelism))
    return values


def drain(stream: DataFrame) -> DataFrame:
    """Run a stream over all data available now and return what it emitted, read back from the shared folder."""
    spark = stream.sparkSession
    out, checkpoint = runtime.scratch_path(spark, "stream"), runtime.scratch_path(spark, "stream-state")
    with runtime.settings(spark, state_settings(spark)):
        writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        writer.trigger(availableNow=True).start(out).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
