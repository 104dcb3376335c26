"""Writing features from micro-batches (SINK-1..6, DUAL-1, DUAL-6, PIPE-10).

Each target is one Parquet table, partitioned by writer, batch and event date. A micro-batch overwrites its own partition;
an ad-hoc write or deletion has a writer name of its own, so writers never share one. The time of a batch is stored before
its first attempt and ties are decided by content, so a repeated batch leaves the same data. Should a driver die while
Spark moves a batch's files into place, the batch is whole again when Spark has repeated it.

Compaction is a job like others: it writes the latest rows as one more batch and removes the batches that it has read. Rows
that are there twice change nothing, so it may stop anywhere. Deletion marks stay as long as a write that is older than
they are may still arrive: one in the queue of failed writes, or a micro-batch that Spark may repeat.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import date
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidemark.functions.columns import interval
from tidemark.plans import dual, store
from tidemark.streaming.run import state_settings

# Which targets are written, in which order, and whether the second needs the first to succeed (DUAL-1).
STRATEGIES: dict[str, tuple[tuple[str, ...], bool]] = {
    "sync_both": (("online", "offline"), False),
    "async_offline": (("online", "offline"), False),
    "online_first": (("online", "offline"), True),
    "offline_first": (("offline", "online"), True),
}
FAILURES = ("fail_fast", "best_effort", "queue_retry")
# What decides on the last of a feature's rows.
LAST = ("event_time", *store.WRITE_ORDER)
TIMES = "batch long, at long"
# Writers of deletion marks have names that begin so: their partitions are found by name.
DELETIONS = "delete-"


def unit(writer: str, batch_id: int) -> str:
    """The directory of one batch of one writer, below a target."""
    return f"writer={writer}/batch_id={batch_id}"


def write_batch(df: DataFrame, path: str, batch: str) -> None:
    """Write a batch into its own directory ``batch`` (see ``unit``), by event date.

    Dates are spread over as many tasks as their size asks for, so one busy date is not written by one task. Files are
    sorted by key, so that lookups skip row groups.
    """
    dated = df.withColumn("event_date", F.to_date("event_time"))
    spread = dated.hint("rebalance", "event_date").sortWithinPartitions("event_date", *store.KEYS, "event_time")
    spread.write.mode("overwrite").partitionBy("event_date").parquet(f"{path}/{batch}")


def _folder(spark: SparkSession, path: str) -> tuple[Any, Any]:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _folder(spark, path)
    return fs.exists(where)


def remove(spark: SparkSession, path: str) -> None:
    fs, where = _folder(spark, path)
    fs.delete(where, True)


def batches(spark: SparkSession, path: str, below: str = "") -> list[str]:
    """Partitions of a target as ``writer=.../batch_id=...``, by their names only; for compaction and other upkeep."""
    fs, where = _folder(spark, f"{path}/writer=*/batch_id=*{below}")
    found = [x.getPath().toUri().getPath() for x in fs.globStatus(where) or []]
    return sorted(x[x.rindex("/writer=") + 1 :] for x in found)


def read_batches(spark: SparkSession, path: str, batch: str = "") -> DataFrame:
    """A target, or one batch of it; ``writer``, ``batch_id`` and ``event_date`` are partition columns."""
    extra = [T.StructField("writer", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("event_date", T.DateType())]
    schema = T.StructType([*store.HISTORY.fields, *extra])
    if not exists(spark, f"{path}/{batch}"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(f"{path}/{batch}")


def as_writes(computed: DataFrame) -> DataFrame:
    """Computed features as store writes: the value holds from the end of its window."""
    return computed.select(
        "entity_id", "feature_name", F.col("feature_value").alias("value"), F.col("window_end").alias("event_time"),
        F.create_map(
            F.lit("window_start"), F.col("window_start").cast("string"), F.lit("event_count"), F.col("event_count").cast("string")
        ).alias("metadata"),
    )


@dataclass
class StoreSink:
    """A ``foreachBatch`` function that writes a batch of features to the online and offline targets.

    ``on_failure``: ``fail_fast`` fails the batch, which Spark then repeats; ``best_effort`` and ``queue_retry`` go on
    with the other target and keep what a target missed for ``retry_failed``. ``name`` tells this writer's batches from
    those of others: streams that write to one store need different names.
    """

    path: str
    strategy: str = "sync_both"
    on_failure: str = "fail_fast"
    ttl_seconds: int | None = None
    default_ttl: int | None = store.DEFAULT_TTL_SECONDS
    now: Column | None = None
    convert: Callable[[DataFrame], DataFrame] = as_writes
    writer: Callable[[DataFrame, str, str], None] = write_batch
    name: str = "stream"
    metrics: dict[str, int] = field(default_factory=lambda: {"records_written": 0, "batches": 0, "batch_errors": 0})
    _counted: str | None = field(default=None, init=False)

    def __post_init__(self) -> None:
        if self.strategy not in STRATEGIES:
            raise ValueError(f"unknown write strategy: {self.strategy}")
        if self.on_failure not in FAILURES:
            raise ValueError(f"unknown failure policy: {self.on_failure}")

    def __call__(self, computed: DataFrame, batch_id: int) -> None:
        spark = computed.sparkSession
        batch = unit(self.name, batch_id)
        writes = self.convert(computed)
        if "seq" not in writes.columns:
            # Ties are decided by what is written, so a repeated batch decides them alike.
            parts = [F.to_json(c) if isinstance(writes.schema[c].dataType, T.MapType) else F.col(c).cast("string") for c in writes.columns]
            writes = writes.withColumn("seq", F.xxhash64(*parts))
        rows = store.records(writes, self._time(spark, batch_id), self.ttl_seconds, self.default_ttl)
        # Repeats of the same window's feature within the batch count once (SINK-2).
        rows = dual.dedup(rows, [*store.KEYS, "event_time"])
        rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self._write(rows, batch)
            if self._counted != batch:  # a repeat counts once
                self._counted = batch
                self.metrics["records_written"] += rows.count()
                self.metrics["batches"] += 1
        finally:
            rows.unpersist()

    def _time(self, spark: SparkSession, batch_id: int) -> Column:
        """When the batch was first attempted: stored, so that a repeat has the same ingestion time.

        A writer's last batch only is kept, since Spark does not go back further.
        """
        if self.now is not None:
            return self.now
        path = f"{self.path}/times/writer={self.name}"
        stored = spark.read.schema(TIMES).parquet(path).filter(F.col("batch") == batch_id).first() if exists(spark, path) else None
        if stored is None:
            spark.range(1).select(F.lit(batch_id).cast("long").alias("batch"), F.unix_micros(F.current_timestamp()).alias("at")).write.mode("overwrite").parquet(path)
            stored = spark.read.schema(TIMES).parquet(path).first()
        return F.timestamp_micros(F.lit(stored["at"]))

    def _write(self, rows: DataFrame, batch: str) -> None:
        targets, ordered = STRATEGIES[self.strategy]
        errors: list[tuple[str, Exception]] = []
        for target in targets:
            if errors and ordered and self.on_failure == "fail_fast":
                break
            try:
                # The online target only needs the last value per feature (SINK-3).
                part = dual.last_per_feature(rows, [F.col(c) for c in LAST]) if target == "online" else rows
                self.writer(part, f"{self.path}/{target}", batch)
                remove(rows.sparkSession, f"{self.path}/failed/{target}/{batch}")  # of an attempt before this one
            except Exception as e:  # noqa: BLE001
                self.metrics["batch_errors"] += 1
                errors.append((target, e))
        if not errors:
            return
        if self.on_failure == "fail_fast" or len(errors) == len(targets):
            raise errors[0][1]
        for target, _ in errors:
            write_batch(rows, f"{self.path}/failed/{target}", batch)


@dataclass(frozen=True)
class FeatureStore:
    """The store in a shared folder: reading its targets, ad-hoc writes, deletions, compaction and retries."""

    spark: SparkSession
    path: str

    def history(self) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/offline").select(*store.HISTORY.names)

    def time_range(
        self, start: store.Moment, end: store.Moment, entities: DataFrame | None = None, names: Sequence[str] = (),
        limit: int | None = store.DEFAULT_RANGE_LIMIT,
    ) -> DataFrame:
        """Records of the history in [start, end] (OFF-2): the dates of the range are read, and the deletions' partitions."""
        log = read_batches(self.spark, f"{self.path}/offline")
        days = F.col("event_date").between(F.to_date(store._at(start)), F.to_date(store._at(end)))
        marks = log.filter(F.col("writer").startswith(DELETIONS)).select(*store.HISTORY.names)
        return store.time_range(log.filter(days).select(*store.HISTORY.names), start, end, entities, names, limit, marks)

    def online_log(self) -> DataFrame:
        return read_batches(self.spark, f"{self.path}/online").select(*store.HISTORY.names)

    def online(self) -> DataFrame:
        """The latest value of each key (FS-2)."""
        return store.online(self.online_log())

    def set_features(self, writes: DataFrame, now: Column | None = None, ttl_seconds: int | None = None) -> str:
        """Write values to both targets under a writer name of its own, which is returned (FS-1, ON-1, OFF-1)."""
        name = f"adhoc-{uuid.uuid4().hex}"
        StoreSink(self.path, ttl_seconds=ttl_seconds, now=now, convert=lambda df: df, name=name)(writes, 0)
        remove(self.spark, f"{self.path}/times/writer={name}")  # nobody repeats it
        return name

    def delete(self, targets: DataFrame, now: Column | None = None) -> str:
        """Delete features or whole entities, under a writer name of its own (FS-9, ON-4)."""
        name = f"{DELETIONS}{uuid.uuid4().hex}"
        # Looked for once: both targets get the same marks, also if what they are made from changes.
        marks = store.tombstones(targets, now).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for target in ("online", "offline"):
                write_batch(marks, f"{self.path}/{target}", unit(name, 0))
        finally:
            marks.unpersist()
        return name

    def compact(self, now: Column | None = None) -> int:
        """Reduce the online target to the latest values, without expired ones; returns the number removed (FS-11).

        Deletion marks not older than ``oldest_open_write`` stay, the last one of each key. Readers that began before
        may miss a file and have to be repeated, so this is for quiet hours.
        """
        path = f"{self.path}/online"
        names = batches(self.spark, path)
        if not names:
            return 0
        log = self.online_log()
        view = store.online(log)
        removed = 0 if now is None else store.expired(view, now).count()
        kept = view if now is None else store.unexpired(view, now)
        kept = kept.select(*store.HISTORY.names)
        since = self.oldest_open_write()
        if since is not None:
            marks = log.filter((F.col("op") != "set") & (F.col("ingestion_time") >= F.timestamp_micros(F.lit(since))))
            last = F.max_by(F.struct(*[c for c in store.HISTORY.names if c not in (*store.KEYS, "op")]), store.write_order())
            marks = marks.groupBy(*store.KEYS, "op").agg(last.alias("r")).select(*store.KEYS, "op", "r.*")
            kept = kept.unionByName(marks)
        number = 1 + max([int(n.rsplit("=", 1)[1]) for n in names if n.startswith("writer=compact/")], default=-1)
        write_batch(kept, path, unit("compact", number))
        for n in names:
            remove(self.spark, f"{path}/{n}")
        return removed

    def oldest_open_write(self) -> int | None:
        """The earliest ingestion time, in microseconds, of a write that may still reach the online target; None if none.

        Open are the failed online writes, and the last batch of every stream, as Spark may repeat it. Writes that bring
        an older ingestion time of their own later on are not foreseen.
        """
        failed = read_batches(self.spark, f"{self.path}/failed/online").agg(F.min(F.unix_micros("ingestion_time"))).first()[0]
        times = f"{self.path}/times"
        last = self.spark.read.schema(TIMES).parquet(times).agg(F.min("at")).first()[0] if exists(self.spark, times) else None
        return min([t for t in (failed, last) if t is not None], default=None)

    def drop_history_before(self, day: date) -> int:
        """Remove the offline partitions of event dates before ``day``; returns how many (OFF-5).

        Which they are is read from the names of directories; no data is read.
        """
        path = f"{self.path}/offline"
        old = [n for n in batches(self.spark, path, "/event_date=*") if n.rsplit("=", 1)[1] < day.isoformat()]
        for n in old:
            remove(self.spark, f"{path}/{n}")
        return len(old)

    def export_snapshot(self, path: str, now: Column) -> None:
        """Nested JSON of the unexpired values, one object per entity (FS-12)."""
        store.nested_snapshot(self.online(), now).write.mode("overwrite").json(path)

    def retry_failed(self) -> tuple[int, int]:
        """Write the batches that a target missed; returns how many succeeded and failed (DUAL-6).

        They keep their ingestion times, so deletions that came after them hold.
        """
        ok = bad = 0
        for target in ("online", "offline"):
            failed, done = f"{self.path}/failed/{target}", f"{self.path}/{target}"
            for b in batches(self.spark, failed):
                rows = read_batches(self.spark, failed, b).select(*store.HISTORY.names)
                part = dual.last_per_feature(rows, [F.col(c) for c in LAST]) if target == "online" else rows
                try:
                    write_batch(part, done, b)
                    ok += 1
                except Exception:  # noqa: BLE001
                    bad += 1
                    continue
                remove(self.spark, f"{failed}/{b}")
        return ok, bad


def start(stream: DataFrame, sink: Callable[[DataFrame, int], Any], checkpoint: str, **trigger: Any) -> StreamingQuery:
    """Run a stream into a sink: ``processingTime="5 seconds"`` or ``availableNow=True`` (SINK-1).

    Settings of the state store apply to queries started from here on.
    """
    for k, v in state_settings(stream.sparkSession).items():
        if k.startswith("spark.sql.streaming"):
            stream.sparkSession.conf.set(k, v)
    writer = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    return (writer.trigger(**trigger) if trigger else writer).start()


def dedup_stream(
    features: DataFrame, keys: Sequence[str] = ("entity_id", "feature_name", "window_end"), time: str = "window_end",
    within_seconds: float = 300.0, order: Column | None = None,
) -> DataFrame:
    """A stream of feature records without repeats (SINK-2, DUAL-2).

    For records read from a topic or files. Windows computed by this package are emitted once and need no such step. With
    ``order`` the first record of its key by that order is the one that is emitted, whichever micro-batch brings it: the
    key must hold the time, and its record comes when the watermark has passed it. Without it a record goes on at once,
    and of repeats within a micro-batch any may be the one. Repeats are found for at least ``within_seconds``.
    """
    bounded = features.withWatermark(time, interval(within_seconds))
    if order is None:
        return bounded.dropDuplicatesWithinWatermark(list(keys))
    if time not in keys:
        raise ValueError("a defined winner needs the time among the keys")
    # One record per key in state.
    rest = [c for c in features.columns if c not in keys]
    first = bounded.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("__first"))
    return first.select(*keys, "__first.*").select(*features.columns)
