"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from typing import TypeVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import runtime

# Rows and bytes handed to Python at a time, so that a batch of very long texts stays small.
BATCH_ROWS, BATCH_BYTES = 256, 8 << 20
# Texts that Python works on together: so many bytes, or one batch.
TOGETHER_BYTES = 4 << 20
# A key with at least one in so many of the rows is hot; there are at most as many hot keys as this number.
HOT_SHARE = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches short, in rows and in bytes; smaller settings of the user's stay."""
    parse = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for key, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{key}"
        now = spark.conf.get(name)
        if now.startswith("-") or not 0 < parse(now) <= most:
            spark.conf.set(name, str(most))


def together(batches: Iterator[pa.RecordBatch], most: int = TOGETHER_BYTES) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of about so many bytes, so that a word or piece is looked up once for more texts."""
    held, size = [], 0
    for batch in batches:
        if held and size + batch.nbytes > most:
            yield held
            held, size = [], 0
        held.append(batch)
        size += batch.nbytes
    if held:
        yield held


T = TypeVar("T")
_SLOT: list[tuple[str, object, object]] = []


def worker_slot(owner: str, key: object, make: Callable[[], T]) -> T:
    """What this Python worker keeps between tasks: one object, that of the operator at work.

    Spark uses a worker for many stages. When another operator, or one with other settings, takes the slot, what was in
    it goes, and its memory is given back to the system.
    """
    if not _SLOT or _SLOT[0][:2] != (owner, key):
        if _SLOT:
            _SLOT.clear()
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (AttributeError, OSError):  # only glibc has it
                pass
        _SLOT.append((owner, key, make()))
    return _SLOT[0][2]  # type: ignore[return-value]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage is cut and a lost executor loses nothing.

    The files go when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = runtime.scratch_path(spark, name)
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def attach(left: DataFrame, groups: DataFrame, key: str, size: str, how: str = "left") -> DataFrame:
    """Join ``left`` with one row per key of ``groups``, whose column ``size`` counts the rows of ``left`` with that key.

    Keys with at least 1/HOT_SHARE of all rows, at most HOT_SHARE of them, are broadcast, so their rows of ``left`` stay
    where they are. The other rows are shuffled, and no key of them is large. ``groups`` must be a stored table.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    least = max(1000, total // HOT_SHARE)
    hot = groups.filter(F.col(size) >= least)
    rest = groups.filter(F.col(size) < least)
    marks = F.broadcast(hot.select(F.col(key).alias("__hot")))
    is_hot = left.join(marks, F.col(key) == F.col("__hot"), "left")
    in_hot = is_hot.filter(F.col("__hot").isNotNull()).drop("__hot").join(F.broadcast(hot), key, "inner")
    in_rest = is_hot.filter(F.col("__hot").isNull()).drop("__hot").join(rest, key, how)
    return in_hot.unionByName(in_rest)


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def may_match(left: DataFrame, column: str, wanted: DataFrame, slots: int = 1 << 18, others: bool = False) -> DataFrame:
    """Rows of ``left`` whose key may be in ``wanted``: a cheap filter before a shuffled join, never too strict.

    With ``others`` all the rest, whose key is surely not.

    The keys are reduced to at most ``slots`` hash slots, so what is broadcast has a fixed bound; with very many keys
    all slots are taken and all rows pass.
    """
    slot = F.pmod(F.xxhash64(column), F.lit(slots))
    taken = wanted.select(slot.alias("__slot")).distinct()
    return left.withColumn("__slot", slot).join(F.broadcast(taken), "__slot", "left_anti" if others else "left_semi").drop("__slot")
