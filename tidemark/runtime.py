"""Session settings, small-table handling and scratch space shared by every operator."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A group (key, key+window, ...) with more rows than this is processed in several slices.
HOT_GROUP_ROWS = 2_000_000
# A helper table is broadcast only after counting that it has at most this many rows.
BROADCAST_ROWS = 100_000


def use_utc(spark: SparkSession) -> None:
    """All event times are UTC instants."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current is None:
        if configured is None:
            if not _is_local(spark):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            configured = tempfile.mkdtemp(prefix="tidemark-")
        sc.setCheckpointDir(configured)
        current = sc.getCheckpointDir()
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Compute a table once and cut its lineage through the shared checkpoint folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def pin_if_any(df: DataFrame) -> DataFrame | None:
    """``pin`` a table that is usually empty: counting it is one job, and nothing is written when it is."""
    return pin(df) if df.agg(F.count(F.lit(1))).first()[0] else None


def broadcast_if_small(pinned: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcast hint behind a row count; a larger table is left to a shuffled join.

    ``pinned`` must be materialised, or a projection of such a table, so that counting it is cheap.
    """
    limit = BROADCAST_ROWS if rows is None else rows
    small = pinned.limit(limit + 1).count() <= limit
    return F.broadcast(pinned) if small else pinned


@contextlib.contextmanager
def settings(spark: SparkSession, values: Mapping[str, str]) -> Iterator[None]:
    """Apply session settings for the duration of a block."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
