"""Exact duplicates by sorting content.

Sampled splitters cut the order of normalised texts into ranges (``repartitionByRange``), each range is sorted, spilling
where it must, and one pass compares every text in full with its neighbour. Of equal texts the smallest identifier stays.

The sort order is (first 64 characters, digest, text, identifier): equal texts are adjacent, a splitter has a bounded
size whatever the texts are, and many copies of one text are spread over several ranges by their identifiers. A run of
equal texts that meets the end of a range may go on in the next one; such runs, two per range at most, are put together
by their digest afterwards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, stored, text_of

SPACES = r"[\x20\x09-\x0D]+"
PREFIX_CHARS = 64
_RUNS = "id long, leader long, run_rows long, counted long, digest binary, edge boolean"


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), SPACES, " ")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of equal neighbours of one sorted range; a run's rows leave when its end is known."""
    text = digest = None
    ids: list[int | None] = []
    out: dict[str, list] = {n: [] for n in ("id", "leader", "run_rows", "counted", "digest", "edge")}
    first = True

    def close(edge: bool) -> None:
        n = len(ids)
        out["id"] += ids
        out["leader"] += [ids[0]] * n
        out["run_rows"] += [n] * n
        out["counted"] += [n] + [0] * (n - 1)
        out["digest"] += [digest] * n
        out["edge"] += [edge] * n

    def taken() -> pa.RecordBatch:
        made = pa.record_batch(
            [
                pa.array(out["id"], pa.int64()), pa.array(out["leader"], pa.int64()), pa.array(out["run_rows"], pa.int64()),
                pa.array(out["counted"], pa.int64()), pa.array(out["digest"], pa.binary()), pa.array(out["edge"], pa.bool_()),
            ],
            names=list(out),
        )
        for values in out.values():
            values.clear()
        return made

    for batch in batches:
        for i, t, d in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if ids and t == text:
                ids.append(i)
                continue
            if ids:
                close(first)
                first = False
            text, digest, ids = t, d, [i]
        if len(out["id"]) >= 4096:
            yield taken()
    if ids:
        close(True)
    if out["id"]:
        yield taken()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col, keep_id, group_size, kept, text_sha256``.

    A null text counts as empty. Rows without an identifier are kept apart from nothing: they are compared like others,
    never stay if a row with an identifier has the same text, and have ``kept`` false then; a group without any
    identifier has a null ``keep_id`` and keeps its rows. Repeated rows with one identifier all count, and all have
    ``kept`` true if that identifier stays. Other columns are not read. An empty table gives an empty result.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), normalised(text_col).alias("t"))
    rows = rows.withColumn("digest", F.unhex(F.sha2(F.col("t"), 256)))
    order = [F.substring("t", 1, PREFIX_CHARS), F.col("digest"), F.col("id").asc_nulls_last()]
    ranged = rows.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(order[0], order[1], F.col("t"), order[2]).select("id", "t", "digest")
    runs = stored(ranged.mapInArrow(_runs, _RUNS), "exact-runs")
    # Two runs per range at most, so the table is bounded by the number of partitions.
    cut = runs.filter(F.col("edge") & (F.col("counted") > 0)).groupBy("digest")
    cut = cut.agg(F.min("leader").alias("whole_leader"), F.sum("counted").alias("whole_rows"))
    out = runs.join(F.broadcast(cut), "digest", "left")
    keep = F.when(F.col("edge"), F.col("whole_leader")).otherwise(F.col("leader"))
    size = F.when(F.col("edge"), F.col("whole_rows")).otherwise(F.col("run_rows"))
    return out.select(
        F.col("id").alias(id_col), keep.alias("keep_id"), size.alias("group_size"), F.coalesce(F.col("id") == keep, keep.isNull()).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
