"""As-of join: for each request, the latest record of the same key at or before its time (FS-7).

Requests and records are put on one time axis and scanned once. No range join is needed, and a key with very many
records is scanned in slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.operators.joins import join_on
from tidemark.operators.slices import Running, running, with_slices


def as_of(
    requests: DataFrame, records: DataFrame, keys: Sequence[str], request_time: str, record_time: str,
    tie: Sequence[str] = (), forward: bool = False, row_limit: int | None = None,
) -> DataFrame:
    """Requests (all rows kept) with column ``record``: a struct of the matching record's columns, or null.

    Equal times match. ``tie`` orders records of equal time, the last one wins. ``forward`` looks for the earliest
    record at or after the request instead, and then the first of equal time wins.
    """
    keys = list(keys)
    # With few distinct keys asked for, all other records are discarded before anything is shuffled.
    asked = requests.select(*keys).distinct()
    if asked.limit(runtime.BROADCAST_ROWS + 1).count() <= runtime.BROADCAST_ROWS:
        records = join_on(records, asked, keys, "left_semi", hint=True)

    null_tie = [F.lit(None).cast(records.schema[c].dataType).alias(f"__tie{i}") for i, c in enumerate(tie)]
    record = F.struct(*[F.col(c) for c in records.columns])
    request = F.struct(*[F.col(c) for c in requests.columns])
    side_of_record, side_of_request = (1, 0) if forward else (0, 1)
    left = records.select(
        *keys, F.unix_micros(record_time).alias("__us"), F.lit(side_of_record).alias("__side"),
        *[F.col(c).alias(f"__tie{i}") for i, c in enumerate(tie)],
        record.alias("__record"), F.lit(None).cast(requests.select(request.alias("r")).schema["r"].dataType).alias("__request"),
    )
    right = requests.select(
        *keys, F.unix_micros(request_time).alias("__us"), F.lit(side_of_request).alias("__side"), *null_tie,
        F.lit(None).cast(records.select(record.alias("r")).schema["r"].dataType).alias("__record"), request.alias("__request"),
    )
    both, piece = with_slices(left.unionByName(right), keys, "__us", row_limit)
    order = ["__us", "__side", *[f"__tie{i}" for i in range(len(tie))]]
    found = running(both, keys, order, piece, {"record": Running("last", F.col("__record"))}, reverse=forward)
    return found.filter(F.col("__side") == side_of_request).select("__request.*", "record")
