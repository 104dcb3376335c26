"""Join helper used by the ordered operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left", hint: bool = False) -> DataFrame:
    """Equi-join on columns that are never null; the right side's key columns are dropped.

    Plain equality lets Spark reuse a partitioning made for the same keys.
    """
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    if hint:
        renamed = F.broadcast(renamed)
    cond = None
    for k in keys:
        c = F.col(k) == F.col(f"__r_{k}")
        cond = c if cond is None else cond & c
    joined = left.join(renamed, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"__r_{k}" for k in keys])
