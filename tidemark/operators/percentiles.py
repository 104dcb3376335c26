"""Exact percentile of groups of any size (AGG-7).

The built-in ``percentile`` keeps a group's distinct values in one buffer. Groups above the row limit are ranked in
slices instead, and only the two order statistics needed for the interpolation are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.joins import join_on
from tidemark.operators.slices import Running, running, with_slices


def ranked_percentile(
    rows: DataFrame, group: Sequence[str], v: str, percentile: float, limit: int | None = None, times: str | None = None
) -> DataFrame:
    """(group, value, n): linear interpolation at ``percentile / 100 * (n - 1)``, by distributed ranking.

    ``times`` names a column that says how often a row counts.
    """
    group = list(group)
    # Equal values are counted first: prices and counts have few distinct values, and a hot value becomes one row.
    rows = rows.filter(F.col(v).isNotNull()).groupBy(*group, v).agg((F.sum(times) if times else F.count(F.lit(1))).alias("__times"))
    counts = rows.groupBy(*group).agg(F.sum("__times").alias("n"))
    cut, piece = with_slices(rows, group, v, limit)
    ranked = running(cut, group, [v], piece, {"__rank": Running("sum", F.col("__times"))})
    at = F.lit(percentile / 100.0) * (F.col("n") - 1)
    holds = lambda r: (F.col("__rank") >= r) & (F.col("__rank") - F.col("__times") < r)
    picked = join_on(ranked, counts, group).filter(holds(F.floor(at) + 1) | holds(F.ceil(at) + 1))
    fraction = F.lit(percentile / 100.0) * (F.col("n") - 1) - F.floor(F.lit(percentile / 100.0) * (F.col("n") - 1))
    return (
        picked.groupBy(*group, "n")
        .agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"))
        .select(*group, (F.col("__lo") * (1 - fraction) + F.col("__hi") * fraction).alias("value"), "n")
    )
