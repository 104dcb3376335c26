"""The ten window aggregates (AGG-1..10): computed from rows, or in parts that are merged later.

All results are DOUBLE. A row takes part when its value is not null, so filters are folded into the value column and
several features share one aggregation. The eight decomposable aggregates also have a partial form: it feeds panes of
sliding windows and cells of sessions, so only one row per pane or cell is shuffled, not one per event.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

DECOMPOSABLE = ("count", "sum", "avg", "min", "max", "stddev", "first_value", "last_value")
AGGREGATIONS = (*DECOMPOSABLE, "distinct_count", "percentile")


def from_rows(
    aggregation: str, v: Column, order: Column, distinct: Column | None = None, percentile: float = 95.0,
    approx: bool = False, streaming: bool = False,
) -> Column:
    """One aggregate over the rows whose value is not null."""
    if aggregation == "count":
        return F.count(v).cast("double")
    if aggregation == "sum":
        return F.sum(v)
    if aggregation == "avg":
        return F.avg(v)
    if aggregation == "min":
        return F.min(v)
    if aggregation == "max":
        return F.max(v)
    if aggregation == "stddev":
        # One row has no spread: 0, not null (AGG-8).
        return F.when(F.count(v) > 0, F.coalesce(F.stddev_samp(v), F.lit(0.0)))
    if aggregation == "first_value":
        return F.min_by(v, F.when(v.isNotNull(), order))
    if aggregation == "last_value":
        return F.max_by(v, F.when(v.isNotNull(), order))
    if aggregation == "distinct_count":
        if approx:
            return F.approx_count_distinct(distinct).cast("double")
        if streaming:
            return F.size(F.collect_set(distinct)).cast("double")
        return F.count_distinct(distinct).cast("double")
    if aggregation == "percentile":
        if approx:
            return F.percentile_approx(v, percentile / 100.0, 10_000).cast("double")
        return F.percentile(v, percentile / 100.0)
    raise ValueError(f"unknown aggregation: {aggregation}")


def partial(aggregation: str, v: Column, order: Column, name: str) -> list[Column]:
    """Partial state of a decomposable aggregate; columns are named after ``name``. The count is always kept."""
    n = F.count(v).alias(f"{name}_n")
    if aggregation == "count":
        return [n]
    if aggregation in ("sum", "avg"):
        return [n, F.sum(v).alias(f"{name}_s")]
    if aggregation in ("min", "max"):
        return [n, (F.min if aggregation == "min" else F.max)(v).alias(f"{name}_x")]
    if aggregation == "stddev":
        return [n, F.avg(v).alias(f"{name}_m"), (F.var_pop(v) * F.count(v)).alias(f"{name}_q")]
    key = F.when(v.isNotNull(), order)
    pick, edge = (F.min_by, F.min) if aggregation == "first_value" else (F.max_by, F.max)
    return [n, pick(v, key).alias(f"{name}_x"), edge(key).alias(f"{name}_o")]


def merge(aggregation: str, name: str) -> list[Column]:
    """Merge partial states: the value under ``name`` and the row count under ``name_c``."""
    n = F.sum(f"{name}_n")
    if aggregation == "count":
        out = n.cast("double")
    elif aggregation == "sum":
        out = F.sum(f"{name}_s")
    elif aggregation == "avg":
        out = F.sum(f"{name}_s") / F.when(n > 0, n)
    elif aggregation == "min":
        out = F.min(f"{name}_x")
    elif aggregation == "max":
        out = F.max(f"{name}_x")
    elif aggregation == "stddev":
        out = _merged_stddev(name)
    elif aggregation == "first_value":
        out = F.min_by(f"{name}_x", f"{name}_o")
    else:
        out = F.max_by(f"{name}_x", f"{name}_o")
    return [out.alias(name), n.alias(f"{name}_c")]


def window_mean(name: str, group: Sequence[str]) -> Column:
    """Mean over all parts of a window, added to each part under ``name_w`` before merging a standard deviation."""
    w = Window.partitionBy(*group)
    n, m = F.col(f"{name}_n"), F.coalesce(F.col(f"{name}_m"), F.lit(0.0))
    return (F.sum(n * m).over(w) / F.nullif(F.sum(n).over(w), F.lit(0))).alias(f"{name}_w")


def _merged_stddev(name: str) -> Column:
    """Squared deviations inside the parts plus those of the parts' means from the common mean.

    Sums of squares would cancel for values far from zero; nothing is collected, so a window may have any number of
    parts.
    """
    n = F.sum(f"{name}_n")
    apart = F.col(f"{name}_m") - F.col(f"{name}_w")
    squares = F.sum(F.col(f"{name}_q") + F.col(f"{name}_n") * apart * apart)
    return F.when(n >= 2, F.sqrt(squares / (n - 1))).when(n == 1, F.lit(0.0))
