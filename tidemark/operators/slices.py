"""Ordered scans that do not depend on how rows are spread over keys.

A running value per key needs the key's rows in order, and Spark puts one window partition into one task. When a
single key holds a large share of all rows that task becomes the job. Here a hot key's order axis is cut into slices
of bounded size: window functions run inside (key, slice), and what earlier slices contribute is computed from one
summary row per slice. Keys that are not hot keep a single slice, and if no key is hot no slicing takes place.

Slices are derived from exact counts, minima and maxima, so a recomputed task always sees the same slices.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import runtime
from tidemark.operators.joins import join_on

# A range with too many rows is cut into this many cells per slice wanted.
CELLS_PER_SLICE = 4


def _axis(df: DataFrame, order: str) -> Column:
    """The order column as a number."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(order).cast("timestamp"))
    return F.col(order)


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int | None = None) -> DataFrame | None:
    """Groups with more than ``limit`` rows and their row count ``n``, or None when there are none."""
    limit = limit or runtime.HOT_GROUP_ROWS
    return runtime.pin_if_any(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit))


def with_slices(
    df: DataFrame, keys: Sequence[str], order: str, limit: int | None = None, name: str = "__slice", bounded: bool = False
) -> tuple[DataFrame, str | None]:
    """Add a slice number that grows with ``order`` within each key.

    Returns the frame and the name of the slice column, or None when no key holds more than ``limit`` rows. Rows with
    an equal order value are always in the same slice. Rows must have a non-null order value. ``bounded`` says that the
    caller has already found no key to be hot, so the rows need not be counted again.
    """
    if bounded:
        return df, None
    limit = limit or runtime.HOT_GROUP_ROWS
    x = _axis(df, order)
    measures = [F.count(F.lit(1)).alias("__n"), F.min(x).alias("__lo"), F.max(x).alias("__hi")]
    nodes = df.groupBy(*keys).agg(*measures).filter(F.col("__n") > limit).withColumn("__path", F.lit([]).cast("array<bigint>"))
    levels: list[DataFrame] = []
    leaves: list[DataFrame] = []
    for depth in itertools.count():
        # Cells that are too full are cut into equal parts of their own range, again and again: a burst ends up in
        # cells as narrow as it needs.
        # A cell is left whole only if it holds a single order value, or values too close together to tell apart.
        cells = F.ceil(F.col("__n") / F.lit(limit)) * CELLS_PER_SLICE
        step = ((F.col("__hi") - F.col("__lo")) / cells).cast("double")
        too_full = (F.col("__n") > limit) & (F.col("__hi") > F.col("__lo")) & (F.col("__lo").cast("double") + step > F.col("__lo").cast("double"))
        split = runtime.pin_if_any(nodes.filter(too_full))
        if split is None:
            leaves.append(nodes.select(*keys, "__path"))
            break
        if levels:
            leaves.append(nodes.filter(~too_full).select(*keys, "__path"))
        levels.append(
            runtime.broadcast_if_small(split.select(*keys, "__path", F.col("__lo").alias("__from"), step.alias("__step")))
        )
        inside = _place(df, keys, x, levels).filter(F.size("__path") == depth + 1)
        nodes = runtime.pin(inside.groupBy(*keys, "__path").agg(*measures))
    if not levels:
        return df, None
    numbers = reduce(DataFrame.unionByName, leaves).withColumn(
        name, F.row_number().over(Window.partitionBy(*keys).orderBy("__path")).cast("bigint")
    )
    numbers = runtime.broadcast_if_small(runtime.pin(numbers))
    out = join_on(_place(df, keys, x, levels), numbers, [*keys, "__path"])
    return out.withColumn(name, F.coalesce(F.col(name), F.lit(0))).drop("__path"), name


def _place(df: DataFrame, keys: Sequence[str], x: Column, levels: Sequence[DataFrame]) -> DataFrame:
    """Rows with the path of cells they fall into; rows of keys that are not hot have an empty path."""
    placed = df.withColumn("__path", F.lit([]).cast("array<bigint>"))
    for level in levels:
        cell = F.floor((x - F.col("__from")) / F.col("__step")).cast("bigint")
        deeper = F.when(F.col("__step").isNotNull(), F.concat("__path", F.array(cell))).otherwise(F.col("__path"))
        placed = join_on(placed, level, [*keys, "__path"]).withColumn("__path", deeper).drop("__from", "__step")
    return placed


@dataclass(frozen=True)
class Running:
    """A running value: ``sum``, ``min``, ``max`` or ``last`` (most recent non-null) of a column."""

    kind: Literal["sum", "min", "max", "last"]
    column: Column
    inclusive: bool = True


def _aggregate(kind: str, c: Column) -> Column:
    if kind == "sum":
        return F.sum(c)
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    return F.last(c, ignorenulls=True)


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    slice_col: str | None,
    values: Mapping[str, Running],
    reverse: bool = False,
) -> DataFrame:
    """Add running values per key in ``order`` (or in the reverse order), across slices if there are any.

    ``keys`` may be finer than the keys the slices were made for. In reverse, ``last`` of the rows before is the next
    row's value, which serves as ``lead`` without a frame that ends in unbounded following.
    """
    direction = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    parts = [*keys, slice_col] if slice_col else list(keys)
    base = Window.partitionBy(*parts).orderBy(*direction)
    upto = {True: base.rowsBetween(Window.unboundedPreceding, 0), False: base.rowsBetween(Window.unboundedPreceding, -1)}
    local = df.select(
        "*", *[_aggregate(r.kind, r.column).over(upto[r.inclusive]).alias(n) for n, r in values.items()]
    )
    if slice_col is None:
        return local

    position = F.struct(*[F.col(c) for c in order])
    pick = F.min_by if reverse else F.max_by
    totals = []
    for n, r in values.items():
        whole = (
            pick(r.column, F.when(r.column.isNotNull(), position))
            if r.kind == "last"
            else _aggregate(r.kind, r.column)
        )
        totals.append(whole.alias(f"__t_{n}"))
    summary = df.groupBy(*parts).agg(*totals)
    by_slice = F.col(slice_col).desc() if reverse else F.col(slice_col).asc()
    before = Window.partitionBy(*keys).orderBy(by_slice).rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *parts, *[_aggregate(r.kind, F.col(f"__t_{n}")).over(before).alias(f"__c_{n}") for n, r in values.items()]
    )
    out = join_on(local, carry, parts)
    for n, r in values.items():
        here, past = F.col(n), F.col(f"__c_{n}")
        if r.kind == "sum":
            both = F.when(here.isNotNull() | past.isNotNull(), F.coalesce(here, F.lit(0)) + F.coalesce(past, F.lit(0)))
        elif r.kind == "last":
            both = F.coalesce(here, past)
        else:
            both = (F.least if r.kind == "min" else F.greatest)(here, past)
        out = out.withColumn(n, both)
    return out.drop(*[f"__c_{n}" for n in values])


def lag_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], number: str, column: str, n: int, name: str,
    sliced: bool, chunk: int | None = None,
) -> DataFrame:
    """The value of ``column`` ``n`` rows earlier within the key.

    ``number`` is the row's gap-free number within the key. When some key is hot, rows are regrouped into chunks of
    consecutive numbers, and the last ``n`` rows of a chunk are also given to the next one as context.
    """
    if n == 0:
        return df.withColumn(name, F.col(column))
    if not sliced:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.lag(column, n).over(w))
    size = max(chunk or runtime.HOT_GROUP_ROWS, 2 * n)
    own = F.floor((F.col(number) - 1) / size).cast("bigint")
    needed_later = (F.col(number) - 1) % size >= size - n
    homes = F.when(needed_later, F.array(own, own + 1)).otherwise(F.array(own))
    spread = df.withColumn("__own", own).withColumn("__chunk", F.explode(homes))
    w = Window.partitionBy(*keys, "__chunk").orderBy(number)
    return (
        spread.withColumn(name, F.lag(column, n).over(w))
        .filter(F.col("__own") == F.col("__chunk"))
        .drop("__own", "__chunk")
    )
