"""Greedy selection of points that keep a minimum distance.

Per key, the first point is selected, then always the first point at least ``distance`` after the last selected one.
This is the core of the non-overlapping frequency pattern (points are row numbers) and of the session length cap
(points are times). The selection is sequential by definition; three facts make it parallel:

* a point whose predecessor is at least ``distance`` away is always selected, so points fall into independent islands;
* within ``distance`` of an island's first point nothing else is selected;
* in what remains, an island with few points is folded in one expression and one with a bounded number is followed in
  one task; of a larger one each slice is followed on its own, and the slices are connected by repeatedly composing
  the table of their entries with itself (log2 of the number of slices rounds of equi-joins).
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import runtime
from tidemark.operators.joins import join_on
from tidemark.operators.slices import Running, hot_groups, running, with_slices

# Islands with at most this many undecided points are folded in a single expression.
FOLD_ROWS = 512


def greedy_chain(
    points: DataFrame, keys: Sequence[str], x: str, distance: int, limit: int | None = None, fold: int | None = None,
    bounded: bool = False, cheap: bool = False, small: bool = False,
) -> DataFrame:
    """Selected points as (keys, x). ``points`` holds distinct (keys, x) with an integral ``x``.

    ``bounded`` says that no key holds more than ``limit`` points, ``small`` that besides none holds more than ``fold``,
    ``cheap`` that the points come from a table that is already worked out. Islands are folded up to ``fold`` points.
    """
    keys, fold = list(keys), FOLD_ROWS if fold is None else fold
    points = points.select(*keys, x)
    if not (cheap or small):
        # Counted, split and folded: worked out once.
        points = runtime.pin(points)
    cut, piece = with_slices(points, keys, x, limit, bounded=bounded)
    here = F.col(x)
    seen = running(cut, keys, [x], piece, {"__prev": Running("last", here, inclusive=False)})
    head = F.col("__prev").isNull() | (here - F.col("__prev") >= F.lit(distance))
    seen = seen.withColumn("__head", F.when(head, here))
    seen = running(seen, keys, [x], piece, {"__island": Running("last", F.col("__head"))})
    heads = seen.filter(F.col("__head").isNotNull()).select(*keys, x)
    rest = seen.filter(here - F.col("__island") >= F.lit(distance)).select(*keys, "__island", x)

    group = [*keys, "__island"]
    big = None if small else hot_groups(rest, group, fold)
    small_rest = rest
    if big is not None:
        small_rest = join_on(rest, big.select(*group), group, "left_anti")
    picked = F.aggregate(
        F.array_sort(F.collect_list(x)),
        F.array(F.col("__island")),
        lambda acc, v: F.when(v - F.element_at(acc, -1) >= F.lit(distance), F.concat(acc, F.array(v))).otherwise(acc),
    )
    folded = small_rest.groupBy(*group).agg(picked.alias("__picked"))
    folded = folded.select(*keys, F.explode(F.slice("__picked", 2, fold + 1)).alias(x))
    selected = heads.unionByName(folded)
    if big is None:
        return selected
    rows = join_on(rest, big.select(*group), group, "left_semi")
    return selected.unionByName(_large(rows, keys, x, distance, limit, piece is None).select(*keys, x))


def _follow(xs: np.ndarray, first: int, distance: int) -> np.ndarray:
    """Points selected from sorted ``xs`` when the next one must be at or after ``first``."""
    picked, i = [], int(np.searchsorted(xs, first))
    while i < len(xs):
        picked.append(xs[i])
        i = int(np.searchsorted(xs, xs[i] + distance))
    return np.array(picked, dtype=np.int64)


def _exits(xs: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Points of a slice at which a selection coming from before it can enter, and where it leaves: (entries, asks).

    The point before an entry is less than ``distance`` from the slice's start. ``asks`` is the earliest place for the
    next selected point after the slice.
    """
    n = len(xs)
    nxt = np.searchsorted(xs, xs + distance)
    last = np.where(nxt < n, nxt, np.arange(n))
    while True:
        further = last[last]
        if np.array_equal(further, last):
            break
        last = further
    entries = int(np.searchsorted(xs, xs[0] + distance)) + 1
    return xs[:entries], xs[last[:entries]] + distance


def _large(rows: DataFrame, keys: list[str], x: str, distance: int, limit: int | None, bounded: bool) -> DataFrame:
    """Selected points of islands too large for an expression; the island's first point is left out.

    Each slice of an island holds a bounded number of points and is followed on its own. What connects slices is a
    table of possible entries and where they lead, which is solved by composing it with itself.
    """
    group = [*keys, "__island"]
    cut, piece = with_slices(rows, group, x, limit, bounded=bounded)
    types = {f.name: f.dataType for f in cut.schema.fields}
    out = T.StructType([T.StructField(c, types[c]) for c in [*group, x]])
    if piece is None:

        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            head = int(pdf["__island"].iloc[0])
            picked = _follow(np.sort(pdf[x].to_numpy(np.int64)), head + distance, distance)
            return _repeat(pdf, group, **{x: picked})

        return cut.groupBy(*group).applyInPandas(whole, out)

    cut = runtime.pin(cut)
    places = T.StructType([*[T.StructField(c, types[c]) for c in [*group, piece, x]], T.StructField("__ask", T.LongType())])

    def ways(pdf: pd.DataFrame) -> pd.DataFrame:
        entries, asks = _exits(np.sort(pdf[x].to_numpy(np.int64)), distance)
        return _repeat(pdf, [*group, piece], **{x: entries, "__ask": asks})

    doors = runtime.pin(cut.groupBy(*group, piece).applyInPandas(ways, places))
    heads = doors.select(*group).distinct().select(*group, F.col("__island").alias(x))
    asks = doors.select(*group, x, "__ask").unionByName(heads.withColumn("__ask", F.col(x) + F.lit(distance)))
    step = runtime.pin(_next_point(doors.select(*group, x), asks, group, x, limit).filter(F.col("next").isNotNull()))
    entered = _orbit(step, heads, group, x)
    entered = join_on(entered, doors.select(*group, x, piece), [*group, x], "inner")
    entered = entered.select(*group, piece, F.col(x).alias("__first"))

    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        picked = _follow(np.sort(pdf[x].to_numpy(np.int64)), int(pdf["__first"].iloc[0]), distance)
        return _repeat(pdf, group, **{x: picked})

    return join_on(cut, entered, [*group, piece], "inner").groupBy(*group, piece).applyInPandas(inside, out)


def _repeat(pdf: pd.DataFrame, columns: Sequence[str], **values: np.ndarray) -> pd.DataFrame:
    """A group's constant columns beside new values."""
    out = pd.DataFrame(values)
    for i, c in enumerate(columns):
        out.insert(i, c, pdf[c].iloc[0])
    return out


def _next_point(points: DataFrame, asks: DataFrame, group: list[str], x: str, limit: int | None) -> DataFrame:
    """(group, x, next): the first point at or after ``__ask``."""
    data = points.select(*group, F.col(x).alias("__at"), F.lit(1).alias("__data"), F.col(x).alias("__x"))
    wanted = asks.select(*group, F.col("__ask").alias("__at"), F.lit(0).alias("__data"), F.col(x).alias("__x"))
    both, piece = with_slices(data.unionByName(wanted), group, "__at", limit)
    found = running(
        both, group, ["__at", "__data"], piece,
        {"next": Running("last", F.when(F.col("__data") == 1, F.col("__x")))}, reverse=True,
    )
    return found.filter(F.col("__data") == 0).select(*group, F.col("__x").alias(x), "next")


def _orbit(step: DataFrame, heads: DataFrame, group: list[str], x: str) -> DataFrame:
    """Points reached from the heads by following ``step``; the heads themselves are left out."""
    levels = [step]
    while True:
        after = step.select(*group, F.col(x).alias("next"), F.col("next").alias("__then"))
        twice = join_on(step, after, [*group, "next"], "inner").select(*group, x, F.col("__then").alias("next"))
        # Only points reached in two steps, and the heads, can be asked for on the next level.
        reached = twice.select(*group, F.col("next").alias(x)).distinct()
        keep = join_on(twice, reached, [*group, x], "left_semi")
        keep = keep.unionByName(twice.filter(F.col(x) == F.col("__island")))
        step = runtime.pin(keep.distinct())
        if step.filter(F.col(x) == F.col("__island")).isEmpty():
            break
        levels.append(step)
    found = heads
    for level in reversed(levels):
        onward = join_on(level, found, [*group, x], "left_semi").select(*group, F.col("next").alias(x))
        found = runtime.pin(found.unionByName(onward).distinct())
    return found.filter(F.col(x) != F.col("__island"))
