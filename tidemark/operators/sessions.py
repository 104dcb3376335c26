"""Session windows (WIN-3, WIN-4, WIN-7).

Two events of a key less than the gap apart are always in one session, so events are first reduced to cells of one
gap's width. Sessions are then runs of cells: the ordered scan sees at most (time range / gap) rows per key, however
many events the key has, and decomposable aggregates never shuffle raw events.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import runtime
from tidemark.functions.windows import SessionRule
from tidemark.operators.chain import FOLD_ROWS, greedy_chain
from tidemark.operators.joins import join_on
from tidemark.operators.slices import Running, running, with_slices


def cell(us: Column, rule: SessionRule) -> Column:
    """Start of the cell an event falls into."""
    return us - F.pmod(us, F.lit(rule.join_micros))


def session_cells(
    rows: DataFrame, keys: Sequence[str], us: str, rule: SessionRule, partials: Sequence[Column] = (), limit: int | None = None
) -> DataFrame:
    """One row per (keys, cell) with its session's start: ``__cell, __lo, __hi, __session`` and the partials.

    A key has at most as many cells as there are gaps between the first and the last event of the table. If that is more
    than ``limit``, cells are counted per key and a key with too many is scanned in slices: the end of the cell before a
    slice, and the session that is open there, come from one summary row per slice.
    """
    cells = rows.withColumn("__cell", cell(F.col(us), rule)).groupBy(*keys, "__cell")
    cells = cells.agg(F.min(us).alias("__lo"), F.max(us).alias("__hi"), *partials)
    if rule.max_micros is not None:
        # Kept, because sessions over the length limit ask for them again.
        cells = runtime.pin(cells)
        ends = cells.agg(F.min("__lo").alias("lo"), F.max("__hi").alias("hi")).first()
    else:
        ends = rows.agg(F.min(us).alias("lo"), F.max(us).alias("hi")).first()
    few = ends["lo"] is None or (ends["hi"] - ends["lo"]) // rule.join_micros + 2 <= (limit or runtime.HOT_GROUP_ROWS)
    if not few and rule.max_micros is None:
        cells = runtime.pin(cells)
    cut, piece = with_slices(cells, keys, "__cell", limit, bounded=few)
    cut = running(cut, keys, ["__cell"], piece, {"__before": Running("last", F.col("__hi"), inclusive=False)})
    silence = F.col("__lo") - F.col("__before")
    opens = F.when(silence.isNull() | (silence > F.lit(rule.join_micros)), F.col("__lo"))
    cut = running(cut, keys, ["__cell"], piece, {"__session": Running("last", opens)})
    return cut.drop("__before", *([piece] if piece else []))


@dataclass(frozen=True)
class SessionFacts:
    """What is known about sessions before they are cut: decides how much machinery the cut needs."""

    any_long: bool
    # No session that is too long holds more rows than the limit.
    bounded: bool
    # No session that is too long holds more rows than a single expression may collect.
    small: bool


def session_facts(sessions: DataFrame, rule: SessionRule, limit: int | None = None) -> SessionFacts:
    """Facts from pinned sessions ``__session, __last, __rows``: one small job, no pass over the events."""
    long = F.col("__last") - F.col("__session") > F.lit(rule.max_micros)
    most = sessions.agg(F.max(F.when(long, F.col("__rows"))).alias("rows")).first()["rows"]
    if most is None:
        return SessionFacts(False, True, True)
    return SessionFacts(True, most <= (limit or runtime.HOT_GROUP_ROWS), most <= min(FOLD_ROWS, limit or FOLD_ROWS))


def long_sessions(sessions: DataFrame, keys: Sequence[str], rule: SessionRule) -> DataFrame:
    """Sessions whose events span more than the maximum length."""
    return sessions.filter(F.col("__last") - F.col("__session") > F.lit(rule.max_micros)).select(*keys, "__session")


def sessionize(rows: DataFrame, keys: Sequence[str], us: str, rule: SessionRule, limit: int | None = None) -> DataFrame:
    """Add ``session_start`` (epoch microseconds) to every row."""
    keys = list(keys)
    group = [*keys, "__session"]
    cells = session_cells(rows, keys, us, rule, [F.count(F.lit(1)).alias("__rows")], limit)
    placed = join_on(
        rows.withColumn("__cell", cell(F.col(us), rule)), cells.select(*keys, "__cell", "__session"), [*keys, "__cell"]
    ).drop("__cell")
    if rule.max_micros is None:
        return placed.withColumnRenamed("__session", "session_start")
    sessions = runtime.pin(cells.groupBy(*group).agg(F.max("__hi").alias("__last"), F.sum("__rows").alias("__rows")))
    facts = session_facts(sessions, rule, limit)
    if not facts.any_long:
        return placed.withColumnRenamed("__session", "session_start")
    long = long_sessions(sessions, keys, rule)
    short_rows = join_on(placed, long, group, "left_anti").withColumn("session_start", F.col("__session"))
    long_rows = split_long(join_on(placed, long, group, "left_semi"), keys, us, rule, facts, limit)
    return short_rows.unionByName(long_rows).drop("__session")


def split_long(
    rows: DataFrame, keys: list[str], us: str, rule: SessionRule, facts: SessionFacts, limit: int | None = None
) -> DataFrame:
    """Cut long sessions: a new part begins at the first event later than the part's start plus the maximum (WIN-4)."""
    group = [*keys, "__session"]
    starts = greedy_chain(
        rows.select(*group, us).distinct(), group, us, rule.max_micros + 1, limit,
        bounded=facts.bounded, small=facts.small,
    )
    starts = starts.withColumn("__start", F.col(us))
    marked = join_on(rows, starts, [*group, us])
    cut, piece = with_slices(marked, group, us, limit, bounded=facts.bounded)
    # All rows at a start's instant carry the mark, so ties need no further order.
    out = running(cut, group, [us], piece, {"session_start": Running("last", F.col("__start"))})
    return out.drop("__start", *([piece] if piece else []))
