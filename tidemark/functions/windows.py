"""Window specifications as Columns and window predicates (WIN-1, WIN-2, WIN-5, WIN-6, WIN-9)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import interval, micros

DEFAULT_SESSION_GAP = 300.0
DEFAULT_MAX_SESSION = 3600.0


def tumbling(ts: Column, size_seconds: float, offset_seconds: float = 0.0) -> Column:
    """Fixed windows [start, start + size) aligned to the epoch plus an offset (WIN-1)."""
    return F.window(ts, interval(size_seconds), startTime=interval(offset_seconds % size_seconds))


def sliding_start(size_seconds: float, slide_seconds: float) -> float:
    """Alignment of sliding windows: their ends are multiples of the slide (WIN-2)."""
    size, slide = micros(size_seconds), micros(slide_seconds)
    return ((slide - size % slide) % slide) / 1e6


def sliding(ts: Column, size_seconds: float, slide_seconds: float) -> Column:
    """Overlapping windows; an event belongs to each window that contains it (WIN-2)."""
    if slide_seconds > size_seconds:
        raise ValueError("slide must not exceed the window size")
    return F.window(
        ts, interval(size_seconds), interval(slide_seconds), interval(sliding_start(size_seconds, slide_seconds))
    )


def pane_start(ts: Column, size_seconds: float, slide_seconds: float) -> Column:
    """Start of the pane of an event: panes are cut at the starts and ends of sliding windows, two per slide at most.

    A pane lies wholly in or out of every window, and a window holds the panes whose start it contains.
    """
    slide, cut = micros(slide_seconds), micros(sliding_start(size_seconds, slide_seconds))
    us = F.unix_micros(ts)
    within = F.pmod(us, F.lit(slide))
    return F.timestamp_micros(us - within + (F.when(within >= cut, F.lit(cut)).otherwise(F.lit(0)) if cut else 0))


@dataclass(frozen=True)
class SessionRule:
    """When a session continues and where it ends (WIN-3, WIN-4, D-4).

    ``gap``: silence of more than the gap closes the session. ``double_gap``: silence of twice the gap closes it.
    In both cases the session ends one gap after its last event. With ``gap`` it ends at most ``max_seconds`` after its
    start; ``double_gap`` has no such limit.
    """

    gap_seconds: float = DEFAULT_SESSION_GAP
    max_seconds: float | None = DEFAULT_MAX_SESSION
    rule: str = "gap"

    def __post_init__(self) -> None:
        if self.rule not in ("gap", "double_gap"):
            raise ValueError(f"unknown session rule: {self.rule}")
        if self.gap_seconds <= 0:
            raise ValueError("the session gap must be positive")
        if self.rule == "double_gap" and self.max_seconds is not None:
            raise ValueError("the double gap is a rule for sessions without a length limit")

    @property
    def gap_micros(self) -> int:
        return micros(self.gap_seconds)

    @property
    def join_micros(self) -> int:
        """The longest silence that does not close the session."""
        return self.gap_micros if self.rule == "gap" else 2 * self.gap_micros - 1

    @property
    def max_micros(self) -> int | None:
        return None if self.max_seconds is None else micros(self.max_seconds)

    def end(self, start: Column, last: Column) -> Column:
        """End of a session in epoch microseconds."""
        end = last + F.lit(self.gap_micros)
        return end if self.max_micros is None else F.least(end, start + F.lit(self.max_micros))


def is_ready(window_end: Column, watermark: Column) -> Column:
    """A window fires when the watermark reaches its end (WIN-5)."""
    return window_end <= watermark


def is_late_but_allowed(window_end: Column, watermark: Column, allowed_seconds: float) -> Column:
    """The window has fired but still takes late events (WIN-6)."""
    fired_for = F.unix_micros(watermark) - F.unix_micros(window_end)
    return (fired_for >= 0) & (fired_for < F.lit(micros(allowed_seconds)))


def is_expired(window_end: Column, cutoff: Column) -> Column:
    """State of windows that ended before the cutoff is discarded (WIN-9)."""
    return window_end < cutoff
