"""Events of a key in time order on streams: rows wait in state until the watermark has passed them.

Micro-batches bring events out of order. They wait in state and are applied in (time, arrival) order when the watermark
says that nothing earlier can come any more. What waits is what arrived within the watermark's delay, so it is bounded by
the delay and the source's rate.

State belongs to buckets of keys, not to single keys: a call to the state store costs far more than a step of a state
machine, so calls are made per bucket and per piece of waiting events, however many keys there are. A bucket has one
timer. Waiting events are pieces of limited size, each over a short time, of which those are read that have become due;
what keys keep is in a few slots of the bucket, of which those are written that have changed.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator, Sequence
from itertools import groupby
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

# Fixed, as a checkpoint's state is laid out by them.
BUCKETS = 1024
SLOTS = 16
# Waiting events of one state row, and rows of one output frame.
PIECE_ROWS = 8192


def bucket() -> Column:
    """The bucket of a row's key, to group by."""
    return F.pmod(F.xxhash64("entity_id"), F.lit(BUCKETS)).cast("int").alias("bucket")


def plain(value: Any) -> Any:
    """A value as state takes it: numpy scalars and arrays become Python's, missing numbers None."""
    if hasattr(value, "tolist"):
        value = value.tolist()
    if isinstance(value, list):
        return [None if x is None or x != x else x for x in value]
    return None if isinstance(value, float) and value != value else value


class OrderedProcessor(StatefulProcessor):
    """Subclasses say what an event does to what its key keeps, and until when that is valid.

    Rows are grouped by ``bucket``. ``fields`` are the columns of an event besides ``entity_id``; the first two are its
    time in microseconds and its arrival order.
    """

    def __init__(self, fields: Sequence[str]) -> None:
        self.names = ["entity_id", *fields]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "low bigint, part bigint", "events binary")
        self.kept = handle.getMapState("kept", "slot int", "due bigint, keys binary")

    def close(self) -> None:
        pass

    def advance(self, key: str, kept: Any, events: list[tuple], until_us: int) -> tuple[list[dict[str, Any]], Any, int | None]:
        """Apply a key's events in order to what it keeps (None: nothing), then what falls due up to ``until_us``.

        Returns the output rows, what is kept now and the time at which that falls due, None if nothing is kept.
        """
        raise NotImplementedError

    def frame(self, rows: list[dict[str, Any]]) -> pd.DataFrame:
        raise NotImplementedError

    def _arm(self, *times_us: int | None) -> None:
        """One timer for the earliest of some times."""
        times = [t for t in times_us if t is not None]
        armed = list(self.handle.listTimers())
        if times:
            # A timer fires when the watermark is beyond it.
            at = min(times) // 1000 - 1
            if armed and min(armed) <= at:
                return
            self.handle.registerTimer(at)
        for t in armed:
            self.handle.deleteTimer(t)

    def _wait(self, events: list[tuple]) -> int | None:
        """Put events into state, in pieces of consecutive times; returns the earliest time."""
        events.sort(key=lambda e: e[1])
        for i in range(0, len(events), PIECE_ROWS):
            piece, part = events[i : i + PIECE_ROWS], 0
            while self.waiting.containsKey((piece[0][1], part)):
                part += 1
            self.waiting.updateValue((piece[0][1], part), (pickle.dumps(piece),))
        return events[0][1] if events else None

    def _take(self, until_us: int) -> tuple[list[tuple], int | None]:
        """Remove the waiting events up to a time from state; returns them and the earliest time that is left."""
        ready: list[tuple] = []
        later: list[tuple] = []
        lows: list[int] = []
        for low, part in [(int(k[0]), int(k[1])) for k in self.waiting.keys()] if self.waiting.exists() else ():
            if low > until_us:
                lows.append(low)
                continue
            for e in pickle.loads(self.waiting.getValue((low, part))[0]):
                (ready if e[1] <= until_us else later).append(e)
            self.waiting.removeKey((low, part))
        if later:
            lows.append(self._wait(later))
        return ready, min(lows, default=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        times: list[int | None] = []
        events: list[tuple] = []
        for batch in rows:
            columns = [c.tolist() if c.dtype.kind == "i" else [plain(v) for v in c] for c in (batch[n] for n in self.names)]
            events.extend(zip(*columns, strict=True))
            if len(events) >= PIECE_ROWS:
                times.append(self._wait(events))
                events = []
        times.append(self._wait(events))
        self._arm(*times)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        until = timerValues.getCurrentWatermarkInMs() * 1000
        ready, first = self._take(until)
        ready.sort(key=lambda e: (e[0], e[1], e[2] is not None, e[2]))
        slots: dict[int, dict[str, list[tuple]]] = {}
        for name, own in groupby(ready, key=lambda e: e[0]):
            slots.setdefault(zlib.crc32(name.encode()) % SLOTS, {})[name] = [e[1:] for e in own]
        before = {int(k[0]): v for k, v in self.kept.iterator()} if self.kept.exists() else {}
        dues = [int(v[0]) for slot, v in before.items() if slot not in slots and v[0] > until]
        out: list[dict[str, Any]] = []
        for slot in sorted(slots.keys() | {s for s, v in before.items() if v[0] <= until}):
            keys = pickle.loads(before[slot][1]) if slot in before else {}
            own = slots.get(slot, {})
            for name in sorted(own.keys() | {n for n, (due, _) in keys.items() if due <= until}):
                rows, kept, due = self.advance(name, keys.pop(name, (None, None))[1], own.get(name, []), until)
                if due is not None:
                    keys[name] = (due, kept)
                out.extend(rows)
                if len(out) >= PIECE_ROWS:
                    yield self.frame(out)
                    out = []
            if keys:
                dues.append(min(due for due, _ in keys.values()))
                self.kept.updateValue((slot,), (dues[-1], pickle.dumps(keys)))
            elif slot in before:
                self.kept.removeKey((slot,))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self._arm(first, *dues)
        if out:
            yield self.frame(out)
