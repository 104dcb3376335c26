"""Plain-Python replays of the rules, used as oracles on small inputs."""

from __future__ import annotations

from collections import defaultdict


def by_key(events):
    """{user: [(ts, seq, type)]} in (ts, seq) order."""
    keys = defaultdict(list)
    for seq, user, kind, ts in events:
        keys[user].append((ts, seq, kind))
    return {k: sorted(v) for k, v in keys.items()}


def sequence(events, types, window):
    found = []
    for user, rows in by_key(events).items():
        partial = []
        for ts, seq, kind in rows:
            if kind == types[0]:
                partial = [(ts, seq)]
            elif partial and kind == types[len(partial)]:
                if ts - partial[0][0] > window:
                    partial = []
                    continue
                partial.append((ts, seq))
                if len(partial) == len(types):
                    found.append((user, ts, tuple(s for _, s in partial)))
                    partial = []
    return sorted(found)


def absence(events, trigger, completing, window, watermark):
    found = []
    for user, rows in by_key(events).items():
        pending = None
        for ts, seq, kind in rows:
            if pending and ts > pending[0] + window:
                found.append((user, pending[0] + window, (pending[1],)))
                pending = None
            if kind == trigger:
                pending = (ts, seq)
            elif kind == completing:
                pending = None
        if pending:
            found.append((user, pending[0] + window, (pending[1],)))
    return sorted(f for f in found if f[1] <= watermark)


def frequency(events, types, n, window):
    found = []
    for user, rows in by_key(events).items():
        kept = []
        for ts, seq, kind in rows:
            if kind not in types:
                continue
            kept = [k for k in kept if k[0] >= ts - window] + [(ts, seq)]
            if len(kept) >= n:
                found.append((user, ts, tuple(s for _, s in kept)))
                kept = []
    return sorted(found)


def sessions(events, gap, longest=None):
    """(user, start, end, count); silence of more than the gap, or the length limit, ends a session."""
    out = []
    for user, rows in by_key(events).items():
        start = last = None
        n = 0
        for ts, _, _ in rows:
            if start is not None and ts <= last + gap and (longest is None or ts <= start + longest):
                last, n = ts, n + 1
                continue
            if start is not None:
                out.append((user, start, last, n))
            start, last, n = ts, ts, 1
        if start is not None:
            out.append((user, start, last, n))
    end = lambda s, e: e + gap if longest is None else min(e + gap, s + longest)
    return sorted((u, s, end(s, e), n) for u, s, e, n in out)


def lateness(arrivals, delay, allowed):
    """Per event id: (late, dropped), from (id, ts) in arrival order."""
    wm, out = 0.0, {}
    for i, ts in arrivals:
        wm = max(wm, ts - delay)
        out[i] = (ts < wm, wm - ts > allowed)
    return out


def chain(points, distance):
    out = []
    for p in sorted(points):
        if not out or p - out[-1] >= distance:
            out.append(p)
    return out
