"""Windows with a user's trigger on a stream.

A :class:`Trigger` is told of every row of a window (``on_element``), of its
own event-time timers (``on_timer``), of windows that merge (``on_merge``) and
of a window's end (``clear``), and answers whether the window's contents are
emitted, purged, both or neither.  It keeps named whole numbers for each
window and sets timers through the :class:`TriggerContext` it is given.
:class:`TriggeredWindow` is the one processor that hosts any trigger over any
assigner: it keeps contents, trigger state and timers in the state store.

A key's rows move its clock: before a row at ``t`` is added to its window, the
window's timers at or before ``t`` fire, so panes hold the rows before their
time however rows are cut into batches.  Timers without rows after them fire
when the watermark passes, and a window's end always waits for the watermark.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from eventide.streaming.processors import _ms, _ordered

CONTINUE, FIRE, PURGE, FIRE_AND_PURGE = 0, 1, 2, 3
FOREVER = 1 << 62           # end of a global window


class TriggerContext:
    """A trigger's view of one window: its bounds, the rows it holds, the
    watermark (0 before the first), whole numbers and timers of its own."""

    def __init__(self, window: "_Window", watermark: int):
        self._window, self.watermark = window, watermark

    @property
    def start(self) -> int:
        return self._window.start

    @property
    def end(self) -> int:
        return self._window.end

    @property
    def count(self) -> int:
        return self._window.cnt

    def get(self, name: str, default: int | None = None) -> int | None:
        return self._window.memory.get(name, default)

    def put(self, name: str, value: int | None) -> None:
        if value is None:
            self._window.memory.pop(name, None)
        else:
            self._window.memory[name] = int(value)

    def register_timer(self, at_ms: int) -> None:
        self._window.timers.add(int(at_ms))

    def delete_timer(self, at_ms: int) -> None:
        self._window.timers.discard(int(at_ms))


class Trigger:
    """Fires a window once, when the watermark passes its end.  Subclasses
    change any of the four answers."""

    def on_element(self, ctx: TriggerContext, row) -> int:
        return CONTINUE

    def on_timer(self, ctx: TriggerContext, at_ms: int) -> int:
        return FIRE_AND_PURGE if at_ms >= ctx.end else CONTINUE

    def on_merge(self, ctx: TriggerContext, merged: list[TriggerContext]) -> None:
        """``ctx`` is the new window, ``merged`` those it is made of; their
        numbers and timers are gone unless taken over here."""

    def clear(self, ctx: TriggerContext) -> None:
        """The window ends; its numbers and timers go with it."""


class EarlyFiring(Trigger):
    """After a window's first row fires on a grid of ``every_ms``, then a last
    time at its end."""

    def __init__(self, every_ms: int):
        self.every = every_ms

    def _next(self, ctx, after):
        at = (after // self.every + 1) * self.every
        if at < ctx.end:
            ctx.put("tick", at)
            ctx.register_timer(at)

    def on_element(self, ctx, row):
        if ctx.get("tick") is None:
            self._next(ctx, _ms(row.ts))
        return CONTINUE

    def on_timer(self, ctx, at_ms):
        if at_ms >= ctx.end:
            return FIRE_AND_PURGE
        self._next(ctx, at_ms)
        return FIRE

    def on_merge(self, ctx, merged):
        ticks = [m.get("tick") for m in merged if m.get("tick") is not None]
        if ticks:
            ctx.put("tick", min(ticks))
            ctx.register_timer(min(ticks))


class CountTrigger(Trigger):
    """Fires at every ``n``-th row of a window and purges what it fired."""

    def __init__(self, n: int):
        self.n = n

    def on_element(self, ctx, row):
        seen = ctx.get("seen", 0) + 1
        ctx.put("seen", seen % self.n)
        return FIRE_AND_PURGE if seen == self.n else CONTINUE

    def on_merge(self, ctx, merged):
        ctx.put("seen", sum(m.get("seen", 0) for m in merged) % self.n)


class DataDriven(Trigger):
    """Fires and purges at every row for which ``condition(row)`` holds."""

    def __init__(self, condition):
        self.condition = condition

    def on_element(self, ctx, row):
        return FIRE_AND_PURGE if self.condition(row) else CONTINUE


# ------------------------------------------------------------- assigners

class Tumbling:
    merging = False

    def __init__(self, size_ms: int):
        self.size = size_ms

    def window(self, t: int) -> tuple[int, int]:
        start = t // self.size * self.size
        return start, start + self.size


class Global:
    """One window for ever; only the trigger fires it."""
    merging = False

    def window(self, t: int) -> tuple[int, int]:
        return 0, FOREVER


class Sessions:
    """Rows at most ``gap_ms`` apart share a window; windows that meet merge."""
    merging = True

    def __init__(self, gap_ms: int):
        self.gap = gap_ms

    def window(self, t: int) -> tuple[int, int]:
        return t, t + self.gap


# -------------------------------------------------------------- the host

class _Window:
    """Contents, trigger numbers and timers of one window."""

    def __init__(self, start, end, cnt=0, total=0.0, fired=0, memory=None, timers=None):
        self.start, self.end, self.cnt, self.total, self.fired = start, end, cnt, total, fired
        self.memory, self.timers = memory or {}, set(timers or ())

    def packed(self):
        return self.end, self.cnt, self.total, self.fired, json.dumps([self.memory, sorted(self.timers)])

    @classmethod
    def unpacked(cls, start, value):
        end, cnt, total, fired, own = value
        return cls(start, end, cnt, total, fired, *json.loads(own))


_KEY = StructType([StructField("v", LongType())])
_HELD = StructType([StructField("end", LongType()), StructField("cnt", LongType()), StructField("total", DoubleType()),
                    StructField("fired", LongType()), StructField("own", StringType())])
_STARTS = StructType([StructField("starts", StringType())])


class TriggeredWindow(StatefulProcessor):
    """Count and sum of ``temperature`` per window and firing: ``at_ms`` is
    the time of the row or timer that fired, ``firing`` numbers a window's
    panes from 0.  Panes hold all rows since the last purge."""

    OUTPUT = ("id string, window_start_ms long, window_end_ms long, at_ms long, firing long, cnt long, sum_value double")

    def __init__(self, assigner, trigger: Trigger):
        self.assigner, self.trigger = assigner, trigger

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", _KEY, _HELD)
        self.due = handle.getMapState("due", _KEY, _STARTS)      # timer -> starts of the windows that wait for it

    # state -----------------------------------------------------------
    def _load(self, start) -> _Window | None:
        return _Window.unpacked(start, self.windows.getValue((start,))) if self.windows.containsKey((start,)) else None

    def _waiting(self, at) -> list[int]:
        return json.loads(self.due.getValue((at,))[0]) if self.due.containsKey((at,)) else []

    def _wait(self, at, start) -> None:
        starts = self._waiting(at)
        if not starts:
            self.handle.registerTimer(at)
        if start not in starts:
            self.due.updateValue((at,), (json.dumps([*starts, start]),))

    def _forget(self, at, start) -> None:
        starts = self._waiting(at)
        if starts == [start]:
            self.due.removeKey((at,))
            self.handle.deleteTimer(at)
        elif start in starts:
            starts.remove(start)
            self.due.updateValue((at,), (json.dumps(starts),))

    def _wanted(self, w: _Window) -> set[int]:
        return w.timers | ({w.end} if w.end < FOREVER else set())

    def _save(self, w: _Window, before: set[int]) -> None:
        """Store a window; its timers change from ``before`` to what it wants."""
        now = self._wanted(w)
        for at in before - now:
            self._forget(at, w.start)
        for at in now - before:
            self._wait(at, w.start)
        self.windows.updateValue((w.start,), w.packed())

    def _drop(self, w: _Window, before: set[int]) -> None:
        for at in before:
            self._forget(at, w.start)
        self.windows.removeKey((w.start,))

    # work ------------------------------------------------------------
    def _answer(self, kid, w: _Window, answer: int, at: int, out: list) -> None:
        if answer & FIRE and w.cnt:
            out.append(Row(id=kid, window_start_ms=w.start, window_end_ms=w.end, at_ms=at, firing=w.fired, cnt=w.cnt, sum_value=w.total))
            w.fired += 1
        if answer & PURGE:
            w.cnt, w.total = 0, 0.0

    def _advance(self, kid, w: _Window, upto: int, wm: int, out: list) -> None:
        """Fire the trigger's timers up to ``upto``, before the window's end."""
        while True:
            due = [t for t in w.timers if t <= upto and t < w.end]
            if not due:
                return
            at = min(due)
            w.timers.discard(at)
            self._answer(kid, w, self.trigger.on_timer(TriggerContext(w, wm), at), at, out)

    def _merged(self, start, end, wm) -> tuple[_Window, set[int]]:
        """The window that ``[start, end)`` belongs to, with the stored ones it meets."""
        met = [_Window.unpacked(k[0], v) for k, v in list(self.windows.iterator()) if k[0] <= end and start <= v[0]]
        if len(met) == 1 and met[0].start <= start and met[0].end >= end:
            return met[0], self._wanted(met[0])
        w = _Window(min([start, *[m.start for m in met]]), max([end, *[m.end for m in met]]),
                    sum(m.cnt for m in met), sum((m.total for m in met), 0.0), max((m.fired for m in met), default=0))
        if met:
            self.trigger.on_merge(TriggerContext(w, wm), [TriggerContext(m, wm) for m in met])
        for m in met:
            self._drop(m, self._wanted(m))
        return w, set()

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kid, wm, out = str(key[0]), max(timerValues.getCurrentWatermarkInMs(), 0), []
        for r in _ordered(rows):
            t = _ms(r.ts)
            start, end = self.assigner.window(t)
            if self.assigner.merging:
                w, before = self._merged(start, end, wm)
            else:
                w = self._load(start)
                before = self._wanted(w) if w else set()
                w = w or _Window(start, end)
            self._advance(kid, w, t, wm, out)
            w.cnt, w.total = w.cnt + 1, w.total + r.temperature
            self._answer(kid, w, self.trigger.on_element(TriggerContext(w, wm), r), t, out)
            self._save(w, before)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        kid, at, out = str(key[0]), expiredTimerInfo.getExpiryTimeInMs(), []
        wm, starts = max(timerValues.getCurrentWatermarkInMs(), 0), self._waiting(at)
        self.due.removeKey((at,)) if starts else None
        for start in starts:
            w = self._load(start)
            if w is None:
                continue
            before = self._wanted(w) - {at}
            if at < w.end:
                self._advance(kid, w, at, wm, out)
                self._save(w, before)
                continue
            self._advance(kid, w, at, wm, out)
            ctx = TriggerContext(w, wm)
            self._answer(kid, w, self.trigger.on_timer(ctx, at), at, out)
            self.trigger.clear(ctx)
            self._drop(w, before)
        return iter(out)

    def close(self) -> None:
        pass
