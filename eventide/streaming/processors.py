"""Per-key stateful stream operators on ``transformWithState``.

Each processor receives the rows of one key per micro-batch (sorted here by
``(ts, seq)``), keeps its state in the RocksDB state store and emits rows.
Event-time timers fire when the query's watermark passes them.
Input rows carry ``id, ts (timestamp), temperature, seq``; the tagged-union
processors also carry ``side`` (0 = control, 1 = data).
"""

from __future__ import annotations

from typing import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

_D = StructType([StructField("v", DoubleType())])
_L = StructType([StructField("v", LongType())])


def _ms(ts) -> int:
    import datetime as dt
    if isinstance(ts, dt.datetime):
        if ts.tzinfo is None:
            ts = ts.replace(tzinfo=dt.timezone.utc)
        return int(ts.timestamp() * 1000)
    return int(ts)


def _ordered(rows) -> list:
    out = []
    for r in rows:
        out.append(r)
    out.sort(key=lambda r: (r.ts, getattr(r, "side", 0), r.seq))
    return out


class JumpAlert(StatefulProcessor):
    """(id, prev_temp, temperature, seq) when the value moves more than
    ``threshold``; with ``ttl_ms`` the key's state is dropped by an
    event-time timer after that long without rows (self-cleaning)."""

    OUTPUT = "id string, prev_temp double, temperature double, seq long"

    def __init__(self, threshold: float = 10.0, ttl_ms: int | None = None):
        self.threshold = threshold
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _D)
        self.timer = handle.getValueState("timer", _L)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        for r in _ordered(rows):
            if self.ttl_ms is not None:
                if self.timer.exists():
                    old = self.timer.get()[0]
                    if old <= _ms(r.ts):  # expired within this batch
                        self.last.clear()
                    self.handle.deleteTimer(old)
                nt = _ms(r.ts) + self.ttl_ms
                self.handle.registerTimer(nt)
                self.timer.update((nt,))
            if self.last.exists():
                p = self.last.get()[0]
                if abs(r.temperature - p) > self.threshold:
                    out.append(Row(id=str(key[0]), prev_temp=p, temperature=r.temperature, seq=r.seq))
            self.last.update((r.temperature,))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.last.clear()
        self.timer.clear()
        return iter([])

    def close(self) -> None:
        pass


class RisingAlert(StatefulProcessor):
    """Alert ``interval_ms`` after a rise unless a falling row arrives
    first (event-time timer, deleted by the fall).  A timer due before a
    later row of the same batch fires inline, so the result does not depend
    on how rows are cut into batches."""

    OUTPUT = "id string, alert_ms long"

    def __init__(self, interval_ms: int, first_counts: bool = False):
        self.interval = interval_ms
        self.first_counts = first_counts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", _D)
        self.timer = handle.getValueState("timer", _L)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        for r in _ordered(rows):
            t = _ms(r.ts)
            if self.timer.exists() and self.timer.get()[0] <= t:
                due = self.timer.get()[0]
                out.append(Row(id=str(key[0]), alert_ms=due))
                self.handle.deleteTimer(due)
                self.timer.clear()
            if not self.last.exists() and not self.first_counts:
                self.last.update((r.temperature,))
                continue
            last = self.last.get()[0] if self.last.exists() else 0.0
            if r.temperature > last and not self.timer.exists():
                due = t + self.interval
                self.handle.registerTimer(due)
                self.timer.update((due,))
            elif r.temperature < last and self.timer.exists():
                self.handle.deleteTimer(self.timer.get()[0])
                self.timer.clear()
            self.last.update((r.temperature,))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        due = expiredTimerInfo.getExpiryTimeInMs()
        if self.timer.exists() and self.timer.get()[0] == due:
            self.timer.clear()
            return iter([Row(id=str(key[0]), alert_ms=due)])
        return iter([])

    def close(self) -> None:
        pass


class ThresholdAlert(StatefulProcessor):
    """Keyed control input (side 0) sets the key's threshold (0.0 deletes);
    data rows (side 1) alert on an absolute change above it.  The last value
    is updated only while a threshold exists."""

    OUTPUT = "id string, seq long, temperature double, threshold double, diff double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.thr = handle.getValueState("threshold", _D)
        self.last = handle.getValueState("last", _D)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        for r in _ordered(rows):
            if r.side == 0:
                if r.temperature == 0.0:
                    self.thr.clear()
                else:
                    self.thr.update((r.temperature,))
                continue
            if not self.thr.exists():
                continue
            thr = self.thr.get()[0]
            if self.last.exists():
                d = abs(r.temperature - self.last.get()[0])
                if d > thr:
                    out.append(Row(id=str(key[0]), seq=r.seq, temperature=r.temperature,
                                   threshold=thr, diff=round(d, 6)))
            self.last.update((r.temperature,))
        return iter(out)

    def close(self) -> None:
        pass


class SwitchFilter(StatefulProcessor):
    """Control rows (side 0, ``temperature`` = duration in ms) open
    forwarding until ts + duration (longest wins); data rows pass while
    open; an event-time timer closes it."""

    OUTPUT = "id string, seq long, ts timestamp, temperature double"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.until = handle.getValueState("until", _L)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        for r in _ordered(rows):
            t = _ms(r.ts)
            if self.until.exists() and self.until.get()[0] <= t:
                self.handle.deleteTimer(self.until.get()[0])
                self.until.clear()
            if r.side == 0:
                exp = t + int(r.temperature)
                cur = self.until.get()[0] if self.until.exists() else None
                if cur is None or exp > cur:
                    if cur is not None:
                        self.handle.deleteTimer(cur)
                    self.handle.registerTimer(exp)
                    self.until.update((exp,))
            elif self.until.exists():
                out.append(Row(id=str(key[0]), seq=r.seq, ts=r.ts, temperature=r.temperature))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.until.exists() and self.until.get()[0] == expiredTimerInfo.getExpiryTimeInMs():
            self.until.clear()
        return iter([])

    def close(self) -> None:
        pass


class CountWindow(StatefulProcessor):
    """Tumbling count window of ``size`` rows per key: buffers rows in list
    state and emits (id, window_seq, min, sum, last_ts_ms) per full window."""

    OUTPUT = "id string, window_seq long, min_temp double, sum_temp double, n long"

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.buf = handle.getListState("buf", _D)
        self.count = handle.getValueState("count", _L)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        n = self.count.get()[0] if self.count.exists() else 0
        vals = [v[0] for v in self.buf.get()] if self.buf.exists() else []
        for r in _ordered(rows):
            vals.append(r.temperature)
            n += 1
            if len(vals) == self.size:
                out.append(Row(id=str(key[0]), window_seq=n, min_temp=min(vals),
                               sum_temp=round(sum(vals), 6), n=len(vals)))
                vals = []
        self.count.update((n,))
        if vals:
            self.buf.put([(v,) for v in vals])
        else:
            self.buf.clear()
        return iter(out)

    def close(self) -> None:
        pass


class RollingMin(StatefulProcessor):
    """Exact per-row rolling reduce on a stream: (id, ts, running min,
    seq) for every input row, in event-time order within each batch."""

    OUTPUT = "id string, ts timestamp, temperature double, seq long"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.m = handle.getValueState("min", _D)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out = []
        cur = self.m.get()[0] if self.m.exists() else None
        for r in _ordered(rows):
            cur = r.temperature if cur is None else min(cur, r.temperature)
            out.append(Row(id=str(key[0]), ts=r.ts, temperature=cur, seq=r.seq))
        if cur is not None:
            self.m.update((cur,))
        return iter(out)

    def close(self) -> None:
        pass


def apply(stream: DataFrame, processor: StatefulProcessor, key: str = "id",
          time_mode: str = "EventTime") -> DataFrame:
    """``groupBy(key).transformWithState(processor)`` in append mode; with
    event time the input must be watermarked."""
    return stream.groupBy(key).transformWithState(processor, processor.OUTPUT, "Append", time_mode)




class WindowCountWithTotal(StatefulProcessor):
    """Window function with per-window and per-key global state: counts
    rows per tumbling window (map state keyed by window end), fires a
    window when the watermark passes its end (event-time timer), and keeps
    the key's running total over fired windows (value state)."""

    OUTPUT = "id string, window_end_ms long, cnt long, total long"

    def __init__(self, size_ms: int):
        self.size = size_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", _L, _L)
        self.total = handle.getValueState("total", _L)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in _ordered(rows):
            end = (_ms(r.ts) // self.size + 1) * self.size
            if self.counts.containsKey((end,)):
                self.counts.updateValue((end,), (self.counts.getValue((end,))[0] + 1,))
            else:
                self.counts.updateValue((end,), (1,))
                self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        if not self.counts.containsKey((end,)):
            return iter([])
        cnt = self.counts.getValue((end,))[0]
        self.counts.removeKey((end,))
        total = (self.total.get()[0] if self.total.exists() else 0) + cnt
        self.total.update((total,))
        return iter([Row(id=str(key[0]), window_end_ms=end, cnt=cnt, total=total)])

    def close(self) -> None:
        pass


_FIRED = StructType([StructField("cnt", LongType()), StructField("firings", LongType())])


class LateFirings(StatefulProcessor):
    """Tumbling-window counts under allowed lateness, with marks: ``first``
    when the watermark passes a window's end (or with its first row, if that
    is already late), ``update`` with every later row inside the allowance,
    and ``late`` (side output, with the row's ``seq``) beyond it.

    Lateness is by window end, while Spark drops rows below its watermark
    before a processor sees them.  So the stream's watermark is declared
    ``slack`` later than the delay (:func:`eventide.streaming.jobs.late_firings`
    does) and the clock here runs that much ahead of it: rows reach the side
    output however late, up to the slack.  State does not grow with it, a
    window's goes with its allowance."""

    OUTPUT = "id string, window_end_ms long, firing long, cnt long, kind string, seq long"

    def __init__(self, size_ms: int, allowed_ms: int, slack_ms: int = 3650 * 86_400_000):
        self.size, self.allowed, self.slack = size_ms, allowed_ms, slack_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", _L, _FIRED)

    def _first(self, key, end, cnt):
        self.windows.updateValue((end,), (cnt, 1))
        self.handle.registerTimer(end + self.allowed - self.slack)
        return Row(id=str(key[0]), window_end_ms=end, firing=0, cnt=cnt, kind="first", seq=None)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        mark = timerValues.getCurrentWatermarkInMs()
        clock = mark + self.slack if mark > 0 else None
        out = []
        for r in _ordered(rows):
            end = (_ms(r.ts) // self.size + 1) * self.size
            if clock is not None and clock >= end + self.allowed:
                out.append(Row(id=str(key[0]), window_end_ms=end, firing=None, cnt=None, kind="late", seq=r.seq))
                continue
            known = self.windows.containsKey((end,))
            cnt, firings = self.windows.getValue((end,)) if known else (0, 0)
            if clock is None or clock < end:
                self.windows.updateValue((end,), (cnt + 1, 0))
                if not known:
                    self.handle.registerTimer(end - self.slack)
                continue
            if known and not firings:        # its timer comes after this batch's rows
                out.append(self._first(key, end, cnt))
                firings = 1
            if not firings:
                out.append(self._first(key, end, 1))
                continue
            self.windows.updateValue((end,), (cnt + 1, firings + 1))
            out.append(Row(id=str(key[0]), window_end_ms=end, firing=firings, cnt=cnt + 1, kind="update", seq=None))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, out = expiredTimerInfo.getExpiryTimeInMs(), []
        closing, ending = at + self.slack, at + self.slack - self.allowed
        if self.windows.containsKey((closing,)):
            cnt, firings = self.windows.getValue((closing,))
            if not firings:
                out.append(self._first(key, closing, cnt))
        if self.windows.containsKey((ending,)) and self.windows.getValue((ending,))[1]:
            self.windows.removeKey((ending,))
        return iter(out)

    def close(self) -> None:
        pass


_PANE = StructType([StructField("cnt", LongType()), StructField("sum", DoubleType()),
                    StructField("tick", LongType())])


class EarlyFiringWindow(StatefulProcessor):
    """Tumbling windows with early results on an event-time grid (a trigger
    with its own state and timers).  After a window's first row it fires
    every ``every_ms`` with the rows so far (accumulating panes), then a
    final pane at the window end, after which its state is purged.

    A row at or past the next tick first emits that tick's pane (so panes
    hold exactly the rows before their tick, however rows are cut into
    batches); ticks in quiet periods fire from event-time timers."""

    OUTPUT = "id string, window_end_ms long, pane_ms long, cnt long, sum_value double, is_final boolean"

    def __init__(self, size_ms: int, every_ms: int):
        if size_ms % every_ms:
            raise ValueError("window size must be a multiple of the firing interval")
        self.size, self.every = size_ms, every_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.win = handle.getMapState("panes", _L, _PANE)

    def _advance(self, kid, end, cnt, total, tick, upto, out):
        """Emit the panes of every tick <= ``upto``; return the next tick."""
        while tick is not None and tick <= upto:
            out.append(Row(id=kid, window_end_ms=end, pane_ms=tick, cnt=cnt, sum_value=total,
                           is_final=False))
            self.handle.deleteTimer(tick)
            tick += self.every
            if tick >= end:
                tick = None
            else:
                self.handle.registerTimer(tick)
        return tick

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        out: list[Row] = []
        kid = str(key[0])
        for r in _ordered(rows):
            t = _ms(r.ts)
            end = (t // self.size + 1) * self.size
            if self.win.containsKey((end,)):
                cnt, total, tick = self.win.getValue((end,))
            else:
                cnt, total = 0, 0.0
                tick = (t // self.every + 1) * self.every
                if tick >= end:
                    tick = None
                else:
                    self.handle.registerTimer(tick)
                self.handle.registerTimer(end)
            tick = self._advance(kid, end, cnt, total, tick, t, out)
            self.win.updateValue((end,), (cnt + 1, total + r.temperature, tick))
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        out: list[Row] = []
        kid = str(key[0])
        at = expiredTimerInfo.getExpiryTimeInMs()
        if self.win.containsKey((at,)):  # window end: final pane, purge
            cnt, total, tick = self.win.getValue((at,))
            self._advance(kid, at, cnt, total, tick, at - 1, out)
            out.append(Row(id=kid, window_end_ms=at, pane_ms=at, cnt=cnt, sum_value=total, is_final=True))
            self.win.removeKey((at,))
            return iter(out)
        end = (at // self.size + 1) * self.size
        if self.win.containsKey((end,)):
            cnt, total, tick = self.win.getValue((end,))
            tick = self._advance(kid, end, cnt, total, tick, at, out)
            self.win.updateValue((end,), (cnt, total, tick))
        return iter(out)

    def close(self) -> None:
        pass


_PLACE = StructType([StructField("bucket", LongType()), StructField("n", LongType())])
_HELD = StructType([StructField("t", LongType()), StructField("seq", LongType()), StructField("v", DoubleType())])


class Buckets:
    """Rows of a key that wait, in buckets named by a number.  A row is put
    and taken by its bucket and its place there, so neither looks at rows of
    other buckets: the work for a row does not grow with the buffer."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.rows = handle.getMapState(name, _PLACE, _HELD)
        self.sizes = handle.getMapState(f"{name}-sizes", _L, _L)

    def put(self, bucket: int, t: int, seq: int, value: float) -> bool:
        """True for a bucket's first row: its one timer is to be set."""
        n = self.sizes.getValue((bucket,))[0] if self.sizes.containsKey((bucket,)) else 0
        self.rows.updateValue((bucket, n), (t, seq, value))
        self.sizes.updateValue((bucket,), (n + 1,))
        return n == 0

    def take(self, bucket: int) -> list[tuple]:
        """Rows ``(t, seq, value)`` of a bucket, sorted; it is empty then."""
        if not self.sizes.containsKey((bucket,)):
            return []
        out = []
        for n in range(self.sizes.getValue((bucket,))[0]):
            out.append(tuple(self.rows.getValue((bucket, n))))
            self.rows.removeKey((bucket, n))
        self.sizes.removeKey((bucket,))
        return sorted(out, key=lambda r: r[:2])


class EvictingWindow(StatefulProcessor):
    """Tumbling window with a count evictor before the window function:
    rows wait in the bucket of their window; when the watermark passes its
    end only the last ``keep_last`` rows are kept and averaged."""

    OUTPUT = "id string, window_end_ms long, cnt long, avg_temp double"

    def __init__(self, size_ms: int, keep_last: int):
        self.size, self.keep = size_ms, keep_last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = Buckets(handle, "buffer")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            end = (_ms(r.ts) // self.size + 1) * self.size
            if self.buf.put(end, _us(r.ts), r.seq, r.temperature):
                self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs()
        vals = [v for _, _, v in self.buf.take(at)[-self.keep:]]
        if not vals:
            return iter([])
        return iter([Row(id=str(key[0]), window_end_ms=at, cnt=len(vals), avg_temp=round(sum(vals) / len(vals), 6))])

    def close(self) -> None:
        pass


def _us(ts) -> int:
    import datetime as dt
    if ts.tzinfo is None:
        ts = ts.replace(tzinfo=dt.timezone.utc)
    return int(ts.timestamp()) * 1_000_000 + ts.microsecond


class EventTimeSorter(StatefulProcessor):
    """Release each key's rows in event-time order once the watermark has
    passed them.  Rows wait in buckets of ``bucket_ms``, each with one timer
    at its end that releases the bucket in order.  ``emit_no`` numbers the
    released rows of a key."""

    OUTPUT = "id string, ts timestamp, temperature double, seq long, emit_no long"

    def __init__(self, bucket_ms: int = 1000):
        self.width = bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = Buckets(handle, "buffer")
        self.emitted = handle.getValueState("emitted", _L)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        for r in rows:
            end = (_ms(r.ts) // self.width + 1) * self.width
            if self.buf.put(end, _us(r.ts), r.seq, r.temperature):
                self.handle.registerTimer(end)
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        import datetime as dt
        due = self.buf.take(expiredTimerInfo.getExpiryTimeInMs())
        n = self.emitted.get()[0] if self.emitted.exists() else 0
        out = []
        for t_us, seq, temp in due:
            n += 1
            ts = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=t_us)
            out.append(Row(id=str(key[0]), ts=ts, temperature=temp, seq=seq, emit_no=n))
        if due:
            self.emitted.update((n,))
        return iter(out)

    def close(self) -> None:
        pass
