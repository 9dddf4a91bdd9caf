"""User triggers hosted by one processor: stream = batch; bucketed buffers."""

import datetime as dt
import random
from types import SimpleNamespace

from pyspark.sql import functions as F

from eventide.operators import panes as B, windows as W
from eventide.streaming import processors as P, triggers as T
from eventide.streaming.sources import readings_stream
from test_streaming import _readings, _rows, _run, _stage, _with_marker

HOUR = 3600 * 1000


def _panes(spark, name, assigner, trigger, files=4):
    r = _readings(spark)
    folder = _stage(spark, _with_marker(spark, r), files)
    s = readings_stream(spark, folder, r.schema).withWatermark("ts", "0 seconds")
    got = _run(P.apply(s, T.TriggeredWindow(assigner, trigger)), name).where(F.col("id") != "__end__")
    def at(c):
        return F.timestamp_millis(c).cast("timestamp_ntz")
    return r, got.select("id", at("window_start_ms").alias("window_start"),
                         F.when(F.col("window_end_ms") < T.FOREVER, at("window_end_ms")).alias("window_end"),
                         at("at_ms").alias("pane_ts"), "at_ms", "window_end_ms", "firing", "cnt", F.round("sum_value", 6).alias("sum_value"))


def test_early_firing_policy_equals_batch(spark):
    r, got = _panes(spark, "t_early", T.Tumbling(6 * HOUR), T.EarlyFiring(HOUR), files=5)
    got = got.withColumn("is_final", F.col("at_ms") == F.col("window_end_ms"))
    want = B.early_firing_counts(r, "id", "ts", "6 hours", "1 hour").withColumn("sum_value", F.round("sum_value", 6))
    cols = ["id", "window_end", "pane_ts", "cnt", "sum_value", "is_final"]
    assert _rows(got, cols) == _rows(want, cols)
    first = got.groupBy("id", "window_end").agg(F.min("firing").alias("lo"), F.max("firing").alias("hi"), F.count("*").alias("n"))
    assert first.where("lo <> 0 OR hi <> n - 1").count() == 0


def test_count_policy_equals_batch(spark):
    r, got = _panes(spark, "t_count", T.Global(), T.CountTrigger(3))
    want = W.count_windows(r, "id", 3, [F.count(F.lit(1)).alias("cnt"), F.round(F.sum("temperature"), 6).alias("sum_value")])
    cols = ["id", "cnt", "sum_value"]
    assert _rows(got, cols) == _rows(want, cols) and got.where("cnt <> 3").count() == 0


def test_data_driven_policy_equals_batch(spark):
    r = _readings(spark)
    limit = r.agg(F.percentile_approx("temperature", 0.7)).first()[0]
    _, got = _panes(spark, "t_data", T.Global(), T.DataDriven(lambda row: row.temperature > limit))
    want = B.trigger_panes(r, "id", F.col("temperature") > limit, [F.count(F.lit(1)).alias("cnt"), F.round(F.sum("temperature"), 6).alias("sum_value")])
    cols = ["id", "cnt", "sum_value"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() > 100
    assert _rows(got.withColumnRenamed("firing", "pane"), ["id", "pane"]) == _rows(want, ["id", "pane"])


def test_merging_windows_equal_batch_sessions(spark):
    r, got = _panes(spark, "t_sessions", T.Sessions(48 * HOUR), T.Trigger())
    # stored times are milliseconds
    ms = r.withColumn("ts", F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp"))).cast("timestamp_ntz"))
    want = W.sessions(ms, "id", "ts", "48 hours", [F.count(F.lit(1)).alias("cnt"), F.round(F.sum("temperature"), 6).alias("sum_value")])
    cols = ["id", "window_start", "window_end", "cnt", "sum_value"]
    assert _rows(got, cols) == _rows(want, cols) and got.count() < r.count()


# ------------------------------------------- a state store that counts its work

class _Map:
    def __init__(self, work):
        self.held, self.work = {}, work

    def containsKey(self, k):
        self.work["ops"] += 1
        return k in self.held

    def getValue(self, k):
        self.work["ops"] += 1
        return self.held[k]

    def updateValue(self, k, v):
        self.work["ops"] += 1
        self.held[k] = v

    def removeKey(self, k):
        self.work["ops"] += 1
        self.held.pop(k, None)

    def iterator(self):
        for kv in sorted(self.held.items()):
            self.work["ops"] += 1
            yield kv


class _Value:
    def __init__(self, work):
        self.v, self.work = None, work

    def exists(self):
        return self.v is not None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v


class _Handle:
    def __init__(self):
        self.work, self.timers, self.maps = {"ops": 0}, set(), {}

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _Map(self.work))

    def getValueState(self, name, *_):
        return self.maps.setdefault(name, _Value(self.work))

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)


def _row(t_ms, seq, temperature=1.0):
    ts = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(milliseconds=t_ms)
    return SimpleNamespace(ts=ts, seq=seq, temperature=temperature)


def _clock(wm):
    return SimpleNamespace(getCurrentWatermarkInMs=lambda: wm, getCurrentProcessingTimeInMs=lambda: wm)


def _pass(p, handle, wm):
    """All timers the watermark has passed, in order."""
    out = []
    while handle.timers and min(handle.timers) <= wm:
        at = min(handle.timers)
        handle.timers.discard(at)
        out += p.handleExpiredTimer(("k",), _clock(wm), SimpleNamespace(getExpiryTimeInMs=lambda: at))
    return out


def _work_per_released_row(processor, waiting):
    """State operations to release 100 rows while ``waiting`` others wait."""
    h = _Handle()
    processor.init(h)
    rng = random.Random(waiting)
    rows = [_row(rng.randrange(100_000), k) for k in range(100)] + [_row(10**9 + 1000 * k, 1000 + k) for k in range(waiting)]
    rng.shuffle(rows)
    list(processor.handleInputRows(("k",), iter(rows), _clock(0)))
    h.work["ops"] = 0
    out = _pass(processor, h, 10**8)
    return h.work["ops"], out


def test_release_does_not_grow_with_the_buffer():
    few, out = _work_per_released_row(P.EventTimeSorter(5000), 10)
    many, again = _work_per_released_row(P.EventTimeSorter(5000), 20_000)
    assert few < 6 * 100 and abs(many - few) < 100
    for rows in (out, again):
        assert len(rows) == 100 and [r.emit_no for r in rows] == list(range(1, 101))
        assert [(r.ts, r.seq) for r in rows] == sorted((r.ts, r.seq) for r in rows)
    few, out = _work_per_released_row(P.EvictingWindow(10_000, 3), 10)
    many, _ = _work_per_released_row(P.EvictingWindow(10_000, 3), 20_000)
    assert abs(many - few) < 100 and max(r.cnt for r in out) == 3


def test_one_timer_for_each_bucket():
    h, p = _Handle(), P.EventTimeSorter(1000)
    p.init(h)
    list(p.handleInputRows(("k",), iter([_row(k % 3000, k) for k in range(900)]), _clock(0)))
    assert h.timers == {1000, 2000, 3000} or h.timers == {1000}


def test_policy_sees_merges_timers_and_the_end():
    """A trigger with state of its own: fires when the gap between two of a
    session's rows was long, forgets nothing when sessions merge."""
    seen = []

    class Slow(T.Trigger):
        def on_element(self, ctx, row):
            ctx.put("rows", ctx.get("rows", 0) + 1)
            ctx.register_timer(ctx.end - 10)
            return T.CONTINUE

        def on_timer(self, ctx, at_ms):
            seen.append(("timer", at_ms, ctx.get("rows")))
            return super().on_timer(ctx, at_ms) if at_ms >= ctx.end else T.FIRE

        def on_merge(self, ctx, merged):
            ctx.put("rows", sum(m.get("rows", 0) for m in merged))
            seen.append(("merge", len(merged)))

        def clear(self, ctx):
            seen.append(("clear", ctx.start, ctx.end))

    h, p = _Handle(), T.TriggeredWindow(T.Sessions(100), Slow())
    p.init(h)
    out = []
    for batch in ([_row(0, 1), _row(200, 2)], [_row(100, 3)], [_row(320, 4)]):
        out += p.handleInputRows(("k",), iter(batch), _clock(0))
    assert ("merge", 2) in seen and out == []
    out = _pass(p, h, 1000)
    assert [(r.window_start_ms, r.window_end_ms, r.at_ms, r.cnt) for r in out] == [(0, 300, 290, 3), (0, 300, 300, 3), (320, 420, 410, 1), (320, 420, 420, 1)]
    assert [s for s in seen if s[0] == "clear"] == [("clear", 0, 300), ("clear", 320, 420)]
    assert not h.timers and not h.maps["windows"].held and not h.maps["due"].held


def test_panes_do_not_depend_on_batches():
    rows = [_row(k * 37 % 5000, k, float(k)) for k in range(300)]
    rows.sort(key=lambda r: r.ts)
    def run(cut):
        h, p, out = _Handle(), T.TriggeredWindow(T.Tumbling(1000), T.EarlyFiring(250)), []
        p.init(h)
        for at in range(0, len(rows), cut):
            out += p.handleInputRows(("k",), iter(rows[at:at + cut]), _clock(0))
        return sorted(tuple(r) for r in [*out, *_pass(p, h, 10**6)])
    assert run(300) == run(1) == run(17) and len(run(7)) == 5 * 4
