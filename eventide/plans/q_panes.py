"""Trigger, evictor and late-data queries (TRG*, EVT1, LAT*, WMK1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, from_epoch_micros
from eventide.operators import late as L
from eventide.operators import panes as P
from eventide.operators.accumulate import Accumulator
from eventide.operators.windows import window_rows
from eventide.plans.catalog import register
from eventide.plans.common import events, r6
from eventide.session import scratch_path

H = 3_600_000_000  # one hour in microseconds


@register("early_firing", "TRG2 TRG3 TRG1", f"""
WITH r AS (SELECT user_id AS id, epoch_us(ts) AS t, value,
                  CAST(floor(epoch_us(ts) / {6 * H}) AS BIGINT) AS w FROM events),
win AS (SELECT id, w, min(t) AS t0, count(*) AS n, sum(value) AS s FROM r GROUP BY 1, 2),
ticks AS (SELECT id, w, unnest(generate_series(CAST((floor(t0 / {H}) + 1) * {H} AS BIGINT),
                                               (w + 1) * {6 * H} - {H}, {H})) AS tick FROM win)
SELECT k.id, make_timestamp((k.w + 1) * {6 * H}) AS window_end, make_timestamp(k.tick) AS pane_ts,
       count(*) AS cnt, round(sum(r.value), 6) AS sum_value, false AS is_final
FROM ticks k JOIN r ON r.id = k.id AND r.w = k.w AND r.t < k.tick
GROUP BY k.id, k.w, k.tick
UNION ALL
SELECT id, make_timestamp((w + 1) * {6 * H}), make_timestamp((w + 1) * {6 * H}), n,
       round(s, 6), true FROM win""")
def early_firing(spark, sf):
    """6 h windows per sensor firing every event-time hour with the count
    so far, then a final pane at the window end."""
    r = events(spark, sf)
    out = P.early_firing_counts(r, "id", "ts", "6 hours", "1 hour")
    return out.withColumn("sum_value", r6("sum_value"))


@register("trigger_on_purchase", "TRG5 WIN9 TRG3", """
WITH f AS (SELECT user_id AS id, ts, value, CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END AS fl,
                  event_id FROM events),
p AS (SELECT *, sum(fl) OVER (PARTITION BY id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) - fl
                AS pane FROM f)
SELECT id, CAST(pane AS BIGINT) AS pane, max(CASE WHEN fl = 1 THEN ts END) AS fire_ts,
       count(*) AS cnt, round(sum(value), 6) AS sum_temp
FROM p GROUP BY id, pane HAVING max(fl) = 1""")
def trigger_on_purchase(spark, sf):
    """Global window per user; a purchase fires and purges the pane."""
    r = events(spark, sf, keep=("event_type",))
    out = P.trigger_panes(r, "id", F.col("event_type") == "purchase",
                          [F.count(F.lit(1)).alias("cnt"), F.sum("temperature").alias("sum_temp")])
    return out.select("id", "pane", "fire_ts", "cnt", r6("sum_temp").alias("sum_temp"))


_WEND = f"make_timestamp(CAST((floor(epoch_us(ts) / {6 * H}) + 1) * {6 * H} AS BIGINT))"


@register("evict_count", "EVT1", f"""
WITH w AS (SELECT user_id AS id, {_WEND} AS window_end, value, ts, event_id FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY id, window_end ORDER BY ts DESC, event_id DESC) AS rn
      FROM w)
SELECT id, window_end, count(*) AS cnt, round(avg(value), 6) AS avg_temp FROM k WHERE rn <= 3
GROUP BY 1, 2""")
def evict_count(spark, sf):
    """Count evictor before the window function: average of the last 3
    readings of each 6 h window."""
    rows = window_rows(events(spark, sf), "ts", "6 hours")
    kept = P.evict_keep_last(rows, ["id", "window_end"], 3, ["ts", "seq"])
    out = kept.groupBy("id", "window_end").agg(F.count(F.lit(1)).alias("cnt"),
                                                F.avg("temperature").alias("avg_temp"))
    return out.withColumn("avg_temp", r6("avg_temp"))


@register("evict_time", "EVT1", f"""
WITH w AS (SELECT user_id AS id, {_WEND} AS window_end, value, ts FROM events),
m AS (SELECT *, max(ts) OVER (PARTITION BY id, window_end) AS newest FROM w)
SELECT id, window_end, count(*) AS cnt, max(value) AS max_temp FROM m
WHERE ts >= newest - INTERVAL 2 HOUR GROUP BY 1, 2""")
def evict_time(spark, sf):
    """Time evictor: only readings within 2 h of the window's newest."""
    rows = window_rows(events(spark, sf), "ts", "6 hours")
    kept = P.evict_older_than(rows, ["id", "window_end"], "ts", "2 hours")
    return kept.groupBy("id", "window_end").agg(F.count(F.lit(1)).alias("cnt"),
                                                 F.max("temperature").alias("max_temp"))


# Arrival order for the late-data replays: each event reaches the system up
# to two hours after its event time, deterministically per event_id.
_ARR_SQL = "ts + to_minutes(CAST((event_id * 37) % 120 AS BIGINT))"


def _arrivals(spark, sf):
    r = events(spark, sf, keep=("event_type",))
    lag_us = F.pmod(F.col("seq") * 37, F.lit(120)) * 60_000_000
    return r.withColumn("arrival", from_epoch_micros(epoch_micros("ts") + lag_us))


_WM_SQL = f"""
a AS (SELECT *, {_ARR_SQL} AS arrival FROM events),
m AS (SELECT *, max(ts) OVER (ORDER BY arrival, event_id
                              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 HOUR
                AS wm FROM a)"""


@register("evict_after", "EVT1", """
WITH r AS (SELECT user_id AS id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)
SELECT a.id, a.n AS window_seq, count(*) AS cnt, round(max(b.value), 6) AS max_temp
FROM r a JOIN r b ON a.id = b.id AND b.n > a.n - 8 AND b.n <= a.n
WHERE a.n % 5 = 0 GROUP BY 1, 2""")
def evict_after_q(spark, sf):
    """Every 5 rows of a sensor, the maximum of those and the 3 that the
    evictor left after the last firing."""
    out = P.evict_after(events(spark, sf), "id", 5, 3, [F.count(F.lit(1)).alias("cnt"), F.max("temperature").alias("mx")])
    return out.select("id", F.col("window_seq").cast("long").alias("window_seq"), "cnt", r6("mx").alias("max_temp"))


@register("late_rows", "LAT3 LAT1 WMK1 WMK3", f"""
WITH {_WM_SQL}
SELECT user_id AS id, event_id AS seq, ts, arrival, wm AS wm_before FROM m WHERE ts < wm""")
def late_rows(spark, sf):
    """Readings behind the watermark (max event time seen - 1 h) when they
    arrive: the late side output."""
    _, late = L.split_late(_arrivals(spark, sf), "ts", "arrival", "seq", "1 hour")
    return late.select("id", "seq", "ts", "arrival", "wm_before")


_FATE_SQL = f"""
WITH {_WM_SQL},
f AS (SELECT *, make_timestamp(CAST((floor(epoch_us(ts) / {H}) + 1) * {H} AS BIGINT)) AS window_end FROM m),
g AS (SELECT *, CASE WHEN wm IS NULL OR wm < window_end THEN 'on_time'
                     WHEN wm < window_end + INTERVAL 30 MINUTE THEN 'late_allowed'
                     ELSE 'dropped' END AS fate FROM f)"""


@register("late_window_counts", "LAT2 WIN1", f"""{_FATE_SQL}
SELECT event_type, window_end, count(*) AS cnt FROM g WHERE fate = 'on_time' GROUP BY 1, 2""")
def late_window_counts(spark, sf):
    """Main output of 1 h windows per event type: counts of on-time rows."""
    t = L.window_lateness(_arrivals(spark, sf), "event_type", "ts", "arrival", "seq", "1 hour", "1 hour")
    return (t.where(F.col("fate") == "on_time").groupBy("event_type", "window_end")
            .agg(F.count(F.lit(1)).alias("cnt")))


@register("late_side_output", "LAT2", f"""{_FATE_SQL}
SELECT event_type, window_end, event_id AS seq, ts FROM g WHERE fate <> 'on_time'""")
def late_side_output(spark, sf):
    """Rows that arrive after their 1 h window closed (side output)."""
    t = L.window_lateness(_arrivals(spark, sf), "event_type", "ts", "arrival", "seq", "1 hour", "1 hour")
    return t.where(F.col("fate") != "on_time").select("event_type", "window_end", "seq", "ts")


@register("allowed_lateness", "LAT4 LAT5", f"""{_FATE_SQL},
first AS (SELECT event_type, window_end, count(*) AS n0 FROM g WHERE fate = 'on_time' GROUP BY 1, 2),
late AS (SELECT event_type, window_end,
                row_number() OVER (PARTITION BY event_type, window_end ORDER BY arrival, event_id) AS k
         FROM g WHERE fate = 'late_allowed')
SELECT event_type, window_end, 0 AS firing, n0 AS cnt, 'first' AS kind FROM first
UNION ALL
SELECT l.event_type, l.window_end, CASE WHEN f.n0 IS NULL THEN l.k - 1 ELSE l.k END,
       coalesce(f.n0, 0) + l.k, CASE WHEN f.n0 IS NULL AND l.k = 1 THEN 'first' ELSE 'update' END
FROM late l LEFT JOIN first f ON f.event_type = l.event_type AND f.window_end = l.window_end""")
def allowed_lateness(spark, sf):
    """1 h windows per event type with 30 min allowed lateness: a first
    firing, then an update per late row inside the allowance."""
    t = L.window_lateness(_arrivals(spark, sf), "event_type", "ts", "arrival", "seq", "1 hour", "1 hour",
                          allowed="30 minutes")
    out = L.lateness_firings(t, "event_type", "arrival", "seq")
    return out.select("event_type", "window_end", F.col("firing").cast("int").alias("firing"),
                      F.col("cnt").cast("long").alias("cnt"), "kind")


@register("late_backfill", "LAT6", """
SELECT event_type, make_timestamp(CAST((floor(epoch_us(ts) / 3600000000) + 1) * 3600000000 AS BIGINT))
       AS window_end, count(*) AS cnt, max(value) AS max_value, round(sum(value) / count(value), 6) AS avg_value
FROM events GROUP BY 1, 2""")
def late_backfill(spark, sf):
    """Published 1 h states of on-time rows, with the states of late rows
    merged in by the back-fill: the result is that over all rows."""
    t = L.window_lateness(_arrivals(spark, sf), "event_type", "ts", "arrival", "seq", "1 hour", "1 hour")
    v = F.col("temperature")
    acc = Accumulator(
        add={"n": (F.lit(1), F.count), "values": (v, F.count), "sum": (v, F.sum), "high": (v, F.max)},
        result={"cnt": lambda s: s["n"], "max_value": lambda s: s["high"], "avg_value": lambda s: r6(s["sum"] / s["values"])})
    # both tables of states are written from one pass over the rows
    states = L.window_states(t, "event_type", acc)
    path = scratch_path(spark, "backfill-states")
    states.write.partitionBy("is_late").parquet(path)
    held = spark.read.schema(states.schema).parquet(path)
    fixed = L.backfill(held.where("NOT is_late"), held.where("is_late"), "event_type", acc)
    return acc.finish(fixed).drop("window_start")
