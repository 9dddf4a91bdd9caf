"""Window queries (WIN*, WFN*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, f_to_c, from_epoch_micros
from eventide.operators import windows as W
from eventide.operators.fold import Fold, window_fold
from eventide.plans.catalog import register
from eventide.plans.common import events, r6, table

HOUR = 3600


def _end_sql(size_s: int, offset_s: int = 0) -> str:
    return (f"make_timestamp(CAST(((floor((epoch(ts) - {offset_s}) / {size_s}) + 1) * {size_s} "
            f"+ {offset_s}) * 1000000 AS BIGINT))")


def _start_sql(size_s: int, offset_s: int = 0) -> str:
    return (f"make_timestamp(CAST((floor((epoch(ts) - {offset_s}) / {size_s}) * {size_s} "
            f"+ {offset_s}) * 1000000 AS BIGINT))")


@register("win_tumbling_avg", "WIN1 WFN4 PRJ3 TIM1", f"""
SELECT user_id AS id, {_end_sql(6 * HOUR)} AS window_end,
       round(avg((value - 32) * (5.0 / 9.0)), 6) AS avg_temp_c
FROM events GROUP BY 1, 2""")
def win_tumbling_avg(spark, sf):
    """Flagship: per-sensor average Celsius temperature per 6 h tumbling
    window, stamped with the window end."""
    r = events(spark, sf)
    out = W.window_agg(r, "id", "ts", "6 hours", [F.avg(f_to_c("temperature")).alias("avg_temp_c")])
    return out.select("id", "window_end", F.round("avg_temp_c", 6).alias("avg_temp_c"))


@register("win_tumbling_offset", "WIN2", f"""
SELECT user_id AS id, {_start_sql(6 * HOUR, 5400)} AS window_start,
       {_end_sql(6 * HOUR, 5400)} AS window_end,
       count(*) AS cnt, min(value) AS min_temp
FROM events GROUP BY 1, 2, 3""")
def win_tumbling_offset(spark, sf):
    r = events(spark, sf)
    return W.window_agg(r, "id", "ts", "6 hours", [F.count(F.lit(1)).alias("cnt"),
                                                   F.min("temperature").alias("min_temp")],
                        offset="90 minutes")


@register("win_sliding", "WIN3", """
SELECT id, make_timestamp(CAST(ws * 1000000 AS BIGINT)) AS window_start,
       make_timestamp(CAST((ws + 21600) * 1000000 AS BIGINT)) AS window_end,
       count(*) AS cnt, min(temperature) AS min_temp, max(temperature) AS max_temp
FROM (SELECT user_id AS id, value AS temperature,
             (floor(epoch(ts) / 7200) - k) * 7200 AS ws
      FROM events, range(0, 3) t(k))
GROUP BY 1, 2, 3""")
def win_sliding(spark, sf):
    r = events(spark, sf)
    return W.window_agg(r, "id", "ts", "6 hours",
                        [F.count(F.lit(1)).alias("cnt"), F.min("temperature").alias("min_temp"),
                         F.max("temperature").alias("max_temp")], slide="2 hours")


@register("win_sliding_gapped", "WIN4", """
SELECT user_id AS id,
       make_timestamp(CAST(floor(epoch(ts) / 21600) * 21600 * 1000000 AS BIGINT)) AS window_start,
       make_timestamp(CAST((floor(epoch(ts) / 21600) * 21600 + 3600) * 1000000 AS BIGINT)) AS window_end,
       count(*) AS cnt, round(sum(value), 6) AS sum_temp
FROM events WHERE epoch(ts) < floor(epoch(ts) / 21600) * 21600 + 3600
GROUP BY 1, 2, 3""")
def win_sliding_gapped(spark, sf):
    """Slide (6 h) longer than size (1 h): rows in the gaps are in no window."""
    r = events(spark, sf)
    out = W.window_agg(r, "id", "ts", "1 hour",
                       [F.count(F.lit(1)).alias("cnt"), F.sum("temperature").alias("sum_temp")],
                       slide="6 hours")
    return out.withColumn("sum_temp", r6("sum_temp"))


@register("win_session", "WIN5", """
WITH f AS (
  SELECT user_id AS id, ts, value, event_id,
         CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) IS NULL
                OR ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) > INTERVAL 6 HOUR
              THEN 1 ELSE 0 END AS flag
  FROM events),
s AS (SELECT *, sum(flag) OVER (PARTITION BY id ORDER BY ts, event_id
                                ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT id, min(ts) AS window_start, max(ts) + INTERVAL 6 HOUR AS window_end,
       count(*) AS cnt, max(value) AS max_temp
FROM s GROUP BY id, sid""")
def win_session(spark, sf):
    r = events(spark, sf)
    out = W.sessions(r, "id", "ts", "6 hours",
                     [F.count(F.lit(1)).alias("cnt"), F.max("temperature").alias("max_temp")])
    return out.select("id", "window_start", "window_end", "cnt", "max_temp")


@register("win_count", "WIN7 TRG4", """
WITH n AS (SELECT user_id AS id, value, ts,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
SELECT id, CAST((floor((rn - 1) / 5) + 1) * 5 AS BIGINT) AS window_seq,
       min(value) AS min_temp, round(avg(value), 6) AS avg_temp, max(ts) AS last_ts
FROM n GROUP BY 1, 2 HAVING count(*) = 5""")
def win_count(spark, sf):
    r = events(spark, sf)
    out = W.count_windows(r, "id", 5, [F.min("temperature").alias("min_temp"),
                                       F.avg("temperature").alias("avg_temp"),
                                       F.max("ts").alias("last_ts")])
    return out.withColumn("avg_temp", r6("avg_temp")).withColumn("window_seq", F.col("window_seq").cast("long"))


@register("win_count_sliding", "WIN8", """
WITH n AS (SELECT user_id AS id, value,
             row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
e AS (SELECT DISTINCT id, rn AS window_seq FROM n WHERE rn % 2 = 0)
SELECT e.id, CAST(e.window_seq AS BIGINT) AS window_seq, count(*) AS cnt,
       round(sum(n.value), 6) AS sum_temp
FROM e JOIN n ON n.id = e.id AND n.rn BETWEEN e.window_seq - 4 AND e.window_seq
GROUP BY 1, 2""")
def win_count_sliding(spark, sf):
    r = events(spark, sf)
    out = W.count_windows(r, "id", 5, [F.count(F.lit(1)).alias("cnt"),
                                       F.sum("temperature").alias("sum_temp")], slide=2)
    return out.withColumn("sum_temp", r6("sum_temp")).withColumn("window_seq", F.col("window_seq").cast("long"))


@register("win_all", "WIN10", f"""
SELECT {_end_sql(HOUR)} AS window_end, count(*) AS cnt,
       ((2 * sum(CAST(round(value * 100) AS BIGINT)) * 10000 + count(*)) // (2 * count(*)))
         / 1000000.0 AS avg_temp,
       count(DISTINCT user_id) AS n_ids
FROM events GROUP BY 1""")
def win_all(spark, sf):
    """All sensors per hour.  The average is exact: readings carry two
    decimals, so it is summed in integer cents and rounded half-up to six
    places with integer arithmetic (a double average can sit on either side
    of a rounding tie depending on summation order)."""
    r = events(spark, sf).withColumn("__cents", F.round(F.col("temperature") * 100).cast("long"))
    out = W.window_agg(r, None, "ts", "1 hour", [F.count(F.lit(1)).alias("cnt"),
                                                 F.sum("__cents").alias("__sc"),
                                                 F.count_distinct("id").alias("n_ids")])
    avg_micro = F.expr("(2 * __sc * 10000 + cnt) div (2 * cnt)")
    return out.select("window_end", "cnt", (avg_micro / F.lit(1_000_000.0)).alias("avg_temp"), "n_ids")


def _business_day_assigner():
    """Every row → its calendar day; rows from 09:00 to 17:00 also → that
    day's business window.  One or two windows per row."""
    day = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    day_w = F.struct(day.alias("start"), (day + F.expr("INTERVAL 1 DAY")).alias("end"))
    b_start = day + F.expr("INTERVAL 9 HOURS")
    b_end = day + F.expr("INTERVAL 17 HOURS")
    biz = F.struct(b_start.alias("start"), b_end.alias("end"))
    in_biz = (F.col("ts") >= b_start) & (F.col("ts") < b_end)
    return F.when(in_biz, F.array(day_w, biz)).otherwise(F.array(day_w))


@register("win_custom", "WIN11", """
SELECT id, window_start, window_end, count(*) AS cnt, max(temperature) AS max_temp FROM (
  SELECT user_id AS id, value AS temperature, date_trunc('day', ts) AS window_start,
         date_trunc('day', ts) + INTERVAL 1 DAY AS window_end FROM events
  UNION ALL
  SELECT user_id, value, date_trunc('day', ts) + INTERVAL 9 HOUR,
         date_trunc('day', ts) + INTERVAL 17 HOUR FROM events
  WHERE ts >= date_trunc('day', ts) + INTERVAL 9 HOUR
    AND ts < date_trunc('day', ts) + INTERVAL 17 HOUR)
GROUP BY 1, 2, 3""")
def win_custom(spark, sf):
    r = events(spark, sf)
    out = W.assign_windows(r, _business_day_assigner(),
                           [F.count(F.lit(1)).alias("cnt"), F.max("temperature").alias("max_temp")],
                           key="id")
    return out


@register("win_merging", "WIN12", """
WITH iv AS (SELECT user_id AS id, ts AS s,
                   ts + to_microseconds(CAST(round(value * 60000000) AS BIGINT)) AS e, event_id
            FROM events),
m AS (SELECT *, max(e) OVER (PARTITION BY id ORDER BY s, event_id
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pm FROM iv),
g AS (SELECT *, sum(CASE WHEN pm IS NULL OR s > pm THEN 1 ELSE 0 END)
                 OVER (PARTITION BY id ORDER BY s, event_id ROWS UNBOUNDED PRECEDING) AS gid FROM m)
SELECT id, min(s) AS window_start, max(e) AS window_end, count(*) AS cnt FROM g GROUP BY id, gid""")
def win_merging(spark, sf):
    """Merging assigner: each reading opens ``[ts, ts + temperature minutes)``;
    overlapping windows of a sensor merge."""
    r = events(spark, sf)
    r = r.withColumn("until", from_epoch_micros(
        epoch_micros("ts") + F.round(F.col("temperature") * 60_000_000).cast("long")))
    out = W.merge_intervals(r, "id", "ts", "until", [F.count(F.lit(1)).alias("cnt")])
    return out.select("id", "window_start", "window_end", "cnt")


@register("win_reduce_min", "WFN1 WFN6", f"""
SELECT user_id AS id, {_end_sql(24 * HOUR)} AS window_end, min(value) AS min_temp,
       max(ts) AS latest_ts
FROM events GROUP BY 1, 2""")
def win_reduce_min(spark, sf):
    r = events(spark, sf)
    out = W.window_agg(r, "id", "ts", "1 day", [F.min("temperature").alias("min_temp"),
                                                F.max("ts").alias("latest_ts")])
    return out.select("id", "window_end", "min_temp", "latest_ts")


@register("win_min_by", "WFN2", f"""
SELECT id, window_end, arg_min(ts, (temperature, ts, seq)) AS ts,
       min(temperature) AS temperature, arg_min(seq, (temperature, ts, seq)) AS seq
FROM (SELECT user_id AS id, {_end_sql(24 * HOUR)} AS window_end, ts, value AS temperature,
             event_id AS seq FROM events)
GROUP BY 1, 2""")
def win_min_by(spark, sf):
    """Row with the lowest temperature per sensor and day; the earliest row
    wins a tie."""
    r = events(spark, sf)
    probe = F.struct("temperature", "ts", "seq")
    out = W.window_agg(r, "id", "ts", "1 day", [F.min(probe).alias("m")])
    return out.select("id", "window_end", F.col("m.ts").alias("ts"),
                      F.col("m.temperature").alias("temperature"), F.col("m.seq").alias("seq"))


@register("win_min_max", "WFN5 PRO7", f"""
SELECT user_id AS id, min(value) AS min_temp, max(value) AS max_temp,
       {_end_sql(6 * HOUR)} AS window_end
FROM events GROUP BY 1, 4""")
def win_min_max(spark, sf):
    r = events(spark, sf)
    out = W.window_agg(r, "id", "ts", "6 hours", [F.min("temperature").alias("min_temp"),
                                                  F.max("temperature").alias("max_temp")])
    return out.select("id", "min_temp", "max_temp", "window_end")


@register("win_fold", "WFN7", f"""
SELECT id, window_end, string_agg(event_type, ',' ORDER BY ts, seq) AS types
FROM (SELECT user_id AS id, {_end_sql(24 * HOUR)} AS window_end, ts, event_id AS seq,
             event_type FROM events)
GROUP BY 1, 2""")
def win_fold(spark, sf):
    """Ordered fold: the event types of a sensor's day in arrival order."""
    fold = Fold(F.col("event_type"), lambda a, b: F.concat(a, F.lit(","), b))
    out = window_fold(events(spark, sf, keep=("event_type",)), "id", "ts", "1 day", ["seq"], fold, "types")
    return out.select("id", "window_end", "types")


@register("win_median", "WFN9", f"""
SELECT user_id AS id, {_end_sql(24 * HOUR)} AS window_end,
       round(median(value), 6) AS median_temp
FROM events GROUP BY 1, 2""")
def win_median(spark, sf):
    r = events(spark, sf)
    out = W.window_median(r, "id", "ts", "1 day", "temperature", "median_temp")
    return out.select("id", "window_end", r6("median_temp").alias("median_temp"))


@register("win_accumulator", "WFN3 AGG9", """
SELECT l_suppkey AS id,
       make_timestamp(CAST((floor(epoch_us(l_shipdate) / (30 * 86400000000)) + 1) * 30 * 86400000000 AS BIGINT)) AS window_end,
       count(*) AS cnt, round(sum(l_extendedprice * (1 - l_discount)) / sum(l_quantity), 6) AS unit_price,
       round(max(l_quantity) - min(l_quantity), 6) AS spread
FROM lineitem GROUP BY 1, 2""")
def win_accumulator(spark, sf):
    """A user accumulator over 30-day windows of a supplier's shipments:
    discounted revenue and quantity merge to a unit price, extremes to a
    spread."""
    from eventide.operators.accumulate import Accumulator, window_accumulate
    q = F.col("l_quantity")
    acc = Accumulator(
        add={"n": (F.lit(1), F.count), "revenue": (F.col("l_extendedprice") * (1 - F.col("l_discount")), F.sum),
             "quantity": (q, F.sum), "low": (q, F.min), "high": (q, F.max)},
        result={"cnt": lambda s: s["n"], "unit_price": lambda s: r6(s["revenue"] / s["quantity"]),
                "spread": lambda s: r6(s["high"] - s["low"])})
    rows = table(spark, sf, "lineitem").withColumnRenamed("l_suppkey", "id")
    return window_accumulate(rows, "id", "l_shipdate", "30 days", acc).select("id", "window_end", "cnt", "unit_price", "spread")


@register("win_with_global_state", "WFN8 WFN6", f"""
SELECT id, window_end, cnt, sum(cnt) OVER (PARTITION BY id ORDER BY window_end
                                           ROWS UNBOUNDED PRECEDING) AS total
FROM (SELECT user_id AS id, {_end_sql(6 * HOUR)} AS window_end, count(*) AS cnt
      FROM events GROUP BY 1, 2)""")
def win_with_global_state(spark, sf):
    """Per-window count plus the sensor's running total over its windows
    (per-window state and per-key global state of a window function)."""
    from eventide.operators.scan import Scan, scan
    r = events(spark, sf)
    w = W.window_agg(r, "id", "ts", "6 hours", [F.count(F.lit(1)).alias("cnt")])
    out = scan(w.select("id", "window_end", "cnt"), ["id"], "window_end", [],
               [Scan("total", "sum", "cnt")])
    return out.select("id", "window_end", "cnt", F.col("total").cast("long").alias("total"))
