"""Join and connected-input queries (JON1-3, CON4-5, BRD1-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.scalar import smoke_level
from eventide.operators import combine as C
from eventide.operators.alerts import fire_alert, switch_filter, threshold_alert
from eventide.plans.catalog import register
from eventide.plans.common import events, r6


def _typed(spark, sf, types, prefix):
    r = events(spark, sf, keep=("event_type",)).where(F.col("event_type").isin(*types))
    return r.select("id", *[F.col(c).alias(f"{prefix}_{c}") for c in ("ts", "seq", "temperature")])


@register("interval_join", "JON1 PRO6", """
SELECT c.user_id AS id, c.event_id AS click_seq, p.event_id AS purchase_seq,
       c.ts AS click_ts, p.ts AS purchase_ts
FROM events c JOIN events p ON c.user_id = p.user_id
WHERE c.event_type = 'click' AND p.event_type = 'purchase'
  AND p.ts BETWEEN c.ts - INTERVAL 1 HOUR AND c.ts + INTERVAL 6 HOUR""")
def interval_join(spark, sf):
    """Purchases of the same user from 1 h before to 6 h after a click."""
    clicks = _typed(spark, sf, ["click"], "click")
    buys = _typed(spark, sf, ["purchase"], "purchase")
    j = C.interval_join(clicks, buys, "id", "click_ts", "purchase_ts", "-1 hour", "6 hours")
    return j.select("id", "click_seq", "purchase_seq", "click_ts", "purchase_ts")


_WS = "make_timestamp(CAST(floor(epoch(ts) / 21600) * 21600 * 1000000 AS BIGINT))"


@register("window_join", "JON2", f"""
WITH p AS (SELECT user_id, floor(epoch(ts) / 21600) AS w, count(*) AS n_purchases,
                  arg_min(event_id, (ts, event_id)) AS first_purchase_seq,
                  round(sum(value), 6) AS purchase_temp
           FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT v.user_id AS id, {_WS.replace('ts', 'v.ts')} AS window_start,
       {_WS.replace('ts', 'v.ts')} + INTERVAL 6 HOUR AS window_end,
       v.event_id AS view_seq, p.n_purchases, p.first_purchase_seq, p.purchase_temp
FROM events v JOIN p ON v.user_id = p.user_id AND floor(epoch(v.ts) / 21600) = p.w
WHERE v.event_type = 'view'""")
def window_join(spark, sf):
    """Each view with the purchases of the same user and 6 h window:
    their count, the first one and their total value (pair-free)."""
    views = _typed(spark, sf, ["view"], "view")
    buys = _typed(spark, sf, ["purchase"], "purchase")
    aggs = [F.count(F.lit(1)).alias("n_purchases"),
            F.min(F.struct("purchase_ts", "purchase_seq")).alias("__first"),
            F.sum("purchase_temperature").alias("purchase_temp")]
    j = C.window_join(views, buys, "id", "view_ts", "purchase_ts", "6 hours", aggs)
    return j.select("id", "window_start", "window_end", "view_seq", "n_purchases",
                    F.col("__first.purchase_seq").alias("first_purchase_seq"),
                    r6("purchase_temp").alias("purchase_temp"))


_DS = "make_timestamp(CAST(floor(epoch(ts) / 86400) * 86400 * 1000000 AS BIGINT))"


@register("window_cogroup", "JON3", f"""
WITH c AS (SELECT user_id AS id, {_DS} AS window_start, count(*) AS n_clicks,
                  round(sum(value), 6) AS click_temp
           FROM events WHERE event_type = 'click' GROUP BY 1, 2),
p AS (SELECT user_id AS id, {_DS} AS window_start, count(*) AS n_purchases,
             round(sum(value), 6) AS purchase_temp
      FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)
SELECT coalesce(c.id, p.id) AS id, coalesce(c.window_start, p.window_start) AS window_start,
       coalesce(c.window_start, p.window_start) + INTERVAL 1 DAY AS window_end,
       coalesce(n_clicks, 0) AS n_clicks, coalesce(click_temp, 0.0) AS click_temp,
       coalesce(n_purchases, 0) AS n_purchases, coalesce(purchase_temp, 0.0) AS purchase_temp
FROM c FULL OUTER JOIN p ON c.id = p.id AND c.window_start = p.window_start""")
def window_cogroup(spark, sf):
    """Per user and day: both sides' row groups, also when one is empty."""
    clicks = _typed(spark, sf, ["click"], "click")
    buys = _typed(spark, sf, ["purchase"], "purchase")
    out = C.window_cogroup(clicks, buys, "id", "click_ts", "purchase_ts", "1 day",
                           [F.count(F.lit(1)).alias("n_clicks"), F.sum("click_temperature").alias("click_temp")],
                           [F.count(F.lit(1)).alias("n_purchases"),
                            F.sum("purchase_temperature").alias("purchase_temp")])
    z = F.coalesce
    return out.select("id", "window_start", "window_end",
                      z("n_clicks", F.lit(0)).alias("n_clicks"),
                      z(r6("click_temp"), F.lit(0.0)).alias("click_temp"),
                      z("n_purchases", F.lit(0)).alias("n_purchases"),
                      z(r6("purchase_temp"), F.lit(0.0)).alias("purchase_temp"))


@register("fire_alert", "CON4 BRD1", """
WITH u AS (
  SELECT user_id, ts, event_id, value, 1 AS side, NULL AS level FROM events
  WHERE event_type NOT IN ('error', 'view')
  UNION ALL
  SELECT user_id, ts, event_id, value, 0, CASE WHEN event_type = 'error' THEN 'High' ELSE 'Low' END
  FROM events WHERE event_type IN ('error', 'view')),
a AS (SELECT *, last_value(level IGNORE NULLS) OVER (ORDER BY ts, side, event_id
                  ROWS UNBOUNDED PRECEDING) AS cur FROM u)
SELECT user_id AS id, event_id AS seq, ts, value AS temperature, cur AS level,
       'Risk of fire!' AS message
FROM a WHERE side = 1 AND cur = 'High' AND value > 100""")
def fire_alert_q(spark, sf):
    """Readings (click/purchase/signup) against one global smoke input
    (error = High, view = Low)."""
    r = events(spark, sf, keep=("event_type",))
    data = r.where(~F.col("event_type").isin("error", "view")).drop("event_type")
    smoke = (r.where(F.col("event_type").isin("error", "view"))
             .select("ts", "seq", smoke_level("event_type").alias("level")))
    out = fire_alert(data, smoke, 100.0)
    return out.select("id", "seq", "ts", "temperature", "level", "message")


@register("switch_filter", "CON3 CON5 PRO5", """
WITH u AS (
  SELECT user_id, ts, event_id, 0 AS side,
         epoch_us(ts) + CAST(round(value * 60000000) AS BIGINT) AS expiry, NULL AS val
  FROM events WHERE event_type = 'signup'
  UNION ALL
  SELECT user_id, ts, event_id, 1, NULL, value FROM events WHERE event_type <> 'signup'),
m AS (SELECT *, max(expiry) OVER (PARTITION BY user_id ORDER BY ts, side, event_id
                                  ROWS UNBOUNDED PRECEDING) AS open_until FROM u)
SELECT user_id AS id, event_id AS seq, ts, val AS temperature FROM m
WHERE side = 1 AND epoch_us(ts) < open_until""")
def switch_filter_q(spark, sf):
    """A signup opens forwarding of that user's readings for ``value``
    minutes (longest expiry wins)."""
    r = events(spark, sf, keep=("event_type",))
    data = r.where(F.col("event_type") != "signup").select("id", "seq", "ts", "temperature")
    sw = (r.where(F.col("event_type") == "signup")
          .select("id", "ts", "seq", F.round(F.col("temperature") * 60_000_000).cast("long")
                  .alias("duration_us")))
    return switch_filter(data, sw, "id")


@register("threshold_alert", "BRD2", """
WITH u AS (
  SELECT user_id, ts, event_id, 0 AS side, floor(value / 100) * 50.0 AS thr, NULL AS val
  FROM events WHERE event_type = 'signup'
  UNION ALL
  SELECT user_id, ts, event_id, 1, NULL, value FROM events WHERE event_type <> 'signup'),
a AS (SELECT *, last_value(thr IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, side, event_id
                  ROWS UNBOUNDED PRECEDING) AS cur FROM u),
act AS (SELECT * FROM a WHERE side = 1 AND cur IS NOT NULL AND cur <> 0),
p AS (SELECT *, lag(val) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM act)
SELECT user_id AS id, event_id AS seq, val AS temperature, cur AS threshold,
       round(abs(val - prev), 6) AS diff
FROM p WHERE prev IS NOT NULL AND abs(val - prev) > cur""")
def threshold_alert_q(spark, sf):
    """Signups carry per-user threshold updates (floor(value/100)*50, 0
    deletes); other events are readings checked against them."""
    r = events(spark, sf, keep=("event_type",))
    data = r.where(F.col("event_type") != "signup").select("id", "seq", "ts", "temperature")
    upd = (r.where(F.col("event_type") == "signup")
           .select("id", "ts", "seq", (F.floor(F.col("temperature") / 100) * 50.0).alias("threshold")))
    out = threshold_alert(data, upd, "id")
    return out.select("id", "seq", "temperature", "threshold", r6("diff").alias("diff"))
