"""Per-key stateful alert queries (STA7-10, PRO2-4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import alerts as A
from eventide.plans.catalog import register
from eventide.plans.common import events, r6

_L = "lag({c}) OVER (PARTITION BY user_id ORDER BY ts, event_id)"


@register("jump_alert", "STA7 STA8 STA9 STA1 FN7", f"""
SELECT id, prev_temp, temperature, seq FROM (
  SELECT user_id AS id, {_L.format(c='value')} AS prev_temp, value AS temperature, event_id AS seq
  FROM events) WHERE prev_temp IS NOT NULL AND abs(temperature - prev_temp) > 10.0""")
def jump_alert(spark, sf):
    """(id, previous, current) when a sensor jumps by more than 10."""
    r = events(spark, sf)
    return A.jump_alert(r, "id", 10.0).select("id", "prev_temp", "temperature", "seq")


@register("self_cleaning_alert", "STA10 STA6 PRO3", f"""
SELECT id, temperature, round(abs(temperature - prev_temp), 6) AS diff, seq FROM (
  SELECT user_id AS id, value AS temperature, event_id AS seq, ts,
         {_L.format(c='value')} AS prev_temp, {_L.format(c='ts')} AS prev_ts FROM events)
WHERE prev_ts IS NOT NULL AND ts - prev_ts < INTERVAL 6 HOUR
  AND abs(temperature - prev_temp) > 10.0""")
def self_cleaning_alert(spark, sf):
    """Jump alert whose state is dropped after 6 h without readings."""
    r = events(spark, sf)
    out = A.self_cleaning_jump_alert(r, "id", 10.0, ttl="6 hours")
    return out.select("id", "temperature", r6("diff").alias("diff"), "seq")


# Within a run (rows between falls) the first rise arms a timer; the next
# timer is armed by the first rise at or after the previous one's time; a
# timer fires unless the next run (a fall) starts before it.
@register("rising_alert", "PRO4 PRO2 STA1", """
WITH RECURSIVE
r AS (SELECT user_id AS id, ts, event_id AS seq, value AS v,
             lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pv FROM events),
g AS (SELECT *, sum(CASE WHEN v < pv THEN 1 ELSE 0 END)
                  OVER (PARTITION BY id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS run FROM r),
rises AS (SELECT id, run, ts FROM g WHERE v > pv),
starts AS (SELECT id, run - 1 AS run, min(ts) AS next_start FROM g GROUP BY id, run),
chain(id, run, armed) AS (
  SELECT id, run, min(ts) FROM rises GROUP BY id, run
  UNION ALL
  SELECT c.id, c.run, n.armed FROM chain c,
    LATERAL (SELECT min(x.ts) AS armed FROM rises x
             WHERE x.id = c.id AND x.run = c.run AND x.ts >= c.armed + INTERVAL 1 HOUR) n
  WHERE n.armed IS NOT NULL)
SELECT c.id, c.armed + INTERVAL 1 HOUR AS alert_ts, 'rising' AS kind
FROM chain c LEFT JOIN starts s ON s.id = c.id AND s.run = c.run
WHERE s.next_start IS NULL OR s.next_start >= c.armed + INTERVAL 1 HOUR""")
def rising_alert(spark, sf):
    """Alert when a sensor's temperature rose and did not fall within 1 h
    (event-time timers).  Also checked against a row-by-row replay."""
    r = events(spark, sf)
    return A.rising_alert(r, "id", "1 hour").select("id", "alert_ts", F.lit("rising").alias("kind"))
