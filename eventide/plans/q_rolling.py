"""Rolling aggregate queries (AGG1-7, AGG10-11): one row per input row, in
arrival order (ts, event_id) per sensor."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import rolling as R
from eventide.plans.catalog import register
from eventide.plans.common import events, r6

_W = "PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING"


@register("rolling_sum", "AGG1 KEY2", f"""
SELECT user_id AS id, ts, event_id AS seq, round(sum(value) OVER ({_W}), 6) AS temperature
FROM events""")
def rolling_sum(spark, sf):
    r = events(spark, sf)
    out = R.rolling_sum(r, "id", "temperature")
    return out.select("id", "ts", "seq", r6("temperature").alias("temperature"))


def _first(col):
    return f"first({col}) OVER ({_W})"


@register("rolling_min", "AGG2", f"""
SELECT user_id AS id, {_first('ts')} AS ts, min(value) OVER ({_W}) AS temperature,
       {_first('event_id')} AS seq, event_id AS at_seq
FROM events""")
def rolling_min(spark, sf):
    """``keyBy(id).min(temperature)``: temperature is the running minimum,
    the other fields stay those of the sensor's first reading.  ``at_seq``
    names the input row that produced the output row."""
    return R.rolling_min(_with_at_seq(events(spark, sf)), "id", current=("at_seq",))


def _with_at_seq(r):
    return r.withColumn("at_seq", F.col("seq"))


@register("rolling_max", "AGG3", f"""
SELECT user_id AS id, {_first('ts')} AS ts, max(value) OVER ({_W}) AS temperature,
       {_first('event_id')} AS seq, event_id AS at_seq
FROM events""")
def rolling_max(spark, sf):
    return R.rolling_max(_with_at_seq(events(spark, sf)), "id", current=("at_seq",))


@register("rolling_min_by", "AGG4", f"""
SELECT id, m.ts AS ts, m.temperature AS temperature, m.seq AS seq, at_seq FROM (
  SELECT user_id AS id, event_id AS at_seq,
         min({{'temperature': value, 'ts': ts, 'seq': event_id}}) OVER ({_W}) AS m FROM events)""")
def rolling_min_by(spark, sf):
    """``minBy(temperature)``: the whole reading with the lowest temperature
    so far (the earlier reading on a tie)."""
    r = events(spark, sf)
    out = R.rolling_min_by(r.withColumn("at_seq", F.col("seq")), "id", current=("at_seq",))
    return out.select("id", "ts", "temperature", "seq", "at_seq")


@register("rolling_max_by", "AGG5", f"""
SELECT id, m.ts AS ts, -m.nt AS temperature, m.seq AS seq, at_seq FROM (
  SELECT user_id AS id, event_id AS at_seq,
         min({{'nt': -value, 'ts': ts, 'seq': event_id}}) OVER ({_W}) AS m FROM events)""")
def rolling_max_by(spark, sf):
    r = events(spark, sf)
    out = R.rolling_max_by(r.withColumn("at_seq", F.col("seq")), "id", current=("at_seq",))
    return out.select("id", "ts", "temperature", "seq", "at_seq")


@register("rolling_reduce", "AGG6 FN6", f"""
SELECT user_id AS id, ts, min(value) OVER ({_W}) AS temperature, event_id AS seq FROM events""")
def rolling_reduce(spark, sf):
    """``reduce((a, b) => (a.id, b.ts, min(a.t, b.t)))``."""
    r = events(spark, sf)
    return R.rolling_reduce_min_latest(r, "id").select("id", "ts", "temperature", "seq")


@register("rolling_list", "AGG7 KEY4 FN12", """
SELECT user_id AS id, date_trunc('day', ts) AS day, event_id AS seq,
       array_to_string(list(event_type) OVER (PARTITION BY user_id, date_trunc('day', ts)
                        ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), ',') AS types
FROM events""")
def rolling_list(spark, sf):
    """List-concatenating rolling reduce keyed by a selector (sensor, day)."""
    r = events(spark, sf, keep=("event_type",)).withColumn("day", F.date_trunc("day", "ts").cast("timestamp_ntz"))
    r = r.withColumn("types", F.array("event_type"))
    out = R.rolling_concat(r, ["id", "day"], "types")
    return out.select("id", "day", "seq", F.array_join("types", ",").alias("types"))


@register("rolling_count_over", "AGG10 AGG11 OPS1", f"""
SELECT user_id AS id, event_id AS seq,
       sum(CASE WHEN value > 100 THEN 1 ELSE 0 END) OVER ({_W}) AS high_count,
       sum(CASE WHEN value > 100 THEN 1 ELSE 0 END)
         OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS high_count_all
FROM events""")
def rolling_count_over(spark, sf):
    """Readings above 100 so far, per sensor and over all sensors (the
    overall count is a chunked global scan, not a one-partition window)."""
    r = events(spark, sf)
    out = R.rolling_count_if(r, "id", F.col("temperature") > 100, out="high_count",
                             overall_out="high_count_all")
    return out.select("id", "seq", F.col("high_count").cast("long").alias("high_count"),
                      F.col("high_count_all").cast("long").alias("high_count_all"))
