"""Record-level queries: map, filter, flatMap, routing, side outputs,
union/connect, parsing and word count (PRJ*, FLT*, FMP*, RTE*, UNI*, CON1-2,
SRC3, AGG8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, f_to_c, reading_text
from eventide.operators import transform as T
from eventide.operators.wordcount import document_word_count
from eventide.plans.catalog import register
from eventide.plans.common import events, r6, table
from eventide.sources.text import parse_readings


@register("map_celsius", "PRJ1 PRJ3", """
SELECT user_id AS id, ts, round((value - 32) * (5.0 / 9.0), 6) AS temperature_c FROM events""")
def map_celsius(spark, sf):
    r = events(spark, sf)
    return T.map_cols(r, id=F.col("id"), ts=F.col("ts"),
                      temperature_c=F.round(f_to_c("temperature"), 6))


@register("map_label", "PRJ4 FN4", """
SELECT CAST(user_id AS VARCHAR) || ' temperature' AS label, event_id AS seq FROM events""")
def map_label(spark, sf):
    r = events(spark, sf)
    return T.map_cols(r, label=F.concat(F.col("id").cast("string"), F.lit(" temperature")),
                      seq=F.col("seq"))


@register("reading_text", "PRJ5 FN3", """
SELECT 'SensorReading(' || CAST(user_id AS VARCHAR) || ',' ||
       CAST(CAST(floor(epoch(ts)) AS BIGINT) AS VARCHAR) || ',' || CAST(value AS VARCHAR) || ')'
       AS text FROM events""")
def reading_text_q(spark, sf):
    r = events(spark, sf)
    secs = F.floor(epoch_micros("ts") / 1_000_000).cast("long")
    return r.select(reading_text(F.col("id"), secs, F.col("temperature")).alias("text"))


@register("parse_readings", "SRC3 FN1 FN2 FN3 FN9", """
SELECT CAST(user_id AS VARCHAR) AS id,
       make_timestamp(CAST(floor(epoch(ts)) AS BIGINT) * 1000000) AS ts,
       value AS temperature FROM events""")
def parse_readings_q(spark, sf):
    """Render every event as an ``id,epoch_seconds,temperature`` line and
    parse it back with the delimited-record parser."""
    ev = table(spark, sf, "events")
    secs = F.floor(epoch_micros("ts") / 1_000_000).cast("long")
    lines = ev.select(F.concat_ws(",", F.col("user_id").cast("string"), secs.cast("string"),
                                  F.col("value").cast("string")).alias("value"))
    return parse_readings(lines)


@register("filter_hot", "FLT1 FLT3", """
SELECT user_id AS id, ts, value AS temperature FROM events
WHERE value > 30 AND (event_type = 'click' OR event_type = 'view')""")
def filter_hot(spark, sf):
    r = events(spark, sf, keep=("event_type",))
    cond = (F.col("temperature") > 30) & ((F.col("event_type") == "click") | (F.col("event_type") == "view"))
    return T.filter_rows(r, cond).select("id", "ts", "temperature")


@register("filter_contains", "FLT2 FN5", """
SELECT doc_id, n_chars FROM documents WHERE contains(text, 'the')""")
def filter_contains(spark, sf):
    d = table(spark, sf, "documents")
    return T.filter_rows(d, F.col("text").contains("the")).select("doc_id", "n_chars")


_SPLIT_SQL = """
SELECT user_id AS id, event_id AS seq, value AS temperature,
       CASE WHEN value > 30 THEN 'high' ELSE 'low' END AS label FROM events"""


@register("split_select", "RTE1 RTE2", _SPLIT_SQL)
def split_select(spark, sf):
    """Split into "high" (> 30) and "low", then select both outputs: every
    row exactly once, with its label."""
    r = events(spark, sf)
    routed = T.route(r, {"high": F.col("temperature") > 30, "low": F.col("temperature") <= 30})
    both = T.select_outputs(routed, ["low", "high"])
    return both.select("id", "seq", "temperature", F.col("labels")[0].alias("label"))


@register("side_output_low", "RTE3 PRO1", """
SELECT user_id AS id, event_id AS seq, value AS temperature FROM events
WHERE NOT coalesce(value > 30, false)""")
def side_output_low(spark, sf):
    r = events(spark, sf)
    _, low = T.side_split(r, F.col("temperature") > 30)
    return low.select("id", "seq", "temperature")


@register("freezing_alarm", "RTE4", """
SELECT 'Freezing Alarm for ' || CAST(user_id AS VARCHAR) AS message, event_id AS seq
FROM events WHERE value < 32""")
def freezing_alarm(spark, sf):
    r = events(spark, sf)
    side = r.where(F.col("temperature") < 32)
    return side.select(F.format_string("Freezing Alarm for %s", F.col("id")).alias("message"), "seq")


@register("union_sources", "UNI1", """
SELECT 'events' AS src, CAST(user_id AS VARCHAR) AS id, ts, value AS temperature FROM events
UNION ALL
SELECT 'orders', CAST(o_custkey AS VARCHAR), o_orderdate, round(o_totalprice / 1000, 6) FROM orders""")
def union_sources(spark, sf):
    a = events(spark, sf).select(F.lit("events").alias("src"), F.col("id").cast("string").alias("id"),
                                 "ts", "temperature")
    o = table(spark, sf, "orders")
    b = o.select(F.lit("orders").alias("src"), F.col("o_custkey").cast("string").alias("id"),
                 F.col("o_orderdate").alias("ts"), r6(F.col("o_totalprice") / 1000).alias("temperature"))
    return T.union_all(a, b)


@register("connect_map", "CON1", """
SELECT CASE WHEN value > 100 THEN 'warning' ELSE 'healthy' END AS status,
       CAST(user_id AS VARCHAR) AS id, CASE WHEN value > 100 THEN value END AS temperature,
       1 AS src FROM events
UNION ALL
SELECT 'order', CAST(o_custkey AS VARCHAR), NULL, 2 FROM orders""")
def connect_map(spark, sf):
    """Two differently typed inputs, one map function each: readings become
    (warning, id, temperature) or (healthy, id); orders become (order, id)."""
    r = events(spark, sf)
    o = table(spark, sf, "orders")
    hot = F.col("temperature") > 100
    left = {"status": F.when(hot, "warning").otherwise("healthy"),
            "id": F.col("id").cast("string"),
            "temperature": F.when(hot, F.col("temperature"))}
    right = {"status": F.lit("order"), "id": F.col("o_custkey").cast("string")}
    out = T.connect(r, o, left, right)
    return out.select("status", "id", "temperature", F.col("src").cast("int").alias("src"))


@register("connect_flat_map", "CON2", """
SELECT 'reading' AS what, CAST(user_id AS VARCHAR) AS id, round(value, 6) AS amount, 1 AS src FROM events WHERE value > 50
UNION ALL SELECT 'hot', CAST(user_id AS VARCHAR), round(value - 100, 6), 1 FROM events WHERE value > 100
UNION ALL SELECT unnest(string_split(o_orderpriority, '-')), CAST(o_custkey AS VARCHAR), NULL, 2 FROM orders""")
def connect_flat_map(spark, sf):
    """Readings give none, one or two records, orders one for each part of
    their priority."""
    def record(what, amount):
        return F.struct(F.lit(what).alias("what"), F.col("id").cast("string").alias("id"), r6(amount).alias("amount"))

    t = F.col("temperature")
    readings = F.filter(F.array(F.when(t > 50, record("reading", t)), F.when(t > 100, record("hot", t - 100))),
                        lambda x: x.isNotNull())
    orders = F.transform(F.split("o_orderpriority", "-"),
                         lambda w: F.struct(w.alias("what"), F.col("o_custkey").cast("string").alias("id")))
    out = T.connect_flat_map(events(spark, sf), table(spark, sf, "orders"), readings, orders)
    return out.select("what", "id", "amount", F.col("src").cast("int").alias("src"))


@register("word_count", "AGG8 FMP1 PRJ2 KEY5", r"""
WITH l AS (SELECT regexp_replace(unnest(string_split(regexp_replace(text, '\n$', ''), chr(10))),
                                 '\r$', '') AS line FROM documents),
w AS (SELECT CASE WHEN line = '' THEN ['']
                  WHEN rtrim(line, ' ') = '' THEN []::VARCHAR[]
                  ELSE string_split(rtrim(line, ' '), ' ') END AS ws FROM l)
SELECT word, count(*) AS cnt FROM (SELECT unnest(ws) AS word FROM w) GROUP BY word""")
def word_count(spark, sf):
    return document_word_count(table(spark, sf, "documents"))


@register("key_nested", "KEY3 KEY4 KEY2", r"""
SELECT CAST(regexp_extract(props, '"k":\s*(-?\d+)', 1) AS INTEGER) AS props_k,
       count(*) AS cnt, max(value) AS max_temp
FROM events GROUP BY 1""")
def key_nested(spark, sf):
    """Key by a nested field: ``props`` parsed into a struct, grouped by
    ``props.k``."""
    from eventide.operators.keys import key_columns
    ev = table(spark, sf, "events").select(F.from_json("props", "k int").alias("props"), "value")
    k = key_columns(ev, "props.k")
    return ev.groupBy(*k).agg(F.count(F.lit(1)).alias("cnt"), F.max("value").alias("max_temp"))
