"""Late data in batch replay: given an arrival order that differs from
event time, decide which rows a watermark of ``max(ts seen) - delay`` marks
late, and what windows would have emitted.

The watermark before a row is the maximum event time over all rows that
arrived strictly earlier, minus the delay (one global clock, as in Spark).
It is a chunked global scan over the arrival order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, from_epoch_micros, parse_duration_us
from eventide.operators.accumulate import Accumulator
from eventide.operators.scan import Scan, same, scan
from eventide.operators.windows import window_rows


def with_watermark_before(df: DataFrame, ts: str, arrival: str, seq: str, delay: str,
                          chunk=None) -> DataFrame:
    """Adds ``wm_before`` (TIMESTAMP_NTZ, NULL before the first row)."""
    d = parse_duration_us(delay)
    s = scan(df, [], arrival, [seq], [Scan("__maxprev", "max_excl", epoch_micros(ts))], chunk=chunk)
    return s.withColumn("wm_before", from_epoch_micros(F.col("__maxprev") - d)).drop("__maxprev")


def split_late(df: DataFrame, ts: str, arrival: str, seq: str, delay: str,
               chunk=None) -> tuple[DataFrame, DataFrame]:
    """Late-row filter: rows behind the current watermark go to the side
    output; (on_time, late)."""
    m = with_watermark_before(df, ts, arrival, seq, delay, chunk)
    late = F.coalesce(F.col(ts) < F.col("wm_before"), F.lit(False))
    return m.where(~late), m.where(late)


def window_lateness(df: DataFrame, key, ts: str, arrival: str, seq: str, delay: str, size: str,
                    allowed: str = "0 seconds", chunk=None) -> DataFrame:
    """Tag each row with its tumbling window and its fate:
    ``on_time`` (window not closed), ``late_allowed`` (closed but within
    allowed lateness: re-fires the window), ``dropped`` (side output)."""
    allowed_us = parse_duration_us(allowed)
    m = with_watermark_before(df, ts, arrival, seq, delay, chunk)
    w = window_rows(m, ts, size)
    wm = epoch_micros("wm_before")
    end = epoch_micros("window_end")
    fate = (F.when(F.col("wm_before").isNull() | (wm < end), "on_time")
            .when(wm < end + allowed_us, "late_allowed").otherwise("dropped"))
    return w.withColumn("fate", fate)


def lateness_firings(tagged: DataFrame, key, arrival: str, seq: str) -> DataFrame:
    """Firings of windows under allowed lateness: one ``first`` firing with
    the on-time rows, then one ``update`` per allowed-late row (count so
    far).  Output: keys, window_end, firing, cnt, kind.

    On-time rows are only counted (partial aggregation).  Late rows are
    numbered per window by the chunked scan, so a window with many of them is
    no single task's work, and meet their window's count in a join."""
    keys = [key] if isinstance(key, str) else list(key or [])
    on = keys + ["window_start", "window_end"]
    first = (tagged.where(F.col("fate") == "on_time").groupBy(*on)
             .agg(F.count(F.lit(1)).alias("__n0")))
    late = scan(tagged.where(F.col("fate") == "late_allowed").select(*on, arrival, seq),
                on, arrival, [seq], [Scan("__k", "count", F.lit(1))])
    late = late.alias("l").join(first.alias("r"), same(on), "left").select("l.*", "r.__n0")
    had, k = F.col("__n0").isNotNull(), F.col("__k")
    # a window whose first row is already late fires first on that row
    updates = late.select(
        *keys, "window_end", F.when(had, k).otherwise(k - 1).alias("firing"),
        (F.coalesce(F.col("__n0"), F.lit(0)) + k).alias("cnt"),
        F.when(had | (k > 1), "update").otherwise("first").alias("kind"))
    return first.select(*keys, "window_end", F.lit(0).cast("long").alias("firing"), F.col("__n0").alias("cnt"),
                        F.lit("first").alias("kind")).unionByName(updates)


def window_states(tagged: DataFrame, key, acc: Accumulator) -> DataFrame:
    """Accumulator states of windowed rows: one row for each (key, window)
    and ``is_late``, that is, of the rows published when the window fired and
    of those that came too late for it.  One pass over the rows."""
    keys = [key] if isinstance(key, str) else list(key or [])
    late = (F.col("fate") != "on_time").alias("is_late")
    return tagged.groupBy(*keys, "window_start", "window_end", late).agg(*acc.states())


def backfill(published: DataFrame, late: DataFrame, key, acc: Accumulator) -> DataFrame:
    """Periodic back-fill: merge the states of late rows into the published
    ones.  Both have the columns (key..., window_start, window_end, state
    fields); a (key, window) may be in either alone.  Rows are not read: what
    is shuffled is one state for each window.  Raises ValueError if a field's
    states cannot be joined; :func:`recompute` is for those."""
    if not acc.mergeable:
        raise ValueError("states of " + ", ".join(n for n in acc.add if not acc.joins(n)) + " cannot be merged")
    keys = [key] if isinstance(key, str) else list(key or [])
    on = [*keys, "window_start", "window_end"]
    cols = [*on, *[f"__{name}" for name in acc.add]]
    return published.select(*cols).unionByName(late.select(*cols)).groupBy(*on).agg(*acc.merged())


def recompute(published: DataFrame, late_rows: DataFrame, all_rows: DataFrame, key, ts: str,
              size: str, aggs) -> DataFrame:
    """Back-fill of results that cannot be merged: only the windows that late
    rows touch are worked out again, over all rows of those windows, and
    replace their published rows.  All rows are read once to find them."""
    keys = [key] if isinstance(key, str) else list(key or [])
    on = keys + ["window_end"]
    touched = window_rows(late_rows, ts, size).select(*on).distinct()
    rows = window_rows(all_rows, ts, size)
    fixed = (rows.alias("l").join(touched.alias("r"), same(on), "left_semi")
             .groupBy(*keys, "window_start", "window_end").agg(*aggs).drop("window_start"))
    kept = published.alias("l").join(touched.alias("r"), same(on), "left_anti")
    return kept.unionByName(fixed.select(*published.columns))
