"""Pane policies in batch form: early (periodic event-time) firing,
data-driven triggers and evictors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, from_epoch_micros, parse_duration_us
from eventide.operators.alerts import runs_of
from eventide.operators.scan import Scan, scan
from eventide.operators.windows import count_windows, window_rows


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def early_firing_counts(df: DataFrame, key, ts: str, size: str, every: str,
                        value: str = "temperature") -> DataFrame:
    """Tumbling windows that fire early on an event-time grid.

    After a window's first row, the window fires at every multiple of
    ``every`` before its end with the rows so far (``ts`` < tick;
    accumulating panes), then once more at the end (``is_final``).
    ``size`` must be a multiple of ``every``.  Output: keys, window_end,
    pane_ts, cnt, sum_value, is_final.

    Rows are reduced to one partial row per (key, window, tick) before
    anything else, and the ticks of a window are a bounded sequence, so
    there is no per-window row buffer.
    """
    keys = _keys(key)
    size_us, every_us = parse_duration_us(size), parse_duration_us(every)
    if size_us % every_us:
        raise ValueError("window size must be a multiple of the firing interval")
    w = window_rows(df, ts, size).withColumn("__t", epoch_micros(ts))
    on = keys + ["window_start", "window_end"]
    # one partial row per (key, window, tick bucket): the only pass over rows
    per_tick = (w.withColumn("__b", F.floor(F.col("__t") / every_us).cast("long"))
                .groupBy(*on, "__b").agg(F.count(F.lit(1)).alias("__n"), F.sum(value).alias("__s")))
    wb = Window.partitionBy(*on).orderBy("__b")
    run = wb.rowsBetween(Window.unboundedPreceding, 0)
    t = per_tick.select(*on, "__b", F.sum("__n").over(run).alias("cnt"),
                        F.sum("__s").over(run).alias("sum_value"), F.lead("__b").over(wb).alias("__next"))
    end_idx = (epoch_micros("window_end") / every_us).cast("long")
    # bucket b answers every tick from b + 1 up to the next non-empty bucket
    # (or the last tick before the end); the last bucket also gives the final pane
    hi = F.coalesce(F.col("__next"), end_idx - 1)
    ticks = F.when(F.col("__b") + 1 <= hi, F.sequence(F.col("__b") + 1, hi)).otherwise(
        F.array().cast("array<bigint>"))
    early = F.transform(ticks, lambda k: F.struct(
        from_epoch_micros(k * every_us).alias("pane_ts"), F.lit(False).alias("is_final")))
    final = F.when(F.col("__next").isNull(), F.array(F.struct(
        F.col("window_end").alias("pane_ts"), F.lit(True).alias("is_final")))).otherwise(
        F.array().cast("array<struct<pane_ts:timestamp_ntz,is_final:boolean>>"))
    panes = t.select(*keys, "window_end", "cnt", "sum_value",
                     F.explode(F.concat(early, final)).alias("__p"))
    return panes.select(*keys, "window_end", "__p.pane_ts", "cnt", "sum_value", "__p.is_final")


def trigger_panes(df: DataFrame, key, cond: Column, aggs: list[Column], ts: str = "ts",
                  seq: str = "seq", chunk=None) -> DataFrame:
    """Global window per key with a data-driven FIRE_AND_PURGE trigger: a
    row matching ``cond`` closes the pane it belongs to; rows after the last
    firing stay unfired.  Output: keys, pane, fire_ts, aggregates."""
    keys = _keys(key)
    r = runs_of(df, keys, cond, ts, seq, chunk=chunk)
    out = r.groupBy(*keys, "pane").agg(F.max("__f").alias("__fired"),
                                        F.max(F.when(F.col("__f") == 1, F.col(ts))).alias("fire_ts"),
                                        *aggs)
    return out.where(F.col("__fired") == 1).drop("__fired")


def evict_keep_last(rows: DataFrame, group: list[str], n: int, order: list[str],
                    salts: int = 32, salt_col: str | None = None) -> DataFrame:
    """Count evictor: keep the last ``n`` rows of each group by ``order``.

    Two-phase top-n: first inside (group, salt) sub-groups, then over the at
    most ``salts * n`` survivors, so a huge group is never sorted in one
    task.
    """
    desc = [F.col(c).desc() for c in order]
    salt = F.pmod(F.hash(F.col(salt_col or order[-1])), F.lit(salts))
    s = rows.withColumn("__salt", salt)
    w1 = Window.partitionBy(*group, "__salt").orderBy(*desc)
    s = s.withColumn("__r", F.row_number().over(w1)).where(F.col("__r") <= n)
    w2 = Window.partitionBy(*group).orderBy(*desc)
    return s.withColumn("__r", F.row_number().over(w2)).where(F.col("__r") <= n).drop("__r", "__salt")


def evict_after(df: DataFrame, key, every: int, keep: int, aggs: list[Column], ts: str = "ts",
                seq: str = "seq", chunk=None) -> DataFrame:
    """A count trigger whose evictor runs after the window function: every
    ``every`` rows of a key the function sees the rows still in the pane, and
    then all but the last ``keep`` leave.  So firing at row n sees the rows
    after n - every - keep.  Output adds ``window_seq`` = n."""
    return count_windows(df, key, every + keep, aggs, slide=every, ts=ts, seq=seq, chunk=chunk)


def evict_older_than(rows: DataFrame, group: list[str], ts: str, keep: str, chunk=None) -> DataFrame:
    """Time evictor: keep rows within ``keep`` of the group's newest row.

    One scan over the rows backwards in time, where the running maximum is
    the newest row's time from the first row on; a huge group is cut into
    chunks and never joined with itself.  Rows without a time leave."""
    keep_us = parse_duration_us(keep)
    t = epoch_micros(ts)
    back = rows.withColumn("__back", from_epoch_micros(-t))
    s = scan(back, group, "__back", [], [Scan("__newest", "max", t)], chunk=chunk)
    return s.where(t >= F.col("__newest") - keep_us).drop("__newest", "__back")
