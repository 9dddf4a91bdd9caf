"""Event-time and count windows (bounded input; the time windows also run
unchanged on a watermarked stream).

Windows are half-open ``[start, end)`` and exist only where rows are.
Output columns are ``window_start`` / ``window_end`` (TIMESTAMP_NTZ).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, from_epoch_micros, parse_duration_us
from eventide.operators.scan import Scan, resolve_chunking, same, scan


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def _flatten_window(df: DataFrame, wcol: str = "window") -> DataFrame:
    cols = [c for c in df.columns if c != wcol]
    return df.select(*cols,
                     F.col(f"{wcol}.start").cast("timestamp_ntz").alias("window_start"),
                     F.col(f"{wcol}.end").cast("timestamp_ntz").alias("window_end"))


def tumbling(ts: str, size: str, offset: str | None = None) -> Column:
    """Tumbling window column; ``offset`` shifts the grid (e.g. 1 hour
    windows starting at :15)."""
    return F.window(ts, size, size, offset) if offset else F.window(ts, size)


def sliding(ts: str, size: str, slide: str, offset: str | None = None) -> Column:
    return F.window(ts, size, slide, offset) if offset else F.window(ts, size, slide)


def window_agg(df: DataFrame, key, ts: str, size: str, aggs: list[Column],
               slide: str | None = None, offset: str | None = None) -> DataFrame:
    """Keyed (or, with ``key=None``, all-rows) time-window aggregate.

    Aggregates are combined map-side (partial aggregation), so a hot key
    costs one partial row per input partition, not one task.
    ``slide > size`` (gaps between windows) is supported: rows in a gap
    belong to no window.
    """
    keys = _keys(key)
    if slide is not None and parse_duration_us(slide) > parse_duration_us(size):
        return _gapped_sliding(df, keys, ts, size, slide, aggs, offset)
    w = sliding(ts, size, slide, offset) if slide else tumbling(ts, size, offset)
    out = df.groupBy(*keys, w.alias("window")).agg(*aggs)
    return _flatten_window(out)


def window_median(df: DataFrame, key, ts: str, size: str, value: str, out: str) -> DataFrame:
    """Exact median per key and tumbling window.  Values are counted first
    (partial aggregation), then ranked over the counts: a sort that spills,
    never a buffer of a group's rows."""
    keys = _keys(key)
    on = keys + ["window_start", "window_end"]
    counts = window_agg(df, keys + [value], ts, size, [F.count(value).alias("__c")])
    w = Window.partitionBy(*on)
    upto = F.sum("__c").over(w.orderBy(value).rowsBetween(Window.unboundedPreceding, 0))
    ranked = counts.withColumn("__upto", upto).withColumn("__n", F.sum("__c").over(w))

    def at(rank):
        return F.max(F.when((F.col("__upto") >= rank) & (F.col("__upto") - F.col("__c") < rank), F.col(value)))

    low, high = F.floor((F.col("__n") + 1) / 2), F.floor(F.col("__n") / 2) + 1
    return ranked.groupBy(*on).agg(((at(low) + at(high)) / 2).alias(out))


def _gapped_sliding(df, keys, ts, size, slide, aggs, offset):
    size_us = parse_duration_us(size)
    w = tumbling(ts, slide, offset).alias("window")
    tagged = df.withColumn("window", w)
    start_us = epoch_micros(F.col("window.start").cast("timestamp_ntz"))
    kept = tagged.where(epoch_micros(ts) < start_us + F.lit(size_us))
    kept = kept.withColumn("window", F.struct(
        F.col("window.start").cast("timestamp_ntz").alias("start"),
        from_epoch_micros(start_us + F.lit(size_us)).alias("end")))
    return _flatten_window(kept.groupBy(*keys, "window").agg(*aggs))


def window_rows(df: DataFrame, ts: str, size: str, slide: str | None = None,
                offset: str | None = None) -> DataFrame:
    """Tag every row with its window(s) (a row is repeated per window it
    falls into); for window joins and per-window evictors."""
    w = sliding(ts, size, slide, offset) if slide else tumbling(ts, size, offset)
    return _flatten_window(df.withColumn("window", w))


def assign_windows(df: DataFrame, assigner: Column, aggs: list[Column], key=None) -> DataFrame:
    """Custom window assigner: ``assigner`` is an expression returning
    ``array<struct<start, end>>`` per row (0..n windows).  Rows with an
    empty array are dropped, as an assigner returning no window drops them."""
    keys = _keys(key)
    ex = df.withColumn("window", F.explode(assigner))
    return _flatten_window(ex.groupBy(*keys, "window").agg(*aggs))


# ----------------------------------------------------------------- sessions

def sessions(df: DataFrame, key, ts: str, gap: str, aggs: list[Column],
             seq: str = "seq", chunk=None) -> DataFrame:
    """Session windows: a new session starts when the gap to the previous
    row of the key exceeds ``gap`` (rows exactly ``gap`` apart merge).
    Output ``window_start`` = first row, ``window_end`` = last row + gap.

    Skew-safe: sessions are first cut inside (key, time chunk), then joined
    across chunk borders through a one-row-per-chunk summary, and the final
    grouping is a partial/final aggregate by (key, session number), so a
    single endless session of a hot key is still combined map-side.
    """
    keys = _keys(key)
    gap_us = parse_duration_us(gap)
    plan = resolve_chunking(df, keys, ts, chunk, (seq,))
    part = keys + ["__chunk"]
    base = plan.apply(df, ts).withColumn("__t", epoch_micros(ts))
    w = Window.partitionBy(*part).orderBy(ts, seq)
    w_run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_all = Window.partitionBy(*part)
    prev_t = F.lag("__t").over(w)
    flagged = base.withColumn(
        "__flag", F.when(prev_t.isNull() | (F.col("__t") - prev_t > gap_us), 1).otherwise(0))
    local = (flagged
             .withColumn("__lidx", F.sum("__flag").over(w_run) - 1)
             .withColumn("__k", F.sum("__flag").over(w_all))
             .withColumn("__first", F.min("__t").over(w_all))
             .withColumn("__last", F.max("__t").over(w_all)))
    if plan.single:
        # one chunk per key: local session numbers are final
        joined = local.withColumn("__sid", F.col("__lidx"))
        out = joined.groupBy(*keys, "__sid").agg(
            F.min("__t").alias("__ws"), (F.max("__t") + F.lit(gap_us)).alias("__we"), *aggs)
        return (out.withColumn("window_start", from_epoch_micros("__ws"))
                   .withColumn("window_end", from_epoch_micros("__we"))
                   .drop("__sid", "__ws", "__we"))
    summary = local.groupBy(*part).agg(F.first("__k").alias("__k"),
                                       F.first("__first").alias("__first"),
                                       F.first("__last").alias("__last"))
    wk = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    wk = wk.orderBy("__chunk")
    prev_last = F.lag("__last").over(wk)
    s_b = F.when(prev_last.isNull() | (F.col("__first") - prev_last > gap_us), 1).otherwise(0)
    summary = summary.withColumn("__s", s_b).withColumn("__starts", F.col("__k") - 1 + F.col("__s"))
    summary = summary.withColumn(
        "__base",
        F.coalesce(F.sum("__starts").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        + F.col("__s") - 1)
    summary = summary.select(*part, "__base")
    joined = local.alias("l").join(summary.alias("r"), same(part)).select("l.*", "r.__base")
    joined = joined.withColumn("__sid", F.col("__base") + F.col("__lidx"))
    out = joined.groupBy(*keys, "__sid").agg(
        F.min("__t").alias("__ws"), (F.max("__t") + F.lit(gap_us)).alias("__we"), *aggs)
    return (out.withColumn("window_start", from_epoch_micros("__ws"))
               .withColumn("window_end", from_epoch_micros("__we"))
               .drop("__sid", "__ws", "__we"))


def session_window_stream(df: DataFrame, key, ts: str, gap, aggs: list[Column]) -> DataFrame:
    """Streaming form (watermarked input): Spark's native merging session
    window; ``gap`` may be a column for dynamic gaps (merging assigner)."""
    keys = _keys(key)
    return _flatten_window(df.groupBy(*keys, F.session_window(ts, gap).alias("window")).agg(*aggs))


def merge_intervals(df: DataFrame, key, start: str, end: str, aggs: list[Column],
                    seq: str = "seq", chunk=None) -> DataFrame:
    """Merging window assigner: each row proposes ``[start, end)``; windows
    that overlap or touch merge.  Gaps-and-islands over a chunked scan of
    the running maximum end."""
    keys = _keys(key)
    chunk = resolve_chunking(df, keys, start, chunk, (seq,))
    s = scan(df, keys, start, [seq], [Scan("__maxend", "max_excl", F.col(end))], chunk=chunk,
             keep_chunk=True)
    s = s.withColumn("__new", F.when(F.col("__maxend").isNull() | (F.col(start) > F.col("__maxend")), 1)
                     .otherwise(0))
    s = scan(s, keys, start, [seq], [Scan("__gid", "sum", F.col("__new"))], chunk=chunk)
    out = s.groupBy(*keys, "__gid").agg(F.min(start).alias("window_start"),
                                         F.max(end).alias("window_end"), *aggs)
    return out.drop("__gid")


# ------------------------------------------------------------ count windows

def count_windows(df: DataFrame, key, size: int, aggs: list[Column], slide: int | None = None,
                  ts: str = "ts", seq: str = "seq", chunk=None) -> DataFrame:
    """Count windows per key in arrival order ``(ts, seq)``.

    Tumbling (``slide`` None): rows ``n*size+1 .. (n+1)*size``; only full
    windows fire.  Sliding: fires at every ``slide``-th row over the last
    ``size`` rows (fewer at the start).  Each row is copied to at most
    ``ceil(size / slide)`` windows, then a grouped aggregate runs, so no
    group is larger than ``size``.
    Output adds ``window_seq`` (row number of the firing row).
    """
    keys = _keys(key)
    r = scan(df, keys, ts, [seq], [Scan("__rn", "count", F.lit(1))], chunk=chunk)
    if slide is None:
        r = r.withColumn("window_seq", (F.floor((F.col("__rn") - 1) / size) + 1) * size)
        out = r.groupBy(*keys, "window_seq").agg(F.count(F.lit(1)).alias("__n"), *aggs)
        return out.where(F.col("__n") == size).drop("__n")
    # firing rows e are multiples of slide with rn <= e <= rn + size - 1
    first_e = F.ceil(F.col("__rn") / slide) * slide
    last_e = (F.col("__rn") + size - 1).cast("long")
    ends = F.when(first_e <= last_e,
                  F.sequence(first_e.cast("long"), last_e, F.lit(slide).cast("long"))
                  ).otherwise(F.array().cast("array<bigint>"))
    r = r.withColumn("window_seq", F.explode(ends))
    out = r.groupBy(*keys, "window_seq").agg(F.max("__rn").alias("__top"), *aggs)
    return out.where(F.col("__top") == F.col("window_seq")).drop("__top")
