"""Two-input operators: interval join, window join, window co-group and
as-of (latest-control-row) lookups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, from_epoch_micros, parse_duration_us
from eventide.operators.keys import BROADCAST_BYTES
from eventide.operators.scan import Scan, scan
from eventide.operators.windows import window_rows


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def interval_join(left: DataFrame, right: DataFrame, key, left_ts: str, right_ts: str,
                  lower: str, upper: str, bin_width: str | None = None) -> DataFrame:
    """Inner interval join: same key and ``right_ts`` in
    ``[left_ts + lower, left_ts + upper]`` (both bounds inclusive).

    Both sides are cut into time bins of ``bin_width`` (default: the
    interval length); a left row is copied to the at most two bins its
    interval touches, so pairs are only formed inside (key, bin) and a hot
    key is spread over its bins instead of forming one group.
    Column names of the two sides must not collide (except the key).
    """
    keys = _keys(key)
    lo, hi = parse_duration_us(lower), parse_duration_us(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    width = parse_duration_us(bin_width) if bin_width else max(hi - lo, 1_000_000)
    lt = epoch_micros(left_ts)
    first_b = F.floor((lt + lo) / width).cast("long")
    last_b = F.floor((lt + hi) / width).cast("long")
    l2 = left.withColumn("__bin", F.explode(F.sequence(first_b, last_b)))
    r2 = right.withColumn("__bin", F.floor(epoch_micros(right_ts) / width).cast("long"))
    rt = epoch_micros(F.col(right_ts))
    cond = (rt >= epoch_micros(F.col(left_ts)) + lo) & (rt <= epoch_micros(F.col(left_ts)) + hi)
    return l2.join(r2, keys + ["__bin"], "inner").where(cond).drop("__bin")


def stream_interval_join(left: DataFrame, right: DataFrame, key, left_ts: str, right_ts: str,
                         lower: str, upper: str, left_delay: str, right_delay: str) -> DataFrame:
    """:func:`interval_join` of two streams (event times are TIMESTAMP).  Each
    side may be late by its delay; the watermarks and the time bounds of the
    condition let Spark drop a row from state once no partner can come."""
    keys = _keys(key)
    if parse_duration_us(upper) < parse_duration_us(lower):
        raise ValueError("upper bound below lower bound")
    l2 = left.withWatermark(left_ts, left_delay).alias("l")
    r2 = right.withWatermark(right_ts, right_delay).select(
        *[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys]).alias("r")
    met = F.expr(f"{right_ts} >= {left_ts} + INTERVAL {lower} AND {right_ts} <= {left_ts} + INTERVAL {upper}")
    for k in keys:
        met = met & (F.col(f"l.{k}") == F.col(f"__r_{k}"))
    return l2.join(r2, met).drop(*[f"__r_{k}" for k in keys])


def window_join(left: DataFrame, right: DataFrame, key, left_ts: str, right_ts: str,
                size: str, right_aggs: list[Column], slide: str | None = None) -> DataFrame:
    """Window join, pair-free: every left row with the right side's rows of
    the same key and window, reduced by ``right_aggs`` (inner: windows with
    no right row drop the left row).

    The literal form would emit all pairs of a (key, window), which is
    quadratic in a hot group; here the right side is first reduced to one
    row per (key, window) (partial aggregation) and joined on
    (key, window), so the output has one row per matching left row."""
    keys = _keys(key)
    on = keys + ["window_start", "window_end"]
    lw = window_rows(left, left_ts, size, slide)
    ra = window_rows(right, right_ts, size, slide).groupBy(*on).agg(*right_aggs)
    return lw.join(ra, on, "inner")


def window_cogroup(left: DataFrame, right: DataFrame, key, left_ts: str, right_ts: str,
                   size: str, left_aggs: list[Column], right_aggs: list[Column],
                   slide: str | None = None) -> DataFrame:
    """Co-group per (key, window): both sides reduced to aggregates first
    (partial aggregation), then a full outer join, so a window with rows on
    one side only still appears with the other side's aggregates NULL."""
    keys = _keys(key)
    on = keys + ["window_start", "window_end"]
    la = window_rows(left, left_ts, size, slide).groupBy(*on).agg(*left_aggs)
    ra = window_rows(right, right_ts, size, slide).groupBy(*on).agg(*right_aggs)
    return la.join(ra, on, "full_outer")


def asof_lookup(data: DataFrame, control: DataFrame, key, ts: str, seq: str,
                value_cols: list[str], chunk=None) -> DataFrame:
    """For each data row, the values of the latest control row at or before
    it (same key; ``key=None`` means one global control stream, as a
    broadcast control input).  A control row at the same timestamp comes
    first.  Both inputs carry ``ts`` and ``seq``; output columns are
    ``value_cols`` added to the data rows (NULL before any control row).

    A tagged union plus one chunked scan: no per-key single task and no
    pair enumeration.
    """
    keys = _keys(key)
    probe = F.struct(*[F.col(c) for c in value_cols])
    d = data.withColumn("__side", F.lit(1)).withColumn("__probe", F.lit(None).cast(
        control.select(probe.alias("p")).schema["p"].dataType))
    c = control.select(*keys, ts, seq, F.lit(0).alias("__side"), probe.alias("__probe"))
    u = d.unionByName(c, allowMissingColumns=True)
    s = scan(u, keys, ts, ["__side", seq], [Scan("__asof", "last_nonnull", "__probe")], chunk=chunk)
    s = s.where(F.col("__side") == 1)
    return s.select(*[x for x in data.columns], *[F.col(f"__asof.{v}").alias(v) for v in value_cols])


#: Stands for no time: before all others.
NO_TIME = -(1 << 62)


def change_points(control: DataFrame, ts: str, seq: str, value_cols: list[str]) -> DataFrame:
    """A control input for all keys as the points where its values change:
    ``(t, v)`` with ``t`` in µs (rows without a time are before all others)
    and the values in a struct.  Of rows at one time the last counts; a row
    that repeats the values before it is no change."""
    values = F.struct(*[F.col(c) for c in value_cols])
    last = control.groupBy(F.col(ts).alias("at")).agg(F.max_by(F.struct(values.alias("v")), F.struct(seq)).alias("held"))
    moved = scan(last, [], "at", [], [Scan("before", "prev", "held")])
    return moved.where(F.col("before").isNull() | ~F.col("before.v").eqNullSafe(F.col("held.v"))).select(
        F.coalesce(epoch_micros("at"), F.lit(NO_TIME)).alias("t"), "held.v")


def asof_broadcast(data: DataFrame, control: DataFrame, ts: str, seq: str, value_cols: list[str],
                   most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """As :func:`asof_lookup` without a key: every data row with the values
    of the latest control row at or before it.  Data rows stay where they are:
    the control input's change points are measured and, up to ``most_bytes``,
    sent to every task, spread over as many time buckets as there are points
    (a point is in each bucket in which it holds: together at most twice as
    many rows).  Beyond that size data and control meet in a scan instead."""
    points = change_points(control, ts, seq, value_cols)
    size = F.sum(F.length(F.to_json(F.struct("t", "v"))).cast("long"))
    row = points.agg(F.count(F.lit(1)).alias("n"), size.alias("bytes"), F.max("t").alias("hi"),
                     F.min(F.when(F.col("t") > NO_TIME, F.col("t"))).alias("lo")).first()
    if (row["bytes"] or 0) > most_bytes:
        return asof_lookup(data, control, None, ts, seq, value_cols)
    n, lo = row["n"], row["lo"] or 0
    width = max(1, (row["hi"] - lo) // n + 1) if n and row["lo"] is not None else 1

    def bucket(t: Column) -> Column:
        return F.least(F.greatest(F.floor((t - F.lit(lo)) / F.lit(width)), F.lit(0)), F.lit(n)).cast("long")

    until = F.lead("t").over(Window.orderBy("t"))       # of points that fit the bound
    held = points.select("t", "v", until.alias("until"))
    last = F.when(F.col("until").isNull(), F.lit(n).cast("long")).otherwise(bucket(F.col("until") - 1))
    held = held.select(F.explode(F.sequence(bucket(F.col("t")), last)).alias("__bucket"), F.col("t").alias("__from"),
                       F.col("until").alias("__until"), F.col("v").alias("__v"))
    rows = data.withColumn("__t", F.coalesce(epoch_micros(ts), F.lit(NO_TIME)))
    met = ((bucket(F.col("__t")) == F.col("__bucket")) & (F.col("__t") >= F.col("__from"))
           & (F.col("__until").isNull() | (F.col("__t") < F.col("__until"))))
    return rows.join(F.broadcast(held), met, "left").select(*data.columns, *[F.col(f"__v.{c}").alias(c) for c in value_cols])
