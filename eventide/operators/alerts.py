"""Keyed alert operators in batch form (bounded input, event-time order).

Each mirrors a per-key stateful function; the streaming twins with real
state and timers are in :mod:`eventide.streaming.processors`.  The first
reading of a key only initialises state and never alerts.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, from_epoch_micros, parse_duration_us
from eventide.operators.combine import asof_broadcast, asof_lookup
from eventide.operators.scan import Scan, resolve_chunking, same, scan


def _keys(key) -> list[str]:
    if key is None:
        return []
    return [key] if isinstance(key, str) else list(key)


def jump_alert(df: DataFrame, key="id", threshold: float = 10.0, field: str = "temperature",
               ts: str = "ts", seq: str = "seq", chunk=None) -> DataFrame:
    """Rows whose value moved more than ``threshold`` from the key's
    previous row; adds ``prev_temp`` and ``diff``."""
    s = scan(df, _keys(key), ts, [seq], [Scan("prev_temp", "prev", field)], chunk=chunk)
    s = s.withColumn("diff", F.abs(F.col(field) - F.col("prev_temp")))
    return s.where(F.col("prev_temp").isNotNull() & (F.col("diff") > threshold))


def self_cleaning_jump_alert(df: DataFrame, key="id", threshold: float = 10.0,
                             ttl: str = "1 hour", field: str = "temperature", ts: str = "ts",
                             seq: str = "seq", chunk=None) -> DataFrame:
    """Jump alert whose per-key state is dropped once a key has been silent
    for ``ttl`` (a cleanup timer re-armed by every row); after a cleanup the
    next row starts afresh."""
    ttl_us = parse_duration_us(ttl)
    s = scan(df, _keys(key), ts, [seq], [Scan("prev_temp", "prev", field),
                                         Scan("__prev_ts", "prev", ts)], chunk=chunk)
    alive = (epoch_micros(ts) - epoch_micros("__prev_ts")) < ttl_us
    s = s.withColumn("diff", F.abs(F.col(field) - F.col("prev_temp")))
    return s.where(F.col("__prev_ts").isNotNull() & alive & (F.col("diff") > threshold)).drop("__prev_ts")


def threshold_alert(data: DataFrame, updates: DataFrame, key="id", field: str = "temperature",
                    ts: str = "ts", seq: str = "seq", chunk=None) -> DataFrame:
    """Per-key thresholds arriving on a control input (``threshold`` 0.0
    deletes the key's threshold).  A data row is checked only while its key
    has a threshold; the last value is updated only by such rows.  Output
    adds ``threshold`` and ``diff`` (abs change) for rows above threshold.
    """
    keys = _keys(key)
    tagged = asof_lookup(data, updates, keys, ts, seq, ["threshold"], chunk=chunk)
    active = tagged.where(F.col("threshold").isNotNull() & (F.col("threshold") != 0.0))
    s = scan(active, keys, ts, [seq], [Scan("__prev", "prev", field)], chunk=chunk)
    s = s.withColumn("diff", F.abs(F.col(field) - F.col("__prev")))
    return s.where(F.col("__prev").isNotNull() & (F.col("diff") > F.col("threshold"))).drop("__prev")


def switch_filter(data: DataFrame, switches: DataFrame, key="id", duration_us: str = "duration_us",
                  ts: str = "ts", seq: str = "seq", chunk=None) -> DataFrame:
    """Forward data rows only while a switch of their key is open.  A
    switch row opens forwarding until ``ts + duration``; a longer expiry
    replaces a shorter one; at expiry forwarding closes (event time)."""
    keys = _keys(key)
    ctrl = switches.select(*keys, ts, seq, F.lit(0).alias("__side"),
                           (epoch_micros(ts) + F.col(duration_us)).alias("__exp"))
    d = data.withColumn("__side", F.lit(1)).withColumn("__exp", F.lit(None).cast("long"))
    u = d.unionByName(ctrl, allowMissingColumns=True)
    s = scan(u, keys, ts, ["__side", seq], [Scan("__open_until", "max", "__exp")], chunk=chunk)
    s = s.where((F.col("__side") == 1) & (epoch_micros(ts) < F.col("__open_until")))
    return s.select(*data.columns)


def fire_alert(data: DataFrame, smoke: DataFrame, threshold: float = 100.0,
               field: str = "temperature", ts: str = "ts", seq: str = "seq", chunk=None) -> DataFrame:
    """Keyed readings against one global (broadcast) smoke-level input:
    alert when the latest smoke level at or before the reading is ``High``
    and the temperature exceeds ``threshold``.  The level's changes are
    broadcast if they are small, so readings are filtered where they are read
    and never shuffled; with ``chunk`` both sides meet in a scan cut so."""
    hot = data.where(F.col(field) > threshold)
    tagged = (asof_broadcast(hot, smoke, ts, seq, ["level"]) if chunk is None
              else asof_lookup(hot, smoke, None, ts, seq, ["level"], chunk=chunk))
    return (tagged.where(F.col("level") == "High")
            .withColumn("message", F.lit("Risk of fire!")))


# ------------------------------------------------------------ rising alert

def _rising_replay(batches, interval_us: int, nkeys: int):
    """Timers of long runs: rises sorted by (key, run, t), each with the time
    at which its run ends (None: never).  The first rise of a run arms a
    timer; a rise at or after it finds it fired and arms the next.  State is
    carried across Arrow batches."""
    cur, timer, end = None, None, None
    cols = [f"k{i}" for i in range(nkeys)] + ["__run", "alert_us"]

    def last():
        return [cur + (timer,)] if cur is not None and (end is None or end >= timer) else []

    for pdf in batches:
        fired: list[tuple] = []
        keys = [pdf[f"k{i}"].tolist() for i in range(nkeys)]
        ends = [None if pd.isna(e) else int(e) for e in pdf["__end"].tolist()]
        for i, (run, t) in enumerate(zip(pdf["__run"].tolist(), pdf["__t"].tolist())):
            at = tuple(None if pd.isna(k[i]) else k[i] for k in keys) + (run,)
            if at != cur:
                fired += last()
                cur, timer, end = at, t + interval_us, ends[i]
            elif timer <= t:
                fired.append(cur + (timer,))
                timer = t + interval_us
        yield pd.DataFrame(fired, columns=cols)
    yield pd.DataFrame(last(), columns=cols)


def rising_alert(df: DataFrame, key="id", interval: str = "10 seconds", field: str = "temperature",
                 ts: str = "ts", seq: str = "seq", chunk=None, first_counts: bool = False) -> DataFrame:
    """Alert at ``t + interval`` when a reading at ``t`` rose above the
    previous one and no falling reading arrived before ``t + interval``
    (event-time timers; a timer that fired lets the next rise arm a new
    one).  Returns ``(key..., alert_ts)``.  The key's first reading only
    sets state; ``first_counts=True`` compares it with 0.0 instead, as an
    unset numeric state would read.

    Falling rows reset the logic, so a chunked scan finds previous values and
    a second numbers the runs between falls.  A run's first rise and end then
    decide all but its later timers: no alert if it ends before the first
    timer, and one if it ends before a second could fire or no rise follows
    the first timer.  Only of longer runs the rises go, in order, through
    ``mapInPandas``, because there each timer depends on the one before.
    """
    keys = _keys(key)
    interval_us = parse_duration_us(interval)
    chunk = resolve_chunking(df, keys, ts, chunk, (seq,))
    s = scan(df, keys, ts, [seq], [Scan("__prev", "prev", field)], chunk=chunk, keep_chunk=True)
    prev = F.coalesce(F.col("__prev"), F.lit(0.0)) if first_counts else F.col("__prev")
    s = s.withColumn("__rise", F.coalesce(F.col(field) > prev, F.lit(False)))
    s = s.withColumn("__fall", F.when(F.col(field) < prev, 1).otherwise(0))
    s = scan(s, keys, ts, [seq], [Scan("__run", "sum", "__fall")], chunk=chunk)
    kcols = [f"k{i}" for i in range(len(keys))]
    moves = s.where(F.col("__rise") | (F.col("__fall") == 1)).select(
        *[F.col(k).alias(c) for k, c in zip(keys, kcols)], F.col("__run"), epoch_micros(ts).alias("__t"), "__rise")
    # a falling row starts run r, that is, it ends run r - 1
    runs = moves.groupBy(*kcols, F.when(F.col("__rise"), F.col("__run")).otherwise(F.col("__run") - 1).alias("__run")).agg(
        F.min(F.when(F.col("__rise"), F.col("__t"))).alias("__first"),
        F.max(F.when(F.col("__rise"), F.col("__t"))).alias("__last"),
        F.max(F.when(~F.col("__rise"), F.col("__t"))).alias("__end"))
    timer = F.col("__first") + interval_us
    longer = (F.col("__last") >= timer) & (F.col("__end").isNull() | (F.col("__end") >= timer + interval_us))
    once = runs.where(F.col("__first").isNotNull() & ~longer & (F.col("__end").isNull() | (F.col("__end") >= timer)))
    rises = moves.where("__rise").alias("l").join(runs.where(longer).alias("r"), same([*kcols, "__run"])).select(
        *[f"l.{c}" for c in kcols], "l.__run", "l.__t", "r.__end")
    ktypes = "".join(f"{k} {rises.schema[k].dataType.simpleString()}, " for k in kcols)
    again = (rises.repartition(*kcols, "__run").sortWithinPartitions(*kcols, "__run", "__t")
             .mapInPandas(lambda it: _rising_replay(it, interval_us, len(keys)), f"{ktypes}__run long, alert_us long"))
    out = once.select(*kcols, timer.alias("alert_us")).unionByName(again.select(*kcols, "alert_us"))
    return out.select(*[F.col(c).alias(k) for k, c in zip(keys, kcols)], from_epoch_micros("alert_us").alias("alert_ts"))


def runs_of(df: DataFrame, key, cond: Column, ts: str = "ts", seq: str = "seq", chunk=None) -> DataFrame:
    """Pane ids for a data-driven trigger: rows up to and including each
    row where ``cond`` holds form one pane (``pane`` = number of firing rows
    before this one); ``fires`` marks panes that closed."""
    keys = _keys(key)
    flag = F.when(cond, 1).otherwise(0)
    s = scan(df.withColumn("__f", flag), keys, ts, [seq], [Scan("__cum", "sum", "__f")], chunk=chunk)
    return s.withColumn("pane", (F.col("__cum") - F.col("__f")).cast("long")).drop("__cum")
