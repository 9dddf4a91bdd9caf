"""Rolling (running) aggregates: one output row per input row carrying the
aggregate of the key so far, in event-time order (``ts``, then ``seq``).

All are skew-safe chunked scans (:mod:`eventide.operators.scan`).  On a
stream, the per-batch form is ``groupBy(key).agg(...)`` in update mode; an
exact per-row stream uses :mod:`eventide.streaming.processors`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.growing import list_pieces, list_rows, list_view
from eventide.operators.scan import Scan, resolve_chunking, scan


def _keys(key) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def rolling_sum(df: DataFrame, key, field: str, ts: str = "ts", seq: str = "seq",
                out: str | None = None, chunk=None) -> DataFrame:
    """``keyBy(key).sum(field)``: the field becomes the running sum; the
    other fields are the current row's."""
    out = out or field
    r = scan(df, _keys(key), ts, [seq], [Scan("__rs", "sum", field)], chunk=chunk)
    return r.withColumn(out, F.col("__rs")).drop("__rs")


def _rolling_keep_first(df, keys, field, ts, seq, kind, chunk, current=()):
    """``min``/``max`` of one field; every other non-key field keeps the
    value of the key's first row (the record state starts as the first row
    and only the aggregated field is replaced).  Columns in ``current`` keep
    the value of the row being processed (e.g. an arrival id)."""
    others = [c for c in df.columns if c not in keys and c != field and c not in current]
    specs = [Scan("__agg", kind, field)]
    specs += [Scan(f"__first_{c}", "first", c) for c in others]
    r = scan(df, keys, ts, [seq], specs, chunk=chunk)
    sel = []
    for c in df.columns:
        if c == field:
            sel.append(F.col("__agg").alias(c))
        elif c in others:
            sel.append(F.col(f"__first_{c}").alias(c))
        else:
            sel.append(F.col(c))
    return r.select(*sel)


def rolling_min(df, key, field="temperature", ts="ts", seq="seq", chunk=None, current=()):
    return _rolling_keep_first(df, _keys(key), field, ts, seq, "min", chunk, tuple(current))


def rolling_max(df, key, field="temperature", ts="ts", seq="seq", chunk=None, current=()):
    return _rolling_keep_first(df, _keys(key), field, ts, seq, "max", chunk, tuple(current))


def _rolling_by(df, keys, field, ts, seq, kind, chunk, current=()):
    """``minBy``/``maxBy``: the whole row holding the extreme so far; on a
    tie the earlier row stays.  Columns in ``current`` keep the value of
    the row being processed (e.g. an arrival id)."""
    carried = [c for c in df.columns if c not in current]
    if kind == "min":
        probe = F.struct(F.col(field).alias("v"), F.col(ts).alias("t"), F.col(seq).alias("s"),
                         F.struct(*[F.col(c) for c in carried]).alias("row"))
    else:  # earliest row wins ties: order by -ts, -seq inside the max
        probe = F.struct(F.col(field).alias("v"),
                         (-F.unix_micros(F.col(ts).cast("timestamp"))).alias("t"),
                         (-F.col(seq)).alias("s"),
                         F.struct(*[F.col(c) for c in carried]).alias("row"))
    r = scan(df, keys, ts, [seq], [Scan("__by", kind, probe)], chunk=chunk)
    return r.select(*[F.col(c) if c in current else F.col(f"__by.row.{c}").alias(c)
                      for c in df.columns])


def rolling_min_by(df, key, field="temperature", ts="ts", seq="seq", chunk=None, current=()):
    return _rolling_by(df, _keys(key), field, ts, seq, "min", chunk, tuple(current))


def rolling_max_by(df, key, field="temperature", ts="ts", seq="seq", chunk=None, current=()):
    return _rolling_by(df, _keys(key), field, ts, seq, "max", chunk, tuple(current))


def rolling_reduce_min_latest(df, key, field="temperature", ts="ts", seq="seq", chunk=None):
    """``reduce((a, b) => (a.id, b.ts, min(a.t, b.t)))``: latest timestamp,
    smallest temperature so far."""
    r = scan(df, _keys(key), ts, [seq], [Scan("__m", "min", field)], chunk=chunk)
    return r.withColumn(field, F.col("__m")).drop("__m")


def rolling_concat(df, key, list_col: str, ts="ts", seq="seq", out: str | None = None, chunk=None) -> DataFrame:
    """Rolling list-concatenating reduce (``x._2 ::: y._2``), every list
    written out: quadratic in the rows of a key by definition.  For long-lived
    keys keep the deltas of :mod:`eventide.operators.growing` and view the
    rows that are read."""
    rows = list_rows(df, key, list_col, ts, seq, "__upto_n", chunk)
    view = list_view(rows, list_pieces(rows, key, list_col, "__upto_n"), key, list_col, "__grown", "__upto_n")
    out = out or list_col
    kept = [F.col("__grown").alias(c) if c == out else F.col(f"`{c}`") for c in df.columns]
    return view.select(*kept, *([] if out in df.columns else [F.col("__grown").alias(out)]))


def rolling_count_if(df, key, cond: Column, ts="ts", seq="seq", out="count",
                     overall_out: str | None = None, chunk=None) -> DataFrame:
    """Count of rows matching ``cond`` so far per key, and optionally over
    the whole input (one global order), both as chunked scans."""
    flag = F.when(cond, F.lit(1)).otherwise(F.lit(0))
    global_chunk = resolve_chunking(df, [], ts, chunk, (seq,)) if overall_out else None
    r = scan(df, _keys(key), ts, [seq], [Scan(out, "sum", flag)], chunk=chunk)
    if overall_out:
        r = scan(r, [], ts, [seq], [Scan(overall_out, "sum", flag)], chunk=global_chunk)
    return r
