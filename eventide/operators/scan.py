"""Skew-safe ordered scans per key ("prefix scans").

Rolling aggregates, previous-row lookups, as-of lookups and sessions all need
rows of one key in event-time order.  A plain ``Window.partitionBy(key)``
puts every row of a key into one task, so a key holding a third of the data
becomes a single straggler task.  Here the order is cut into contiguous
chunks:

1. *local*: a window over ``(key, chunk)`` ordered by ``(ts, tiebreak)``;
   each task sees one bounded chunk.
2. *carry*: a partial/final aggregate per ``(key, chunk)`` (map-side
   combined, one row per chunk), then an exclusive prefix over the chunks of
   each key.  This table has one row per chunk, not per event.
3. *combine*: join the carry back on ``(key, chunk)``, NULL equal to NULL
   (the big side is already hash-partitioned on those columns), and merge
   carry with local.

Every combine here is associative, so the result equals the single-pass scan
whatever the cuts are.  Rows with a NULL key form one key, rows with a NULL
time come before all others of their key.

Cuts are row quantiles of the whole order, time and tiebreak together
(:func:`resolve_chunking`), so bursts, outliers and rows of one time do not
unbalance the chunks: a key with more than ``targetRowsPerChunk`` rows is cut
at quantiles of a sample of its own rows; every other key is one chunk.  An
order without a key is cut into as many chunks as there are shuffle
partitions.  Only rows equal in time and tiebreak are always one chunk.
Cuts are drawn once and then are data of the plan: every branch of a query
cuts alike, and no branch looks for them again.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, parse_duration_us
from eventide.session import ensure_checkpoint_dir

CHUNK_CONF = "spark.eventide.scan.chunk"
TARGET_ROWS_CONF = "spark.eventide.scan.targetRowsPerChunk"
DEFAULT_TARGET_ROWS = 4_000_000
#: A table of cuts is broadcast up to this size and shuffle-joined beyond it.
BROADCAST_BYTES = 32 << 20
#: Sampled rows for each chunk: chunks are then even to about a sixth.
SAMPLE_ROWS = 32
FEW_CUTS = 64


@dataclass(frozen=True)
class Scan:
    """One scanned output column.

    kind: sum | count | min | max | max_excl | first | last_nonnull | prev
      * min/max also order structs (min-by / max-by with a tiebreak).
      * first: value at the first row of the key.
      * last_nonnull: latest non-null value up to the row (as-of lookup).
      * prev: value of the previous row (exclusive), NULL on the first row.
    """
    name: str
    kind: str
    expr: Column | str


def _c(e) -> Column:
    return F.col(e) if isinstance(e, str) else e


def same(columns) -> Column:
    """Join condition of frames aliased ``l`` and ``r``: equal columns, NULL
    equal to NULL."""
    return reduce(lambda x, y: x & y, [F.col(f"l.`{c}`").eqNullSafe(F.col(f"r.`{c}`")) for c in columns])


@dataclass
class Chunking:
    """How rows are cut into ordered chunks: at uniform ``width`` µs, at the
    points ``cuts`` of one order, or at points for each key (``hot``: keys
    and ``__cuts``; other keys are one chunk; ``small``: it may be broadcast).
    None of them: one chunk for each key.  ``tiebreak``: the order's columns
    after the time."""
    width: int | None = None
    cuts: list[Row] | None = None
    kind: str | None = None
    hot: DataFrame | None = None
    small: bool = True
    keys: tuple = ()
    tiebreak: tuple = ()

    @property
    def single(self) -> bool:
        return self.width is None and self.cuts is None and self.hot is None

    def apply(self, df: DataFrame, ts: str) -> DataFrame:
        at = order_point(ts, self.tiebreak)
        if self.width is not None:
            chunk = F.floor(epoch_micros(ts) / F.lit(self.width)).cast("long")
        elif self.cuts is not None and len(self.cuts) <= FEW_CUTS and all(
                v is None or isinstance(v, (int, float, str)) for c in self.cuts for v in c):
            # compared one by one inside generated code
            chunk = sum((F.when(_literal(c, self.kind) <= at, 1).otherwise(0) for c in self.cuts), F.lit(0)).cast("long")
        elif self.cuts is not None:
            held = df.sparkSession.createDataFrame([(self.cuts,)], f"c array<{self.kind}>")
            df, chunk = df.withColumn("__cuts", held.scalar()), cuts_before(at)
        elif self.hot is not None:
            hot = self.hot if not self.small else F.broadcast(self.hot)
            df = df.alias("l").join(hot.alias("r"), same(self.keys), "left").select("l.*", "r.__cuts")
            chunk = F.when(F.col("__cuts").isNull(), F.lit(0).cast("long")).otherwise(cuts_before(at))
        else:
            chunk = F.lit(0).cast("long")
        out = df.withColumn("__chunk", chunk.alias("__chunk", metadata={"single": self.single})).drop("__cuts")
        if self.hot is not None and not self.small:
            # else the windows would reuse the join's partitioning, whole keys
            out = out.repartition(*self.keys, "__chunk")
        return out


def order_point(ts: str, tiebreak) -> Column:
    """A row's place in the order: NULL times come first, as windows sort."""
    return F.struct(epoch_micros(ts).alias("t"), *[F.col(c).alias(f"o{k}") for k, c in enumerate(tiebreak)])


def _literal(point: Row, kind: str) -> Column:
    return F.struct(*[F.lit(v) for v in point]).cast(kind)


def cuts_before(at: Column) -> Column:
    """How many of the sorted ``__cuts`` are at or before ``at``, by bisection."""
    n = F.size("__cuts")
    start = F.struct(F.lit(0).alias("lo"), n.alias("hi"))
    turns = F.sequence(F.lit(1), F.ceil(F.log2(n + 1)).cast("int") + 1)

    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = F.get(F.col("__cuts"), mid) <= at
        return F.when(s["lo"] >= s["hi"], s).otherwise(F.struct(
            F.when(below, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(below, s["hi"]).otherwise(mid).alias("hi")))

    found = F.aggregate(turns, start, halve, lambda s: s["lo"].cast("long"))
    return F.when(n > 0, found).otherwise(F.lit(0).cast("long"))


def _quantiles(points: Column, parts: Column) -> Column:
    """Sorted distinct cuts of a sample of ``points`` into ``parts`` parts."""
    held = F.sort_array(points)
    at = F.when(parts > 1, F.sequence(F.lit(1), parts - 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda k: F.get(held, F.floor(k.cast("long") * F.size(held) / parts).cast("int"))))


def _sampled(parts: int) -> int:
    """Rows sampled for each chunk; of very many chunks fewer, so that one
    order's sample stays at about a million points."""
    return max(4, min(SAMPLE_ROWS, 1_000_000 // parts))


def resolve_chunking(df: DataFrame, keys: list[str], ts: str, chunk=None, tiebreak=()) -> Chunking:
    """Chunking for a scan over ``df`` keyed by ``keys`` in the order of
    ``(ts, *tiebreak)``.

    Explicit widths (duration, µs, or ``spark.eventide.scan.chunk``) are
    uniform.  Auto: a keyed order is probed by one job that counts rows per
    key and brings three numbers to the driver; if there are hot keys, their
    cuts are drawn by a second one into ``spark.checkpoint.dir``.  The cuts of
    a keyless order (as many as shuffle partitions) come from one job over a
    bounded random sample.
    """
    if isinstance(chunk, Chunking):
        return chunk
    spark, at = df.sparkSession, order_point(ts, tiebreak)
    if chunk is None:
        chunk = spark.conf.get(CHUNK_CONF, "auto")
    if chunk != "auto":
        return Chunking(width=max(1, parse_duration_us(chunk)), keys=tuple(keys))
    target = int(spark.conf.get(TARGET_ROWS_CONF, str(DEFAULT_TARGET_ROWS)))
    if not keys:
        parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
        drawn = df.select(at.alias("p"), F.rand().alias("r")).orderBy("r").limit(parts * _sampled(parts))
        found = drawn.agg(_quantiles(F.collect_list("p"), F.lit(parts)).alias("c"))
        kind = found.schema["c"].dataType.elementType.simpleString()
        cuts = [c for c in found.first()["c"] or [] if c is not None]
        return Chunking(cuts=cuts, kind=kind, tiebreak=tuple(tiebreak))
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > target)
    key_bytes = F.length(F.to_json(F.struct(*keys))).cast("long")
    row = per_key.agg(F.count(F.lit(1)).alias("hot"), F.max("__n").alias("most"), F.sum(key_bytes).alias("bytes")).first()
    if not row["hot"]:
        return Chunking(keys=tuple(keys), tiebreak=tuple(tiebreak))
    most = math.ceil(row["most"] / target)
    rows = df.select(*keys, at.alias("__p")).alias("l").join(per_key.alias("r"), same(keys)).select("l.*", "r.__n")
    parts = F.ceil(F.col("__n") / target).cast("int")
    drawn = rows.where(F.rand() < _sampled(most) * parts / F.col("__n"))
    hot = drawn.groupBy(*keys).agg(F.collect_list("__p").alias("__ps"), F.max(parts).alias("__parts")).select(
        *keys, _quantiles(F.col("__ps"), F.col("__parts")).alias("__cuts"))
    ensure_checkpoint_dir(spark)
    size = (row["bytes"] or 0) + row["hot"] * 16 * most * (1 + len(tiebreak))
    return Chunking(hot=hot.checkpoint(), small=size <= BROADCAST_BYTES, keys=tuple(keys), tiebreak=tuple(tiebreak))


def scan(df: DataFrame, keys: list[str], ts: str, tiebreak: list[str],
         specs: list[Scan], chunk=None, keep_chunk: bool = False) -> DataFrame:
    """Add one column per :class:`Scan`, computed in ``(ts, *tiebreak)``
    order within each key (``keys`` may be empty: one global order).

    With ``keep_chunk`` the ``__chunk`` column stays on the output, and a following scan over
    the same keys reuses it, so its window needs no new shuffle.
    """
    order = [F.col(ts)] + [F.col(t) for t in tiebreak]
    ord_struct = F.struct(*order)
    part = list(keys) + ["__chunk"]
    if "__chunk" in df.columns:
        base = df
        single = bool(df.schema["__chunk"].metadata.get("single"))
    else:
        plan = resolve_chunking(df, list(keys), ts, chunk, tuple(tiebreak))
        single = plan.single
        base = plan.apply(df, ts)

    w_local = Window.partitionBy(*part).orderBy(*order)
    w_run = w_local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    w_prev = (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0)))
    w_prev = w_prev.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)

    local_cols, chunk_aggs, carry_cols, finals = [], [], [], []
    need_rn = any(s.kind == "prev" for s in specs)
    need_n = any(s.kind == "first" for s in specs)
    if need_rn:
        local_cols.append(F.row_number().over(w_local).alias("__rn"))
    if need_n:
        chunk_aggs.append(F.count(F.lit(1)).alias("__n"))
        carry_cols.append(F.sum("__n").over(w_prev).alias("__pn"))

    for s in specs:
        e = _c(s.expr)
        L, A, P = f"__l_{s.name}", f"__a_{s.name}", f"__p_{s.name}"
        if s.kind == "sum":
            local_cols.append(F.sum(e).over(w_run).alias(L))
            chunk_aggs.append(F.sum(e).alias(A))
            carry_cols.append(F.sum(A).over(w_prev).alias(P))
            fin = (F.when(F.col(P).isNull(), F.col(L)).when(F.col(L).isNull(), F.col(P))
                   .otherwise(F.col(P) + F.col(L)))
        elif s.kind == "count":
            local_cols.append(F.count(e).over(w_run).alias(L))
            chunk_aggs.append(F.count(e).alias(A))
            carry_cols.append(F.sum(A).over(w_prev).alias(P))
            fin = F.coalesce(F.col(P), F.lit(0)) + F.col(L)
        elif s.kind == "min":
            local_cols.append(F.min(e).over(w_run).alias(L))
            chunk_aggs.append(F.min(e).alias(A))
            carry_cols.append(F.min(A).over(w_prev).alias(P))
            fin = F.least(F.col(P), F.col(L))
        elif s.kind == "max":
            local_cols.append(F.max(e).over(w_run).alias(L))
            chunk_aggs.append(F.max(e).alias(A))
            carry_cols.append(F.max(A).over(w_prev).alias(P))
            fin = F.greatest(F.col(P), F.col(L))
        elif s.kind == "max_excl":  # max over the rows strictly before
            w_ex = w_local.rowsBetween(Window.unboundedPreceding, -1)
            local_cols.append(F.max(e).over(w_ex).alias(L))
            chunk_aggs.append(F.max(e).alias(A))
            carry_cols.append(F.max(A).over(w_prev).alias(P))
            fin = F.greatest(F.col(P), F.col(L))
        elif s.kind == "first":
            local_cols.append(F.first(e).over(w_run).alias(L))
            chunk_aggs.append(F.min_by(e, ord_struct).alias(A))
            carry_cols.append(F.first(A).over(w_prev).alias(P))
            fin = F.when(F.coalesce(F.col("__pn"), F.lit(0)) > 0, F.col(P)).otherwise(F.col(L))
        elif s.kind == "last_nonnull":
            local_cols.append(F.last(e, ignorenulls=True).over(w_run).alias(L))
            chunk_aggs.append(F.max_by(e, F.when(e.isNotNull(), ord_struct)).alias(A))
            carry_cols.append(F.last(A, ignorenulls=True).over(w_prev).alias(P))
            fin = F.coalesce(F.col(L), F.col(P))
        elif s.kind == "prev":
            local_cols.append(F.lag(e).over(w_local).alias(L))
            chunk_aggs.append(F.max_by(e, ord_struct).alias(A))
            carry_cols.append(F.last(A).over(w_prev).alias(P))
            fin = F.when(F.col("__rn") == 1, F.col(P)).otherwise(F.col(L))
        else:
            raise ValueError(f"unknown scan kind {s.kind}")
        finals.append(fin.alias(s.name))

    local = base.select("*", *local_cols)
    out_cols = [c for c in df.columns if c != "__chunk"] + (["__chunk"] if keep_chunk else [])
    if single:
        # one chunk per key: nothing to carry, every result is the local one
        return local.select(*out_cols, *[F.col(f"__l_{s.name}").alias(s.name) for s in specs])
    carry = (base.groupBy(*part).agg(*chunk_aggs)
             .select(*part, *carry_cols))
    # equi-join on (key, chunk): the big side is already hash-partitioned on
    # exactly these columns by its window, so only the carry table moves
    joined = local.alias("l").join(carry.alias("r"), same(part), "left")
    carried = [c for c in carry.columns if c not in part]
    return joined.select("l.*", *[f"r.{c}" for c in carried]).select(*out_cols, *finals)
