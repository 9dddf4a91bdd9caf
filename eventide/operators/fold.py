"""Ordered folds of a key or window, as a scan of composable pieces.

A fold is given by what a row lifts to, an associative ``combine`` of two
neighbouring states (the earlier first) and what a state finishes to.  Rows of
a group are numbered in order inside the chunks of the skew-safe scans; 16
neighbouring states at a time become one, inside the chunk's own partition, so
nothing is shuffled and no task holds a whole group; what is left of a hot
group's chunks is combined in order at the end, one state for each 65,536
rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.operators.scan import resolve_chunking
from eventide.operators.windows import window_rows

FAN = 16            # neighbouring states combined at a time
ROUNDS = 4          # inside a chunk


@dataclass(frozen=True)
class Fold:
    """``lift``: a row's state; ``combine(earlier, later)``: associative, of
    the state's type; ``finish``: result of the whole group's state."""
    lift: Column
    combine: Callable[[Column, Column], Column]
    finish: Callable[[Column], Column] = lambda state: state

    def over(self, states: Column) -> Column:
        """One state (in a struct ``v``) of an ordered array of such."""
        return F.aggregate(F.slice(states, 2, F.greatest(F.size(states) - 1, F.lit(0))), F.get(states, F.lit(0)),
                           lambda a, b: F.struct(self.combine(a["v"], b["v"]).alias("v")))


def ordered_fold(df: DataFrame, key, ts: str, tiebreak: list[str], fold: Fold, out: str, chunk=None) -> DataFrame:
    """``(key..., out)``: each key's rows folded in ``(ts, *tiebreak)`` order.
    NULL keys are one key, NULL times come first; the order of rows equal in
    time and tiebreak is not defined."""
    keys = [key] if isinstance(key, str) else list(key or [])
    plan = resolve_chunking(df, keys, ts, chunk, tuple(tiebreak))
    part = [*keys, "__chunk"]
    lifted = plan.apply(df.withColumn("__v", F.struct(fold.lift.alias("v"))), ts)
    place = F.row_number().over(Window.partitionBy(*part).orderBy(ts, *tiebreak)).cast("long") - 1
    states = lifted.select(*part, place.alias("__at"), "__v")
    kind = states.schema["__v"].dataType
    for _ in range(ROUNDS):
        slots = [F.any_value(F.when(F.col("__at") % FAN == k, F.col("__v")), F.lit(True)).alias(f"__s{k}") for k in range(FAN)]
        block = F.floor(F.col("__at") / FAN).cast("long").alias("__block")
        met = F.filter(F.array(*[F.col(f"__s{k}") for k in range(FAN)]), lambda s: s.isNotNull())
        states = states.groupBy(*part, block).agg(*slots).select(
            *part, F.col("__block").alias("__at"), fold.over(met).cast(kind).alias("__v"))
    rest = states.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.col("__chunk"), F.col("__at"), F.col("__v")))).alias("__p"))
    whole = fold.over(F.transform("__p", lambda p: p["__v"]))
    return rest.select(*keys, fold.finish(whole["v"]).alias(out))


def window_fold(df: DataFrame, key, ts: str, size: str, tiebreak: list[str], fold: Fold, out: str, chunk=None, **window) -> DataFrame:
    """``(key..., window_start, window_end, out)``: an ordered fold of each
    key and time window."""
    keys = [key] if isinstance(key, str) else list(key or [])
    return ordered_fold(window_rows(df, ts, size, **window), [*keys, "window_start", "window_end"], ts, tiebreak, fold, out, chunk)
