"""User accumulators with map-side merging.

An accumulator lifts a row to named state fields, merges states with an
associative aggregate per field and turns the merged state into a result.
Because every merge is a Spark aggregate, states are combined before the
shuffle: a hot key costs one partial state for each input partition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventide.operators.windows import window_agg


@dataclass(frozen=True)
class Accumulator:
    """``add``: state field -> (value a row adds, merging aggregate such as
    ``F.sum`` or ``F.max``); ``result``: output column -> function of the
    merged fields (a dict of columns).  The empty state is the aggregate's own
    value for no rows.

    ``merge``: state field -> aggregate that joins two of its states, where
    that is not the aggregate that made them (counts are joined by their sum).
    A field whose aggregate cannot join states (an average, a distinct count)
    has ``None``; then states cannot be merged, only worked out again."""
    add: dict[str, tuple[Column, Callable[[Column], Column]]]
    result: dict[str, Callable[[dict[str, Column]], Column]]
    merge: dict[str, Callable[[Column], Column] | None] = field(default_factory=dict)

    def states(self) -> list[Column]:
        return [add(value).alias(f"__{name}") for name, (value, add) in self.add.items()]

    def joins(self, name: str) -> Callable[[Column], Column] | None:
        """The aggregate that joins states of a field."""
        if name in self.merge:
            return self.merge[name]
        add = self.add[name][1]
        if add is F.count:
            return F.sum
        return add if add in (F.sum, F.min, F.max, F.bit_or, F.bit_and, F.bool_or, F.bool_and, F.hll_union_agg) else None

    @property
    def mergeable(self) -> bool:
        return all(self.joins(name) for name in self.add)

    def merged(self) -> list[Column]:
        """Aggregates over rows of states."""
        return [self.joins(name)(F.col(f"__{name}")).alias(f"__{name}") for name in self.add]

    def finish(self, merged: DataFrame) -> DataFrame:
        fields = {name: merged[f"__{name}"] for name in self.add}
        kept = [c for c in merged.columns if c[2:] not in self.add or not c.startswith("__")]
        return merged.select(*kept, *[f(fields).alias(name) for name, f in self.result.items()])


def accumulate(df: DataFrame, key, acc: Accumulator) -> DataFrame:
    """One result row per key."""
    keys = [key] if isinstance(key, str) else list(key or [])
    return acc.finish(df.groupBy(*keys).agg(*acc.states()))


def window_accumulate(df: DataFrame, key, ts: str, size: str, acc: Accumulator, **window) -> DataFrame:
    """One result row per key and time window."""
    return acc.finish(window_agg(df, key, ts, size, acc.states(), **window))
