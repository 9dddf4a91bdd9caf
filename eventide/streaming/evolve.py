"""Start a changed job from the state another one saved.

A stopped query's checkpoint holds its state and which input files it read.
:func:`saved_state` reads the state as a table, to be the initial state of a
new query (with its own checkpoint and another processor, state schema or
output), and :func:`unread` drops the rows of files that were read already, so
that nothing is lost or counted twice.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StructField, StructType


def saved_state(spark: SparkSession, checkpoint: str, variable: str, operator: int = 0) -> DataFrame:
    """``key`` fields and ``value`` fields of a state variable after the last
    committed batch of a stopped query."""
    state = (spark.read.format("statestore").option("path", checkpoint).option("operatorId", operator)
             .option("stateVarName", variable).load())
    return state.select("key.*", "value.*")


def unread(stream: DataFrame, checkpoint: str, source: int = 0) -> DataFrame:
    """``stream``, from files, without the rows of files that the query of
    ``checkpoint`` read from its ``source``-th input (they are read once more
    and skipped).  The list of files stays in Spark."""
    spark = stream.sparkSession
    log = spark.read.text(f"{checkpoint}/sources/{source}").where(F.col("value").startswith("{"))
    path = F.regexp_replace(F.get_json_object("value", "$.path"), "^file:/+", "file:/")
    done = log.select(path.alias("__done")).distinct()
    here = F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "file:/")
    columns = [F.col(f"`{c}`") for c in stream.columns]
    return stream.select("*", here.alias("__file")).join(done, F.col("__file") == F.col("__done"), "left_anti").select(*columns)


_TOTALS = StructType([StructField("cnt", LongType()), StructField("total", DoubleType())])
_WIDER = StructType([*_TOTALS.fields, StructField("high", DoubleType())])


class RunningTotals(StatefulProcessor):
    """Count and sum of ``temperature`` per key so far, one row a batch."""

    OUTPUT = "id string, cnt long, total double"
    STATE = _TOTALS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("totals", self.STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cnt, total = self.held.get() if self.held.exists() else (0, 0.0)
        for r in rows:
            cnt, total = cnt + 1, total + r.temperature
        self.held.update((cnt, total))
        return iter([Row(id=str(key[0]), cnt=cnt, total=total)])

    def close(self) -> None:
        pass


class RunningTotalsWithHigh(RunningTotals):
    """The changed job: its state and output have one more column, the
    highest value since the change (NULL before the first)."""

    OUTPUT = "id string, cnt long, total double, high double"
    STATE = _WIDER

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.held.update((initialState["cnt"], initialState["total"], None))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cnt, total, high = self.held.get() if self.held.exists() else (0, 0.0, None)
        for r in rows:
            cnt, total = cnt + 1, total + r.temperature
            high = r.temperature if high is None else max(high, r.temperature)
        self.held.update((cnt, total, high))
        return iter([Row(id=str(key[0]), cnt=cnt, total=total, high=high)])


def apply_from(stream: DataFrame, processor: StatefulProcessor, state: DataFrame, key: str = "id", time_mode: str = "None") -> DataFrame:
    """``transformWithState`` that starts from ``state`` (one row a key)."""
    return stream.groupBy(key).transformWithState(processor, processor.OUTPUT, "Append", time_mode, initialState=state.groupBy(key))
