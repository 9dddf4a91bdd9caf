"""Several inputs with event time in one query.

Every input has its own watermark, and the query's clock is the least of them
(``spark.sql.streaming.multipleWatermarkPolicy`` = ``min``): an input that
falls behind holds all windows open.  An input that has nothing to say can let
them go on by heartbeats, rows that carry a time alone.  They move their
input's watermark and are dropped right after it.  The clock also waits for an
input that had no row yet since the query was started or restarted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

POLICY = "spark.sql.streaming.multipleWatermarkPolicy"


def merge_inputs(inputs: list[DataFrame], ts: str, delay: str, heartbeat: str | None = None) -> DataFrame:
    """The union of streams with the same columns, each watermarked by ``ts``
    and ``delay``.  ``heartbeat`` names a boolean column that marks heartbeat
    rows (NULL: an ordinary row); it is not in the result."""
    inputs[0].sparkSession.conf.set(POLICY, "min")

    def marked(df: DataFrame) -> DataFrame:
        out = df.withWatermark(ts, delay)
        if heartbeat is None:
            return out
        # the condition names the time, so the optimizer leaves it above the
        # watermark: below it, heartbeats would be gone before they count
        never = F.col(ts) < F.lit("0001-01-01").cast("timestamp")
        return out.where(F.when(F.col(heartbeat), never).otherwise(True)).drop(heartbeat)

    return reduce(DataFrame.unionByName, [marked(df) for df in inputs])
