"""Late-row side output on a stream (no built-in in Spark).

``foreachBatch`` over the *unwatermarked* stream: a row is late when its
event time is below the watermark in force for its batch, i.e. the maximum
event time of all earlier batches minus the delay.  That maximum is kept
with the query's progress, one row per batch id, so a restarted query (which
replays an uncommitted batch with the same id) finds the same watermark and
writes the same files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.scalar import epoch_micros, parse_duration_us
from eventide.streaming.progress import Progress


class LateSplitter:
    """Callable for ``writeStream.foreachBatch``: writes on-time rows to
    ``on_time_path`` and late rows to ``late_path`` (parquet, one folder per
    batch id, overwritten on replay: idempotent)."""

    def __init__(self, ts: str, delay: str, on_time_path: str, late_path: str, progress_path: str):
        self.ts = ts
        self.delay_us = parse_duration_us(delay)
        self.on_time_path = on_time_path
        self.late_path = late_path
        self.progress = Progress(progress_path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = self.progress.before(spark, batch_id)
        newest = last["max_us"] if last else None
        wm = None if newest is None else newest - self.delay_us
        t = epoch_micros(self.ts)
        late_cond = F.lit(False) if wm is None else (t < F.lit(wm))
        tagged = batch.withColumn("__late", late_cond)
        tagged.persist()
        try:
            (tagged.where(~F.col("__late")).drop("__late").write.mode("overwrite")
             .parquet(f"{self.on_time_path}/batch_id={batch_id}"))
            (tagged.where(F.col("__late")).drop("__late").write.mode("overwrite")
             .parquet(f"{self.late_path}/batch_id={batch_id}"))
            self.progress.put(tagged.agg(F.greatest(F.max(t), F.lit(newest).cast("long")).alias("max_us")), batch_id)
        finally:
            tagged.unpersist()
