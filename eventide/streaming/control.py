"""A control input for all keys of a stream (broadcast state).

``foreachBatch`` over the union of readings and control rows: inside a batch
every reading meets the latest control row at or before it in event time, and
the batch's last control row is kept with the query's progress for the next.
The state is one row, whatever the number of keys, and no key is tied to a
task.  Rows are expected in event-time order from batch to batch (sort first,
or let a watermark hold them back), as for any ordered control input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.operators.alerts import fire_alert
from eventide.streaming.progress import Progress


class FireAlerts:
    """Callable for ``writeStream.foreachBatch``: the stream form of
    :func:`eventide.operators.alerts.fire_alert`.  Rows whose ``level`` is not
    NULL are control rows.  Alerts go to ``alert_path``, one folder per batch
    id, overwritten on replay."""

    def __init__(self, alert_path: str, progress_path: str, threshold: float = 100.0,
                 field: str = "temperature", ts: str = "ts", seq: str = "seq"):
        self.alert_path, self.progress = alert_path, Progress(progress_path)
        self.threshold, self.field, self.ts, self.seq = threshold, field, ts, seq

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn(self.ts, F.col(self.ts).cast("timestamp_ntz"))
        control = rows.where("level IS NOT NULL").select(self.ts, self.seq, "level")
        last = self.progress.before(spark, batch_id)
        if last is not None and last["level"] is not None:
            control = control.unionByName(spark.createDataFrame([last], control.schema))
        alerts = fire_alert(rows.where("level IS NULL").drop("level"), control, self.threshold, self.field, self.ts, self.seq)
        alerts.write.mode("overwrite").parquet(f"{self.alert_path}/batch_id={batch_id}")
        latest = F.max(F.struct(self.ts, self.seq, "level")).alias("c")
        self.progress.put(control.agg(latest).select(*[F.col(f"c.{c}").alias(c) for c in (self.ts, self.seq, "level")]), batch_id)
