"""One small row per micro-batch next to a query's checkpoint: what a
``foreachBatch`` function must remember from the batches before.  A batch
replayed after a restart has the same id, reads the row of the batch before
and writes its own again, so it finds what it found the first time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

from eventide.session import fs_list_dirs


class Progress:
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def before(self, spark: SparkSession, batch_id: int) -> Row | None:
        """The row of the newest batch before ``batch_id``; only that one
        file is read."""
        ids = [int(d.partition("=")[2]) for d in fs_list_dirs(spark, self.path) if d.startswith("part_batch=")]
        ids = [i for i in ids if i < batch_id]
        return spark.read.parquet(f"{self.path}/part_batch={max(ids)}").first() if ids else None

    def put(self, row: DataFrame, batch_id: int) -> None:
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/part_batch={batch_id}")
