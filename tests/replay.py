"""Maker of file-stream fixtures."""

from __future__ import annotations

import glob
import os
import shutil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stage_replay(df: DataFrame, folder: str, n_files: int, order: list[str],
                 file_of=None) -> list[str]:
    """Write ``df`` as up to ``n_files`` parquet files in ``folder``, cut by
    ``order`` into contiguous ranges (range partitioning), with modification
    times that make a file stream take them in order.  ``file_of`` may give
    an explicit file-number column (for disordered replays).  ``folder`` must be a fresh folder."""
    os.makedirs(folder, exist_ok=True)
    tmp = folder.rstrip("/") + "-staging"
    if file_of is None:
        staged = df.repartitionByRange(n_files, *order).withColumn("__file", F.spark_partition_id())
    else:
        staged = df.withColumn("__file", file_of)
    (staged.repartition("__file").sortWithinPartitions(*order)
     .write.mode("overwrite").partitionBy("__file").parquet(tmp))
    paths = []
    base_time = 1_700_000_000
    for i in range(n_files):
        parts = sorted(glob.glob(os.path.join(tmp, f"__file={i}", "*.parquet")))
        for j, part in enumerate(parts):
            out = os.path.join(folder, f"batch-{i:05d}-{j:03d}.parquet")
            shutil.copyfile(part, out)
            os.utime(out, (base_time + 10 * len(paths), base_time + 10 * len(paths)))
            paths.append(out)
    return paths
