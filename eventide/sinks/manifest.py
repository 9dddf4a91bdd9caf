"""Sinks that readers see through a commit record written last.

A batch's files go to folders of their own; then one small record names them,
created whole by a rename.  Readers open only folders that a record names, so
a batch killed before its record is invisible in all its outputs, and one with
a record is visible in all.  A replayed batch that has a record does nothing.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import fs_delete, fs_list_dirs, fs_list_files, fs_put_text, fs_read_text


class CommitLog:
    """Records by batch id in ``<root>/_commits``, one file each."""

    def __init__(self, root: str):
        self.path = f"{root.rstrip('/')}/_commits"

    def ids(self, spark: SparkSession) -> list[int]:
        return sorted(int(f) for f in fs_list_files(spark, self.path) if f.isdigit())

    def get(self, spark: SparkSession, batch_id: int) -> dict | None:
        text = fs_read_text(spark, f"{self.path}/{batch_id}")
        return None if text is None else json.loads(text)

    def put(self, spark: SparkSession, batch_id: int, record: dict) -> bool:
        return fs_put_text(spark, f"{self.path}/{batch_id}", json.dumps(record))

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        fs_delete(spark, f"{self.path}/{batch_id}")


class ManifestSink:
    """``foreachBatch`` sink with several outputs that become visible
    together.  ``outputs``: name -> function of the batch.  Every
    ``compact``-th record holds all folders so far, and the records it covers
    are removed, so readers open a bounded number of records."""

    def __init__(self, root: str, outputs: dict[str, Callable[[DataFrame], DataFrame]], compact: int = 50):
        self.root, self.outputs, self.compact = root.rstrip("/"), outputs, compact
        self.log = CommitLog(self.root)

    def _folders(self, spark: SparkSession) -> dict[str, list[str]]:
        """Committed folders of every output, oldest batch first."""
        out: dict[str, list[str]] = {name: [] for name in self.outputs}
        for batch_id in self.log.ids(spark):
            record = self.log.get(spark, batch_id)
            if record is None:
                continue
            for name, folders in record["folders"].items():
                held = out.setdefault(name, [])
                # a record that covers earlier ones may be read beside them
                held += [f for f in folders if f not in held]
        return out

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = self.log.ids(spark)
        if done and batch_id <= done[-1]:
            return
        folders = {}
        for name, make in self.outputs.items():
            folder = f"{name}/batch_id={batch_id}-{uuid.uuid4().hex[:12]}"
            make(batch).write.parquet(f"{self.root}/{folder}")
            folders[name] = [folder]
        covered = done if len(done) >= self.compact else []
        if covered:
            earlier = self._folders(spark)
            folders = {name: [*earlier.get(name, []), *folders[name]] for name in folders}
        if self.log.put(spark, batch_id, {"folders": folders}):
            for old in covered:
                self.log.forget(spark, old)

    def read(self, spark: SparkSession, name: str) -> DataFrame | None:
        """All committed rows of an output; None before the first commit."""
        folders = self._folders(spark)[name]
        return spark.read.parquet(*[f"{self.root}/{f}" for f in folders]) if folders else None

    def remove_uncommitted(self, spark: SparkSession) -> int:
        """Delete folders no record names (of killed batches); how many.  Not
        for use while a batch is being written."""
        named, gone = self._folders(spark), 0
        for name in self.outputs:
            for folder in fs_list_dirs(spark, f"{self.root}/{name}"):
                if f"{name}/{folder}" not in named[name]:
                    fs_delete(spark, f"{self.root}/{name}/{folder}")
                    gone += 1
        return gone


class DocumentStore:
    """Documents by id, replaced batch by batch: the sink form of
    :func:`eventide.sinks.basic.document_frame` rows ``(index, doc_id, doc)``.

    Documents lie in ``buckets`` buckets by a hash of their id.  A batch
    rewrites only buckets it has documents of; its commit record names every
    bucket's newest folder.  Of documents of one id within a batch the
    greatest by ``order`` (or else by text) stays."""

    def __init__(self, root: str, buckets: int = 64, order: str | None = None):
        self.root, self.buckets, self.order = root.rstrip("/"), buckets, order
        self.log = CommitLog(self.root)

    def _newest(self, spark: SparkSession) -> dict[str, str]:
        ids = self.log.ids(spark)
        return self.log.get(spark, ids[-1])["buckets"] if ids else {}

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        done = self.log.ids(spark)
        if done and batch_id <= done[-1]:
            return
        columns = ["index", "doc_id", "doc", *([self.order] if self.order else [])]
        best = F.struct(*([self.order] if self.order else []), "doc")
        new = batch.select(*columns).groupBy("index", "doc_id").agg(F.max_by(F.struct(*columns[2:]), best).alias("__d")).select(
            "index", "doc_id", "__d.*")
        new = new.withColumn("bucket", F.pmod(F.xxhash64("index", "doc_id"), F.lit(self.buckets)).cast("int"))
        newest = self._newest(spark)
        touched = [r["bucket"] for r in new.select("bucket").distinct().collect()]          # at most ``buckets``
        held = [newest[str(b)] for b in touched if str(b) in newest]
        if held:
            old = spark.read.option("basePath", self.root).schema(new.schema).parquet(*[f"{self.root}/{f}" for f in held])
            kept = old.join(new.select("index", "doc_id"), ["index", "doc_id"], "left_anti").select(*columns, "bucket")
            new = kept.unionByName(new)
        folder = f"batch_id={batch_id}-{uuid.uuid4().hex[:12]}"
        if touched:
            new.repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        self.log.put(spark, batch_id, {"buckets": {**newest, **{str(b): f"{folder}/bucket={b}" for b in touched}}})

    def read(self, spark: SparkSession) -> DataFrame | None:
        """Newest committed documents; None before the first."""
        folders = sorted(self._newest(spark).values())
        return spark.read.parquet(*[f"{self.root}/{f}" for f in folders]) if folders else None

    def remove_replaced(self, spark: SparkSession) -> int:
        """Delete folders and records that the newest commit does not use; how
        many folders.  Not for use while a batch is written or read."""
        ids, used, gone = self.log.ids(spark), set(self._newest(spark).values()), 0
        for folder in fs_list_dirs(spark, self.root):
            if folder.startswith("batch_id="):
                for bucket in fs_list_dirs(spark, f"{self.root}/{folder}"):
                    if f"{folder}/{bucket}" not in used:
                        fs_delete(spark, f"{self.root}/{folder}/{bucket}")
                        gone += 1
        for old in ids[:-1]:
            self.log.forget(spark, old)
        return gone
