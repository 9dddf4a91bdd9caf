"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)

DEFAULT_CONF = {
    # All event times are compared as UTC wall-clock values; the driver's
    # tables store TIMESTAMP_NTZ and DuckDB compares naive timestamps.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Keyed streaming state lives in RocksDB so it can exceed executor heap;
    # transformWithState requires it.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    # commit only the changelog of each batch, not a full state snapshot
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def get_session(master: str | None = None, app: str = "eventide",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to roughly input_bytes / 128 MB.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        conf.setdefault("spark.driver.memory", "16g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Operators on TIMESTAMP_NTZ columns are time-zone free; casts to
    TIMESTAMP (needed by watermarks) use the session zone, pinned to UTC."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


_LOCAL_ROOT: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints, stream state and lineage cuts.

    Read from ``spark.checkpoint.dir`` as the cluster sets it.  Only when it
    is unset (local tests) a fresh local folder is created and registered.
    """
    return ensure_checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(root)
        return root
    if sc.master in _LOCAL_ROOT:
        return _LOCAL_ROOT[sc.master]
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; a cluster needs a shared folder")
    root = tempfile.mkdtemp(prefix="eventide-ckpt-")
    sc.setCheckpointDir(root)
    _LOCAL_ROOT[sc.master] = root
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root."""
    return os.path.join(checkpoint_root(spark), f"{name}-{uuid.uuid4().hex[:12]}")


# ---------------------------------------------------------------- file system
# Folder checks go through Hadoop's FileSystem so the same code works on
# shared storage (HDFS, object stores) and on a local disk.

def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def fs_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def fs_list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isDirectory()]


def fs_read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def fs_put_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole or not at all: it is written beside its name
    and renamed.  False if a file of that name is there already."""
    fs, p = _fs_path(spark, path)
    if fs.exists(p):
        return False
    _, aside = _fs_path(spark, f"{path}.{uuid.uuid4().hex[:12]}.tmp")
    out = fs.create(aside, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if fs.rename(aside, p):
        return True
    fs.delete(aside, False)
    return False


def fs_list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty when it does not exist)."""
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return [st.getPath().getName() for st in fs.listStatus(p) if st.isFile()]


def fs_delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
