"""Session settings the library depends on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def pin_utc(spark: SparkSession) -> SparkSession:
    """Hour, month, year and calendar filters follow the session zone; pin it to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def streaming_session(spark: SparkSession) -> SparkSession:
    """A sibling session for streams, with the caller's settings, on the same cluster.

    Window state lives in RocksDB, which does not need it all in memory. Setting
    that on a sibling keeps the caller's session as it was. The number of state
    partitions follows ``spark.sql.shuffle.partitions`` and is fixed by the
    first start.
    """
    sibling = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            sibling.conf.set(name, value)
    pin_utc(sibling).conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    return sibling


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Read from ``spark.checkpoint.dir``, else from the context's checkpoint
    folder. Only a local master may fall back to a machine-local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    root = context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="aerometry-")
        context.setCheckpointDir(root)
        root = context.getCheckpointDir()
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A fresh path below the shared folder; nothing exists there yet."""
    return f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def delete_tree(spark: SparkSession, path: str) -> None:
    """Remove a folder of any file system that Spark reaches; none is no error."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
