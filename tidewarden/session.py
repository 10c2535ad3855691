"""Session settings and the shared folder for written intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tidewarden.sources.folders import remove

_SETTINGS = {
    # All times are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Window state grows with the number of stations; RocksDB keeps it off the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

_given: list[str] = []


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators expect; ``extra`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**_SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder path below the one the cluster names in ``spark.checkpoint.dir``, for
    ``clear_shared`` to remove.

    Only a local session may go without that setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidewarden-")
        spark.sparkContext.setCheckpointDir(root)
    _given.append(f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}")
    return _given[-1]


def clear_shared(spark: SparkSession) -> None:
    """Removes the shared folders given out so far: results that were read from them are done with.
    """
    while _given:
        remove(spark, _given.pop())
