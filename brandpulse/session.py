"""Session helpers.

Scratch space (stream checkpoints, staged upserts, sink tables) always lives under the
shared folder the cluster names in ``spark.checkpoint.dir``. A job never invents a
machine-local folder when that setting exists; only an unset session on a local master
gets a fresh temporary folder, registered as the context's checkpoint folder.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_STORE = "spark.sql.streaming.stateStore"
#: State of streams lies in RocksDB, on the executors' disks. Its memory has one bound for all the stores of an executor,
#: where Spark's default provider holds every key in two versions on the heap.
STATE_STORE = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.boundedMemoryUsage": "true",
    f"{_STORE}.rocksdb.maxMemoryUsageMB": "96",
    f"{_STORE}.rocksdb.writeBufferSizeMB": "16",
}
_starting = threading.RLock()


def get_spark(master: str | None = None, app: str = "brandpulse", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Session with the settings the library relies on (UTC, AQE, no UI).

    ``master`` and ``shuffle_partitions`` are only applied when given, so that on a
    cluster the submitter's settings win.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # A broadcast side must have a known bound; 32 MB covers lexicons, keyword
        # tables and alert tables while keeping executors safe.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
        **STATE_STORE,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


@contextmanager
def state_store(spark: SparkSession) -> Iterator[None]:
    """Streams that are started inside keep their state as :data:`STATE_STORE` says, in whichever session the
    submitter made. What that session sets itself holds, and a checkpoint keeps the provider it began with."""
    with _starting:    # a query takes its copy of the settings when it starts
        unset = [k for k in STATE_STORE if spark.conf.get(k, None) is None]
        for k in unset:
            spark.conf.set(k, STATE_STORE[k])
        try:
            yield
        finally:
            for k in unset:
                spark.conf.unset(k)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared scratch root that ``spark.checkpoint.dir`` names.

    Where it is unset, a folder is made only for a ``local[..]`` master, whose driver and
    executors are one process (tests, a laptop); on any cluster the job stops, because
    executors would write to disks of their own and the driver would read nothing.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="brandpulse-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str, fresh: bool = True) -> str:
    """A sub-folder of the shared scratch root. ``fresh`` adds a unique suffix so that
    repeated runs never reuse (or need to delete) an earlier run's files."""
    root = checkpoint_root(spark).rstrip("/")
    leaf = f"{name}-{uuid.uuid4().hex[:12]}" if fresh else name
    path = f"{root}/brandpulse/{leaf}"
    return path
