"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import logging
import os
import tempfile
import uuid
from datetime import datetime, timezone

from pyspark.sql import SparkSession

log = logging.getLogger(__name__)

#: Scratch folders of this process and the file system settings to remove them with.
_scratch: list[str] = []
_hadoop_conf = None

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Streaming state in RocksDB: state larger than executor memory spills to disk.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # Reliable checkpoints (lineage cuts) are removed once no longer referenced
    # (a context setting: applies when this builder creates the context).
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Each micro-batch uploads its state changes, not a full snapshot.
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "verdant",
                  shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The cluster-wide folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in a single local process
    (tests) a private folder is created and registered as the checkpoint dir.
    On a cluster an unset folder is an error: executors do not share the
    driver's own folders.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.getCheckpointDir():
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="verdant-"))
    # getCheckpointDir() is "<configured dir>/<application uuid>": use the
    # configured dir, which stays the same across applications and restarts
    return spark.sparkContext.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]


def new_run_id() -> str:
    """Sortable run id: UTC time to the microsecond plus a random suffix."""
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S%f")
    return f"r{stamp}-{uuid.uuid4().hex[:8]}"


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared root, removed when this process ends.

    Results are lazy and read their scratch tables again, also after an executor is lost, so nothing goes earlier.
    """
    global _hadoop_conf
    if _hadoop_conf is None:  # Spark's own exit handler was registered before this one, so it runs after
        atexit.register(drop_scratch)
    _hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = "/".join([shared_root(spark), "verdant", *parts, new_run_id()])
    _scratch.append(path)
    return path


def drop_scratch() -> None:
    """Remove the scratch folders made so far: results not yet read cannot be read afterwards."""
    from pyspark import SparkContext

    gateway = SparkContext._gateway
    while gateway is not None and _scratch:
        path = _scratch.pop()
        try:
            folder = gateway.jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(_hadoop_conf).delete(folder, True)
        except Exception as e:  # noqa: BLE001 - at exit the JVM may be gone; a folder that stays is named
            log.warning("scratch folder %s stays: %s", path, e)


def is_local_path(path: str) -> bool:
    return path.startswith("/") or path.startswith("file:")


def local_dir(path: str) -> str:
    return path[len("file:"):] if path.startswith("file:") else path


def ensure_local_dir(path: str) -> None:
    if is_local_path(path):
        os.makedirs(local_dir(path), exist_ok=True)


def default_table_root(spark: SparkSession) -> str:
    """Where the keyed tables live unless configured: ``<shared root>/verdant/tables``."""
    return f"{shared_root(spark)}/verdant/tables"
