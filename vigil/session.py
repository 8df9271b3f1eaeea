"""SparkSession builder and shared-folder helpers.

Cluster settings (executor counts, memory) come from the submitting environment;
this module only fixes what the semantics depend on: UTC session time, ANSI mode,
adaptive execution with skew-join splitting, and the RocksDB state store.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the library's results or plans depend on.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the size check for broadcast joins: Catalyst broadcasts a side whose
    # estimated size (plan time) or measured size (AQE, runtime) is at most this
    "spark.sql.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "vigil",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    ``master`` is only set when given (tests, bench); on a cluster the
    submitter decides. ``spark.checkpoint.dir`` is left to the cluster and set
    to a local folder only when nothing is configured (local tests).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_runtime_conf(spark)
    return spark


def apply_runtime_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings on a session created elsewhere."""
    for k in ("spark.sql.session.timeZone", "spark.sql.adaptive.enabled",
              "spark.sql.adaptive.skewJoin.enabled"):
        spark.conf.set(k, CORE_CONF[k])


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]):
    """``wanted`` holds in the block; then the session is as before."""
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None):
    """Queries started in the block keep their state in RocksDB, whatever the session's store is, in ``partitions``
    partitions where given (a query keeps the settings that it starts with)."""
    wanted = {"spark.sql.streaming.stateStore.providerClass": CORE_CONF["spark.sql.streaming.stateStore.providerClass"]}
    if partitions:
        wanted["spark.sql.shuffle.partitions"] = str(partitions)
    with _settings(spark, wanted):
        yield


# One limit for the block cache and the write buffers of all stores of an executor, below the memory that executors get
# beside their heap (``spark.executor.memoryOverhead``: 384 MB or more)
JOIN_STATE_MEMORY_MB = 200


@contextmanager
def join_state(spark: SparkSession):
    """Joins of streams started in the block keep their state on local disk instead of the executors' heap, whatever the
    session's store is, in memory with one limit (a soft one: see the README's figures). A checkpoint keeps the store it
    began with.

    A partition has one RocksDB store, not four. A commit writes the store's buffers as files: with a log of changes
    (``changelogCheckpointing``) they would stay in memory for every store that waits for its next batch."""
    prefix = "spark.sql.streaming.stateStore"
    limit = f"{prefix}.rocksdb.maxMemoryUsageMB"
    with _settings(spark, {
        f"{prefix}.providerClass": CORE_CONF[f"{prefix}.providerClass"],
        "spark.sql.streaming.join.stateFormatVersion": "3",
        f"{prefix}.rocksdb.boundedMemoryUsage": "true",
        limit: spark.conf.get(limit, str(JOIN_STATE_MEMORY_MB)),
        f"{prefix}.rocksdb.changelogCheckpointing.enabled": "false",
        f"{prefix}.rocksdb.allowFAllocate": "false",            # else 4 MB of disk for each store, however small
    }):
        yield


def shared_dir(spark: SparkSession) -> str:
    """Base folder shared by the cluster (``spark.checkpoint.dir``).

    Read from the session; only when it is unset (local tests) a local folder
    is created and registered as the checkpoint dir.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="vigil-ckpt-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the shared folder (never reused)."""
    base = shared_dir(spark)
    path = f"{base}/vigil/{name}-{uuid.uuid4().hex[:12]}"
    if "://" not in path or path.startswith("file:"):
        os.makedirs(path.replace("file:", ""), exist_ok=True)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``vigil`` importable in the Python workers (needed by the pandas
    functions of the stateful scorer): zip the package into the shared folder
    and add it with ``addPyFile``, once per application.

    On a cluster the package is usually shipped with ``spark-submit
    --py-files`` or installed on the executors; when the shared folder is not
    a local path, nothing is done here.
    """
    import zipfile

    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect): ship with the client's artifacts
        return
    if app in _SHIPPED:
        return
    base = shared_dir(spark)
    if "://" in base and not base.startswith("file:"):
        return
    folder = fresh_dir(spark, "pyfiles").replace("file:", "")
    target = f"{folder}/vigil.zip"
    root = os.path.dirname(os.path.abspath(__file__))
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.join("vigil", os.path.relpath(full, root)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
