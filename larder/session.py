"""SparkSession construction and shared-folder helpers."""

from __future__ import annotations

import os
import tempfile
import threading
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, ANSI arithmetic (bad casts and
# division by zero raise, like the warehouse), adaptive execution for runtime
# re-planning (partition coalescing, skew splitting, broadcast conversion).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Runtime Bloom filters for joins whose selective side is too large to broadcast:
# up to 512 MB of keys (estimated), 8 MB of filter, good for some 8 million keys.
# They are built only for scans above Spark's own threshold of 10 GB.
RUNTIME_FILTER_CONF = {
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": str(512 << 20),
    "spark.sql.optimizer.runtime.bloomFilter.expectedNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumItems": "8000000",
    "spark.sql.optimizer.runtime.bloomFilter.numBits": str(1 << 26),
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": str(1 << 26),
}

# Adaptive execution merges shuffle partitions down to this size, not the default
# 1 MB: a write into thousands of day folders costs by the file, and with
# all of a small table in one task it would create them one after another.
WRITE_CONF = {"spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}

# A join partition above this size and five times the median is split, not one above
# Spark's own 256 MB: a key that many rows share (a promotion code of a seventh of the
# orders) would be sorted by one task, its memory growing with the table until then.
# Pieces have the advisory size.
SKEW_CONF = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16m"}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "larder", extra: dict | None = None) -> SparkSession:
    """Local/test session builder. On a cluster the submitter's conf wins;
    only unset keys are filled in here."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    # Day-partitioned tables have many directories; list them with one task
    # per core rather than one per directory.
    conf["spark.sql.sources.parallelPartitionDiscovery.parallelism"] = str(_cores(master))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _cores(master: str | None) -> int:
    if master and master.startswith("local[") and master[6:-1].isdigit():
        return int(master[6:-1])
    return os.cpu_count() or 8


def apply_core_conf(spark: SparkSession) -> None:
    """Set the semantic settings on an existing session (e.g. the driver's)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled",
              "spark.sql.sources.partitionOverwriteMode"):
        spark.conf.set(k, CORE_CONF[k])
    for k, v in (RUNTIME_FILTER_CONF | WRITE_CONF | SKEW_CONF).items():
        spark.conf.set(k, v)


#: Spark's setting by which a query deletes its shuffle files when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_FREEING: dict = {}
_FREEING_LOCK = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Writes started inside delete their shuffle files as soon as they are done.
    Spark alone does so when the driver's garbage collector meets the query, which
    on a quiet driver may be never. For writes that are read back from
    their files only: a query run again would miss its shuffles. Threads
    of one session may overlap; the last one out restores the setting."""
    key = spark._jsparkSession.sessionUUID()
    with _FREEING_LOCK:
        users, before = _FREEING.get(key) or (0, spark.conf.get(FREE_SHUFFLES, None))
        _FREEING[key] = (users + 1, before)
        spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        with _FREEING_LOCK:
            users, before = _FREEING.pop(key)
            if users > 1:
                _FREEING[key] = (users - 1, before)
            elif before is None:
                spark.conf.unset(FREE_SHUFFLES)
            else:
                spark.conf.set(FREE_SHUFFLES, before)


def scale_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Starting settings for a cluster run over ``input_bytes`` of Parquet.

    Shuffles start with about one partition per 128 MB of input (at least
    two per core) and AQE coalesces them towards the advisory size at
    runtime, so each reducer's share fits in executor memory; skewed
    join partitions (``SKEW_CONF``) are split."""
    parts = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder is configured by the submitter and must be a
    shared file system (an unset folder is an error there); only in local
    mode (runs and tests) is an unset folder filled in with a fresh scratch
    directory.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local"):
            # A machine-local folder is not visible to other executors.
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        conf_dir = tempfile.mkdtemp(prefix="larder-ckpt-", dir=os.environ.get("LARDER_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", conf_dir)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables inside the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
