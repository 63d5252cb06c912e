"""Spark session and shared-folder helpers.

Every query in the library is written so that it does not depend on the
session time zone (timestamps are handled as ``timestamp_ntz`` and epoch
seconds are computed with NTZ arithmetic), so a caller's own session works
as well as the one built here.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}
# local mode runs everything in the driver JVM; on a cluster this is ignored
# in favour of the deployment's executor sizing
_LOCAL_DRIVER_MEMORY = "8g"


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "scorecast", extra: dict | None = None) -> SparkSession:
    """Session used by tests and the benchmark.

    On a cluster the caller passes its own master and a shuffle partition
    count sized to the data (about 128-256 MB of shuffle data per task).
    """
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        conf["spark.driver.memory"] = _LOCAL_DRIVER_MEMORY
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor and the driver can read and write.

    ``spark.checkpoint.dir`` of the session wins; then a folder the caller
    gave to ``setCheckpointDir``. Only a local master (tests) gets a private
    temporary folder; on a cluster a missing setting is an error, because a
    machine-local folder would be invisible to the other machines.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    configured = tempfile.mkdtemp(prefix="scorecast-ckpt-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make reliable checkpoints go to :func:`shared_dir`; returns the folder."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(shared_dir(spark))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared folder, for written
    intermediate tables (sinks, round trips, stream inputs)."""
    return f"{shared_dir(spark)}/scorecast/{name}-{uuid.uuid4().hex}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def partitions_for(n_rows: int, rows_per_partition: int) -> int:
    """Partition count that keeps each partition near ``rows_per_partition``
    rows: grows with the data (no upper cap), at least 1. Used before
    persisting tables that iterative jobs scan many times, so the per-task
    overhead of small data does not dominate and large data stays split."""
    return max(1, -(-int(n_rows) // int(rows_per_partition)))


@contextmanager
def configured(spark: SparkSession, key: str, value: str):
    """The session with another value of a setting."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Shuffle files go as soon as the query they served has ended: for loops of
    queries whose results are written."""
    return configured(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
