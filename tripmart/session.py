"""Spark session settings the marts rely on.

The trip columns are wall-clock times without a zone (TIMESTAMP_NTZ); second
differences are taken after truncating to the second, which Spark evaluates
through the session time zone, so the session must run in UTC or daylight
saving gaps would change durations.  ANSI mode stays on (Spark 4 default) so
bad casts and decimal overflow fail loudly instead of producing NULLs.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session running the marts must carry.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition-replace writes touch only the partitions present in the data.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles a method above 8000 bytes; such a stage runs as separate
    # operators, whose code Spark splits, rather than interpreted.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

#: A task reads at most so many bytes of files: the dedup keeps the rows a task has read until
#: they are shuffled, nine million in 128 MB of raw trips, and would sort and spill them.
READ_BYTES_CONF, READ_BYTES = "spark.sql.files.maxPartitionBytes", 32 << 20


def build_session(master: str | None = None, app_name: str = "tripmart",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings the marts need.

    On a cluster, leave ``shuffle_partitions`` unset and let AQE coalesce the
    default; locally, set it near the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:  # on a cluster the launcher sets the master
        builder = builder.master(master)
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the required SQL settings to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    if spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes() > READ_BYTES:
        spark.conf.set(READ_BYTES_CONF, str(READ_BYTES))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged writes.

    Reads ``spark.checkpoint.dir`` from the session (the cluster names a
    shared folder there) or the context's checkpoint folder.  Only when both
    are unset and driver and executors are one process -- local tests -- a
    fresh local folder is made; on a cluster a machine-local folder would lose
    rows, so that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if sc.master != "local" and not sc.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="tripmart-ckpt-")
    sc.setCheckpointDir(local)
    return local


def staging_path(spark: SparkSession, name: str) -> str:
    """A unique path under the shared checkpoint folder for a staged table."""
    import uuid

    return os.path.join(checkpoint_dir(spark), "staged", f"{name}-{uuid.uuid4().hex}")
