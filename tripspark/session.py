"""Session helpers: the shared scratch folder.

Intermediate tables (round-trip copies, checkpoints) go below the folder the
cluster names in ``spark.checkpoint.dir`` — a shared file system on a real
cluster. Only when that setting is absent (unit tests, a bare local session)
do we set one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, configuring one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext: the setting must name the folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for intermediate tables")
        return configured.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: name a shared folder (HDFS/S3/NFS) that every "
                "executor can reach; a machine-local folder would not survive a lost executor"
            )
        # Only reached in tests / bare local sessions: one JVM, one machine.
        configured = tempfile.mkdtemp(prefix="tripspark-ckpt-")
    sc.setCheckpointDir(configured)
    return (sc.getCheckpointDir() or configured).rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique path below the shared folder for one written table."""
    base = shared_dir(spark)
    return f"{base}/tripspark-scratch/{label}-{uuid.uuid4().hex}"



#: Settings under which no join is broadcast, neither at planning nor by adaptive execution.
NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def session_with(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of the same application with the caller's settings and ``settings`` on top. A DataFrame
    defined in it is planned under them; the caller's session stays as it is. (Temporary views aren't shared.)"""
    other = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and other.conf.isModifiable(key):
            other.conf.set(key, value)
    for key, value in settings.items():
        other.conf.set(key, value)
    return other
