"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

#: Settings every job wants. Sizes (memory, cores, shuffle partitions) belong to the cluster.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def build_session(
    app_name: str,
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Return a session with :data:`DEFAULTS`, overridden by ``settings``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, label: str) -> str:
    """A new path below the folder that all executors share.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a local session
    without the setting gets a folder of its own, since there every task sees it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidegate-"))
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
