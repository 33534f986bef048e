"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(
    app_name: str = "tidegauge",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Get or create a session with the settings the operators rely on.

    Adaptive execution sizes the shuffle partitions, turns a join into a broadcast
    join only after it has measured the side, and splits skewed join partitions, so
    none of the operators carries a hard-wired partition count or broadcast hint for
    a side that grows with the data.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        # groups a task aggregates in memory before it sorts; a column's sketches take 30 KB each
        .config("spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "1024")
        # wide aggregates are built from many columns; do not record where each was made
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for stream checkpoints and staged output.

    It lies under the shared folder the cluster names in ``spark.checkpoint.dir``. A
    local session without that setting (tests) gets a fresh temporary folder; a cluster
    without it is an error, because executors cannot share a machine-local folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return os.path.join(tempfile.mkdtemp(prefix="tidegauge-"), purpose)
