"""SparkSession construction and the shared scratch location."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "tokenmeter") -> SparkSession:
    """Session for local runs and tests.  On a cluster the submitter's config wins
    (``getOrCreate`` keeps an existing session); only what matters for results
    is forced: UTC day boundaries."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call-site capture costs several py4j round trips per Column call
        # while a plan is built; it only decorates error messages.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TOKENMETER_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Settings every job relies on.  "Today" and "this month" are UTC calendar
    periods (the block notice says the daily limit resets at midnight UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root for lineage cuts, sink tables and streaming checkpoints.

    Taken from ``spark.checkpoint.dir`` (a shared folder on a cluster), which
    must be set there: a machine-local folder would lose what other machines
    write.  Only in local mode without the setting -- tests -- a folder under
    the system temp dir is chosen and registered, so later calls agree.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        import tempfile

        root = tempfile.mkdtemp(prefix="tokenmeter-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared root (never reused, never cleared)."""
    return "/".join([shared_dir(spark), "tokenmeter", *parts, uuid.uuid4().hex])
