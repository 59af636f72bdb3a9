"""Session set-up and the shared folder for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "shelfcast", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects.

    On a cluster only `conf` is added to what spark-submit gives; a master is
    passed for local runs.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.scheduler.mode": "FAIR",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by spark.checkpoint.dir.

    A local session without the setting gets its own temporary folder; a
    cluster session without it is an error, since a machine-local folder would
    be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or None
    context = spark.sparkContext
    if configured is None:
        current = context.getCheckpointDir()
        if current is not None:
            # setCheckpointDir appends its own run folder; stage beside it.
            return current.rsplit("/", 1)[0]
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="shelfcast-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured.rstrip("/")


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}/{name}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint that survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
