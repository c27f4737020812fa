"""Session helpers: settings the library expects and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


# Settings the results and the skew handling rely on; all can be set on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Bursts of a key are merged in each map task before they are shuffled.
    "spark.sql.sessionWindow.merge.sessions.in.local.partition": "true",
    # Long texts go to Python workers in small batches: a batch is held several times over.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
}


# For wide rows with many expressions, which only the tables of the warehouse have.
TABLES = {
    # Larger methods are not compiled to machine code but interpreted: expressions are then split over several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffles of a table go when it is written, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# Adaptive execution merges shuffle partitions but adds none, so a deployed session begins with many.
CLUSTER = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192"}


def settle(spark: SparkSession, settings: dict[str, str] = RUNTIME) -> SparkSession:
    """Bring a session that was made elsewhere to the settings above."""
    for key, value in settings.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "wardlight", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; without a master it is one that was deployed to a cluster."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**RUNTIME, **({} if master else CLUSTER), "spark.ui.enabled": "false", **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: where checkpoints and tables go.

    On a cluster it is the folder named in ``spark.checkpoint.dir``. Only a local
    session, whose driver is its one executor, may fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(configured)
        return configured
    current = context.getCheckpointDir()
    if current:
        return current
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="run-", dir=os.environ.get("TMPDIR", "/tmp")))
    return context.getCheckpointDir()


def cut_lineage(df, eager: bool = True):
    """Checkpoint into the shared folder so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=eager)
