"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import sys
import tempfile

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def ship_by_value(module_name: str) -> None:
    """Let functions of a module travel to Python workers with the task, so that
    workers need not have this package on their path."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])


def get_session(app: str = "surveyloom", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # recording a call site per column expression slows down plans over wide tables
        "spark.python.sql.dataFrameDebugging.enabled": "false",
    }
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    A cluster names its shared folder in ``spark.checkpoint.dir``. Only a local
    session without that setting gets a folder of its own.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="surveyloom-checkpoint-")
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that later steps
    neither recompute it nor depend on executor-local blocks."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
