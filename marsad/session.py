"""Session helpers: a tuned local session and lineage cuts that survive executor loss."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | None = None, partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own settings."""
    n = cpus or os.cpu_count() or 8
    return (
        SparkSession.builder.master(f"local[{n}]")
        .appName("marsad")
        .config("spark.sql.shuffle.partitions", str(partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # checkpoints go when the tables that stand on them are no longer referred to
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("MARSAD_DRIVER_MEMORY", "8g"))
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; one of our own only where none is set and the session is local."""
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="marsad-checkpoint-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    sc.setCheckpointDir(named)
    return named


def cut(df: DataFrame) -> DataFrame:
    """Write a small intermediate result to the checkpoint folder and read it from there afterwards."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
