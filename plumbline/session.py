"""Session helpers: defaults for local runs, and cutting lineage where executors can be lost."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, driver_memory: str = "12g") -> SparkSession:
    """A local session as the tests and the bench use it. On a cluster, bring your own session instead.

    Checkpoints that no frame refers to any more are deleted; set the same on a cluster, before its session starts.
    """
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", driver_memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints: spark.checkpoint.dir as the cluster names it, else one of our own for local masters.

    A machine-local folder is only chosen under a ``local[...]`` master, where all tasks share this machine.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    if named:
        sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"plumbline-checkpoints-{os.getpid()}")
    sc.setCheckpointDir(own)
    return own


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that lost executors cost no recomputation."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
