"""Session, table and lineage helpers shared by every operator."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "grainmill", cpus: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session with the settings the engine expects (UTC, AQE, Arrow)."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("GRAINMILL_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A parquet table of the data folder; pruning and pushdown are left to the scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints.

    ``spark.checkpoint.dir`` of the session wins. Where it is unset a machine-local
    folder is made, but only on a ``local`` master: a cluster must name a shared one.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    current = sc._jsc.sc().getCheckpointDir()
    # what no frame refers to any more is deleted; read when a checkpoint is written, so it may be set now
    sc._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if current.isDefined():
        return current.get()
    if not named:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="grainmill-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint in the shared folder: survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)
