"""Session helpers: a local session for tests/bench and a shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "splitsafe") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName(app)
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("SPLITSAFE_DRIVER_MEMORY", "12g"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder in use, else ``spark.checkpoint.dir``; a folder already set is never replaced.

    Where neither is set, a local session gets a folder of its machine; on a cluster that is an error,
    since executors could not see such a folder.
    """
    known = spark.sparkContext.getCheckpointDir()
    if known:
        return known
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="splitsafe-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return d


def new_folder(spark: SparkSession, kind: str) -> str:
    """A folder not yet there, in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
