"""Spark session helpers.

Cluster jobs get their session from the platform; ``get_spark`` is for local
runs and tests.  ``checkpoint_dir`` is the folder in ``spark.checkpoint.dir``; only a
local master gets a fresh one when it is unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CHECKPOINT_ROOT: str | None = None


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "tallyframe") -> SparkSession:
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    parts = shuffle_partitions or int(os.environ.get("TALLY_SHUFFLE_PARTITIONS", "8"))
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TALLY_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure_session(spark)
    return spark


def configure_session(spark: SparkSession) -> None:
    """Session settings every job relies on (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names in ``spark.checkpoint.dir``.

    Only a local master (tests, laptops) gets a folder of its own when none is named;
    on a cluster that would be each executor's own disk, so it is an error.
    """
    global _LOCAL_CHECKPOINT_ROOT
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if _LOCAL_CHECKPOINT_ROOT is None:
            _LOCAL_CHECKPOINT_ROOT = tempfile.mkdtemp(prefix="tallyframe-ckpt-")
        named = _LOCAL_CHECKPOINT_ROOT
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
