"""Session helpers. Settings of an existing session are never replaced."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", app: str = "sievelight", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        # Recording a call site per expression costs more than building the expression.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names in ``spark.checkpoint.dir``.

    Only where the setting is absent and none was set by code (tests, one machine) is a private
    folder made.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return
    if not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    import tempfile

    sc.setCheckpointDir(tempfile.mkdtemp(prefix="sievelight-checkpoint-"))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so a lost executor does not replay all earlier rounds."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
