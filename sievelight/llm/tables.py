"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sievelight.session import ensure_checkpoint_dir


def folder(spark: SparkSession) -> str:
    """A new folder below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/tables-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """``df`` as a written table: later steps and retries read it, and Spark knows its size."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
