"""Two-phase cursors over a stream: the cursor moves only after the batch is stored.

Each micro-batch is written below its own batch id, then the merged cursors as a new version, then a pointer that names this version
and the one before it. The pointer is replaced in one step, so a reader sees the old state or the new one, and reads
one version however many batches have run. Versions that the pointer does not name are removed. A batch that is
replayed after a failure starts from the version before its own and overwrites its own folders, so nothing is stored twice.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from sievelight.operators.cursors import delivered, merge_cursors, next_cursor

CURSOR_SCHEMA = "repository_id string, updated_at string, last_provider_event_id string, schema_version int"
POINTER = "_current"


def _hadoop(spark: SparkSession, path: str):
    """The file system of a path in whatever store it is, and the path."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _pointer(spark: SparkSession, folder: str) -> dict[str, int | None]:
    """``version`` and ``previous``; both None before the first batch."""
    fs, path = _hadoop(spark, f"{folder}/{POINTER}")
    if not fs.exists(path):
        return {"version": None, "previous": None}
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def point_to(spark: SparkSession, folder: str, version: int, previous: int | None) -> None:
    """Replace the pointer: written aside, then renamed over the old one in one step."""
    jvm = spark._jvm
    fs, new = _hadoop(spark, f"{folder}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps({"version": version, "previous": previous}).encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(new.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(new, jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}"), options)


def drop_other_versions(spark: SparkSession, folder: str, keep: set[int | None]) -> None:
    fs, path = _hadoop(spark, folder)
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("version=") and int(name.removeprefix("version=")) not in keep:
            fs.delete(status.getPath(), True)


def version_before(spark: SparkSession, folder: str, before: int | None) -> int | None:
    pointer = _pointer(spark, folder)
    newest = pointer["version"]
    return newest if newest is None or before is None or newest < before else pointer["previous"]


def read_cursors(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The newest cursor version (below ``before``, the batch that is at work, when given); empty when there is none."""
    version = version_before(spark, folder, before)
    if version is None:
        return spark.createDataFrame([], CURSOR_SCHEMA)
    return spark.read.schema(CURSOR_SCHEMA).parquet(f"{folder}/version={version}")


def advance_cursor(batch: DataFrame, batch_id: int, out: str, cursors: str, repo: str = "repository_id",
                   updated: str = "updated_at", event: str = "provider_event_id", verdict: str | None = None) -> None:
    """Store the batch, then the merged cursors, then the pointer. Use inside ``foreachBatch``.

    With ``verdict`` (the column of the delivery's outcome) a cursor moves only over advanced rows, up to the
    first that is not; a cursor never moves back.
    """
    spark = batch.sparkSession
    batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    rows = batch.where(F.col(updated).isNotNull())
    proposed = next_cursor(rows if verdict is None else delivered(rows, verdict, repo, updated, event), repo, updated, event)
    previous = version_before(spark, cursors, batch_id)
    merged = merge_cursors(read_cursors(spark, cursors, batch_id), proposed.select(
        F.col(repo).alias("repository_id"), "updated_at", "last_provider_event_id", "schema_version"))
    merged.write.mode("overwrite").parquet(f"{cursors}/version={batch_id}")
    point_to(spark, cursors, batch_id, previous)
    drop_other_versions(spark, cursors, {batch_id, previous})


def emit_with_cursor(stream: DataFrame, out: str, cursors: str, checkpoint: str, **columns: str) -> DataStreamWriter:
    """A stream writer that runs ``advance_cursor`` per micro-batch; start it with any trigger."""
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: advance_cursor(batch, batch_id, out, cursors, **columns)
    )
