"""Readers for landed payloads, webhook deliveries, documents, files and transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievelight.functions import variant as V
from sievelight.schemas import DELIVERIES

MAX_BODY_BYTES = 1_048_576  # fixed value: webhook body cap
MAX_DOCUMENT_BYTES = 8 * 1_048_576  # fixed value: response body cap


def _reader(spark: SparkSession, streaming: bool):
    return spark.readStream if streaming else spark.read


REPEATED_KEYS = "spark.sql.variant.allowDuplicateKeys"


def parsed(df: DataFrame, text: str, name: str = "payload_v") -> DataFrame:
    """Add the value of a JSON text, null for text that is not JSON; of a repeated key the last value counts.

    Spark rejects repeated keys unless a session setting allows them. It is turned on here, unless the session sets it itself.
    """
    if REPEATED_KEYS not in df.sparkSession.conf.getAll:
        df.sparkSession.conf.set(REPEATED_KEYS, "true")
    return df.withColumn(name, F.try_parse_json(F.col(text)))


def with_payload(df: DataFrame, text: str = "payload") -> DataFrame:
    """Add the parsed ``payload_v``; unparseable text gives null and never fails the job."""
    return parsed(df, text)


def split_payloads(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(object payloads, rejected rows with a reason)."""
    v = F.col("payload_v")
    reason = F.when(v.isNull(), F.lit("unparseable")).when(~V.is_object(v), F.lit("payload_not_object"))
    return df.where(V.is_object(v)), df.withColumn("reason", reason).where(F.col("reason").isNotNull())


def read_landing(spark: SparkSession, path: str, provider: str, streaming: bool = False) -> DataFrame:
    """One JSON payload per line as ``provider, payload, payload_v``. Split with ``split_payloads``."""
    raw = _reader(spark, streaming).text(path).select(F.lit(provider).alias("provider"), F.col("value").alias("payload"))
    return with_payload(raw)


def body_reason(body: str = "body", limit: int = MAX_BODY_BYTES) -> Column:
    """``missing_body`` for a null body, ``oversized_body`` above the cap, else null."""
    return F.when(F.col(body).isNull(), F.lit("missing_body")).when(F.octet_length(F.col(body)) > limit, F.lit("oversized_body"))


def cap_bodies(df: DataFrame, body: str = "body", limit: int = MAX_BODY_BYTES) -> DataFrame:
    """Bodies within the cap; apply before any parse. ``body_reason`` names why a row is left out."""
    return df.where(body_reason(body, limit).isNull())


def read_deliveries(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Webhook deliveries (``headers, body, received_at``) from parquet that have a body within the cap."""
    return cap_bodies(_reader(spark, streaming).schema(DELIVERIES).parquet(path))


def body_payload(df: DataFrame) -> DataFrame:
    """Parse a delivery body; a body that is not UTF-8 gives a null payload."""
    valid = F.when(F.is_valid_utf8(F.col("body").cast("string")), F.col("body").cast("string"))
    return parsed(df.withColumn("payload", valid), "payload")


def read_documents(responses: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Landed single-document responses (``status, body``): (documents, rejects with reason)."""
    df = body_payload(responses)
    v = F.col("payload_v")
    reason = (
        F.when(F.col("status") != 200, F.lit("http_error"))
        .when(F.octet_length("body") > MAX_DOCUMENT_BYTES, F.lit("oversized_body"))
        .when(v.isNull(), F.lit("unparseable_body"))
        .when(~V.is_object(v), F.lit("non_object_body"))
    )
    df = df.withColumn("reason", reason)
    return df.where("reason IS NULL").drop("reason"), df.where("reason IS NOT NULL").drop("payload", "payload_v")


def read_files(spark: SparkSession, path: str, glob: str = "*", streaming: bool = False) -> DataFrame:
    """Files as rows ``path, content, modified``. Bytes that are no UTF-8 become replacement marks."""
    files = (
        _reader(spark, streaming).format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    )
    return files.select(
        "path",
        F.make_valid_utf8(F.col("content").cast("string")).alias("content"),
        F.col("modificationTime").alias("modified"),
    )


def read_file_lines(spark: SparkSession, path: str, glob: str = "*", streaming: bool = False) -> DataFrame:
    """The lines of files of any size as ``path, start, line, modified``: byte ranges of a file go to many tasks.

    Splits end at line borders, so no line and no character is cut; ``start`` is the first byte of the range that a line was read in,
    and the rows of a range are in the file's order. Use it where a file can be larger than a row (``read_files``). Bytes
    that are no UTF-8 become replacement marks.
    """
    lines = _reader(spark, streaming).option("pathGlobFilter", glob).option("recursiveFileLookup", "true").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.make_valid_utf8("value").alias("line"), F.col("_metadata.file_modification_time").alias("modified"))


def explode_lines(df: DataFrame) -> DataFrame:
    """Rows that hold a ``lines`` list become one row per list member; other rows stay."""
    v = F.col("payload_v")
    is_batch = F.coalesce(V.kind(v, "$.lines").startswith("ARRAY"), F.lit(False))
    lines = F.when(is_batch, V.array(v, "$.lines")).otherwise(F.array(v))
    keep = [F.col(c) for c in df.columns if c not in ("payload", "payload_v")]
    return df.select(*keep, F.explode(lines).alias("payload_v"))


def read_transcripts(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Transcript lines from JSONL files or ``{lines: [...]}`` batch rows."""
    return explode_lines(with_payload(_reader(spark, streaming).text(path).withColumnRenamed("value", "payload")))
