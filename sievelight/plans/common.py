"""Bindings of the driver's tables to the jobs: readers, derived payloads and oracle snippets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievelight.functions.text import pin


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows of a task where text rules run, at about a millisecond or less a row.
ROWS_PER_TASK = 20_000


def spread(df: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Deal an input out so that no task has more than about ``rows_per_task`` rows, and all cores have work.

    Text rules are CPU-bound, and columns of numbers and short texts compress well: one split of a file can hold millions of rows.
    The count reads file footers alone. An input that already has as many partitions is left alone.
    """
    wanted = max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // rows_per_task))
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def kept(df: DataFrame, path: str, rows_per_file: int = 5_000) -> DataFrame:
    """The rows written once and read from there, for jobs that use them several times.

    A split packs at most 32 files, however small: files of few rows keep the tasks of the readers short.
    """
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def k_of(props: str = "props") -> Column:
    """The ``k`` of an event's properties."""
    return F.get_json_object(props, "$.k").cast("int")


def with_k(df: DataFrame) -> DataFrame:
    """Add ``k``, read once per row: as a plain column each of its uses would parse the properties again."""
    return pin(df, {"k": k_of()})


def instant(col: str) -> Column:
    """A zone-less timestamp read as UTC, whatever the session's time zone is."""
    return F.expr(f"timestamp_micros(timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {col}))")


SQL_K = "CAST(regexp_extract(props, '\"k\": ([0-9]+)', 1) AS INTEGER)"


def element(values: list[str], index: Column) -> Column:
    """``values[index mod n]``."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values) -> str:
    return "[" + ", ".join(sql_text(v) for v in values) + "]"


def sql_element(values: list[str], index: str) -> str:
    return f"({sql_list(values)})[1 + CAST(({index}) % {len(values)} AS INTEGER)]"


def payload(df: DataFrame, keys: list[str], **fields: Column) -> DataFrame:
    """Derive JSON payload rows: the keys plus ``payload`` text and its parsed form."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return df.select(*keys, body.alias("payload")).withColumn("payload_v", F.try_parse_json("payload"))


def struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def meta_text(m: str = "metadata") -> Column:
    """A string map as ``k=v`` pairs in key order."""
    return F.array_join(
        F.transform(F.array_sort(F.map_entries(F.col(m))), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";"
    )


def flat_observations(df: DataFrame, *keys: str) -> DataFrame:
    return df.select(
        *keys, F.col("source_ref.source_id").alias("source_id"), F.col("source_ref.ref").alias("ref"),
        F.col("source_ref.url").alias("url"), F.col("source_ref.kind").alias("kind"), "excerpt", "mode", "title",
        "author", F.col("timestamp").alias("stamp"), meta_text().alias("meta"),
    )


def sql_observation(source: str, *, ref: str, kind: str, excerpt: str, mode: str, title: str = "''",
                    url: str = "''", author: str = "''", stamp: str = "''", meta: str = "''") -> str:
    return (
        f"'{source}' AS source_id, {ref} AS ref, {url} AS url, {kind} AS kind, {excerpt} AS excerpt, "
        f"'{mode}' AS mode, {title} AS title, {author} AS author, {stamp} AS stamp, {meta} AS meta"
    )


def run_folder(spark: SparkSession) -> str:
    """A fresh folder below the shared checkpoint folder, for streaming queries."""
    import uuid

    from sievelight.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/run-{uuid.uuid4().hex}"
