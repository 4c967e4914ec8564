"""Replay dedup across batch runs: a bucketed history of seen ids, with expiry.

The history holds one row per id, the time of its last accepted delivery. It is stored in buckets by id, sorted, so a run joins it
bucket by bucket: only the run's own rows are shuffled. A run writes the next version, without the ids whose window has passed,
beside the old one and then moves a pointer; a failed run leaves the old version in place.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.operators.dedup import TTL_SECONDS, dedup_ttl
from sievelight.session import cut_lineage
from sievelight.streaming.cursor import drop_other_versions, point_to, version_before

BUCKETS = 256
ROWS_PER_BUCKET = 500_000


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets of a history whose runs have ``rows`` rows in all, so that the task of a bucket does not grow with them."""
    return max(least, -(-rows // ROWS_PER_BUCKET))


class SeenIds:
    """Ids of the columns ``keys`` (text) below ``folder``, in ``buckets`` buckets; the number is fixed by the first run."""

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], buckets: int = BUCKETS):
        self.spark, self.folder, self.keys, self.buckets = spark, folder, keys, buckets

    def read(self, before: int | None = None) -> DataFrame | None:
        """``(keys, last)`` of the newest version (below run ``before``), as a bucketed table; None when there is none."""
        version = version_before(self.spark, self.folder, before)
        if version is None:
            return None
        return self._table(f"{self.folder}/version={version}")

    def _table(self, path: str) -> DataFrame:
        # The buckets are known by a table over the folder. Any catalog will do: it is dropped as soon as the plan is resolved.
        name = f"seen_{uuid.uuid4().hex}"
        columns = ", ".join([f"`{k}` STRING" for k in self.keys] + ["last BIGINT"])
        by = ", ".join(f"`{k}`" for k in self.keys)
        self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS LOCATION '{path}'")
        seen = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return seen

    def of(self, rows: DataFrame, before: int | None = None) -> DataFrame | None:
        """The seen ids among those of ``rows``. The history is read in its buckets and not shuffled."""
        seen = self.read(before)
        if seen is None:
            return None
        own = rows.select(*self.keys).repartition(self.buckets, *self.keys).distinct()
        return seen.hint("merge").join(own.hint("merge"), self.keys, "left_semi")

    def advance(self, run: int, accepted: DataFrame, since: int) -> None:
        """Write the version of ``run``: the ids of ``accepted`` (``keys, last``) and the older ones seen at ``since`` (micros) or later."""
        fresh = accepted.repartition(self.buckets, *self.keys).groupBy(*self.keys).agg(F.max("last").alias("last"))
        old = self.read(run)
        merged = fresh if old is None else old.hint("merge").join(
            fresh.withColumnRenamed("last", "_last").hint("merge"), self.keys, "full_outer").select(
            *self.keys, F.greatest("last", "_last").alias("last"))
        previous = version_before(self.spark, self.folder, run)
        name = f"seen_{uuid.uuid4().hex}"
        path = f"{self.folder}/version={run}"
        merged.where(F.col("last") >= since).write.mode("overwrite").bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option(
            "path", path).format("parquet").saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # the files stay: the table is external
        point_to(self.spark, self.folder, run, previous)
        drop_other_versions(self.spark, self.folder, {run, previous})


def dedup_run(
    df: DataFrame, run: int, history: SeenIds, ts: str, tiebreak: str, until, ttl: int = TTL_SECONDS, id_col: str | None = None,
) -> DataFrame:
    """The accepted deliveries of one run, as ``dedup_ttl`` over all runs so far would accept them.

    Runs follow each other in time: ``df`` holds no row earlier than the last accepted one of its id, and none after ``until`` (a
    timestamp), after which ids expire. A run that is repeated starts from the version before it. Rows without an id
    are all accepted and leave no trace.
    """
    keys = history.keys
    named = F.coalesce(F.col(id_col or keys[-1]), F.lit("")) != ""
    rows = df.withColumn("_seen", F.lit(False))
    seen = history.of(df.where(named), run)
    if seen is not None:
        # The last accepted delivery of an id comes first again and opens its window. The history is joined once, not in every step that follows.
        rows = rows.unionByName(cut_lineage(seen).select(
            *keys, F.timestamp_micros("last").cast(df.schema[ts].dataType).alias(ts), F.lit(True).alias("_seen")), allowMissingColumns=True)
    accepted = cut_lineage(dedup_ttl(rows, keys, ts, tiebreak, ttl, id_col=id_col).where(~F.col("_seen")).drop("_seen"))
    last = accepted.where(named).select(*keys, F.unix_micros(F.col(ts).cast("timestamp")).alias("last"))
    end = df.sparkSession.range(1).select(F.unix_micros(F.lit(until).cast("timestamp")).alias("m")).first()["m"]
    history.advance(run, last, end - ttl * 1_000_000)
    return accepted
