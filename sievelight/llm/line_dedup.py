"""Corpus-wide line deduplication over levelled sorted runs of line hashes.

A run holds ``(line hash, documents)`` in fixed hash buckets, each one sorted file, so runs are merged and anti-joined bucket by
bucket: no run is shuffled after it is written. Lines are counted batch by batch. A batch is reduced to one row
per line, dealt to the buckets, merge-anti-joined with the lines that the runs have already decided (those that reached the threshold) and
written as a run of level 0. A level holds one run; a second one is merged with it into a run of the next level, as
in a binary counter. Each line is thus rewritten a logarithmic number of times, and a later batch shuffles its own rows only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sievelight.functions.text import let
from sievelight.llm.tables import folder, saved
from sievelight.llm.text import BLANKS, ascii_lower


def line_hashes(text: Column) -> Column:
    """One hash per line (null for an empty key), in order."""
    lines = F.split(ascii_lower(F.coalesce(text, F.lit(""))), "\n", -1)
    return F.transform(lines, lambda x: let(F.btrim(x, F.lit(BLANKS)), lambda k: F.when(k != "", F.xxhash64(k))))


class LineRuns:
    """Levelled runs of ``(line, docs)`` below a shared folder, in ``buckets`` buckets (by default as many as shuffle partitions)."""

    def __init__(self, spark: SparkSession, threshold: int, path: str | None = None, buckets: int | None = None):
        self.spark, self.threshold = spark, threshold
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.path, self.made = path or folder(spark), 0
        self.levels: list[DataFrame | None] = []

    def _write(self, df: DataFrame) -> DataFrame:
        """``df``, whose partitions are the buckets, as a run."""
        self.made += 1
        # The buckets are known by a table over the folder. It is dropped as soon as its plan is resolved; the files stay.
        name = f"run_{uuid.uuid4().hex}"
        df.write.bucketBy(self.buckets, "line").sortBy("line").option("path", f"{self.path}/run-{self.made:05d}").format(
            "parquet").saveAsTable(name)
        run = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")
        return run

    def merged(self, a: DataFrame, b: DataFrame) -> DataFrame:
        """Both runs' counts by line. A merge join of buckets: the union of bucketed scans is no base for a grouping in
        Spark 4.1, which takes it for dealt by line and then reads the files one after another."""
        other = b.withColumnRenamed("docs", "more").hint("merge")
        return a.hint("merge").join(other, "line", "full_outer").select(
            "line", (F.coalesce("docs", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("docs"))

    def fresh(self, batch: DataFrame) -> DataFrame:
        """The batch's counts of lines that no run has decided. Counted before they are dealt, so a frequent line is one row a task.

        The anti-join is an outer join and a test for null: Spark would move a ``left_anti`` below the counting, to the batch's rows.
        """
        counts = batch.groupBy("line").agg(F.count("*").alias("docs")).repartition(self.buckets, "line")
        for run in self.levels:
            if run is not None:
                decided = run.where(F.col("docs") >= self.threshold).withColumnRenamed("docs", "known")
                counts = counts.join(decided.hint("merge"), "line", "left").where("known is null").drop("known")
        return counts

    def add(self, batch: DataFrame) -> None:
        """``batch(line)``: one row per document and distinct line."""
        run, level = self._write(self.fresh(batch)), 0
        while level < len(self.levels) and self.levels[level] is not None:
            run = self._write(self.merged(self.levels[level], run))
            self.levels[level] = None
            level += 1
        self.levels += [None] * (level + 1 - len(self.levels))
        self.levels[level] = run

    def frequent(self) -> DataFrame:
        """``(line)``: lines of at least ``threshold`` documents over all batches. Merges all runs into one."""
        runs = [r for r in self.levels if r is not None]
        whole = runs[0]
        for run in runs[1:]:
            whole = self._write(self.merged(whole, run))
        self.levels = [None] * (len(self.levels) - 1) + [whole]
        return whole.where(F.col("docs") >= self.threshold).select("line")


def drop_lines(docs: DataFrame, text_col: str = "text", min_docs: int = 10, batches: int = 4) -> DataFrame:
    """``docs`` with ``kept`` (text without frequent lines), ``n_lines`` and ``n_dropped`` in front: ``(kept, n_lines, n_dropped, row)``.

    A line's key is the line without ASCII white space at both ends, A-Z lower-cased; keys are compared
    by 64-bit hashes, whole texts by two of them. A non-empty key in ``min_docs`` rows or more loses all its lines. Every row
    counts as a document, also a repeated one; a null text is one empty line. ``row`` is a struct of the
    input row, so no column name can clash. An empty table gives an empty result. ``batches`` is the number
    of batches in which the lines are added; the result does not depend on it.
    """
    spark, text = docs.sparkSession, F.col(text_col)
    keyed = docs.select(
        F.struct("*").alias("row"), F.xxhash64(text).alias("t"), F.xxhash64(F.lit("second"), text).alias("u"))
    base = docs.select(
        F.xxhash64(text).alias("t"), F.xxhash64(F.lit("second"), text).alias("u"), line_hashes(text).alias("lines"))
    path = folder(spark)
    base.withColumn("batch", F.pmod("t", F.lit(batches)).cast("int")).write.partitionBy("batch").parquet(path)
    lines = spark.read.schema("t long, u long, lines array<long>, batch int").parquet(path)
    runs = LineRuns(spark, min_docs)
    for i in range(batches):
        own = lines.where(F.col("batch") == i)
        runs.add(own.select(F.explode(F.array_distinct("lines")).alias("line")).where("line is not null"))
    # Positions of dropped lines, once per distinct text; written, so that the join can split a text of many copies.
    # The frequent lines as a plain table: its size decides on a broadcast, and a join that shuffles both sides can split a hot line.
    hits = saved(
        lines.select("t", "u", F.posexplode("lines").alias("pos", "line")).join(saved(runs.frequent()), "line")
        .groupBy("t", "u").agg(F.collect_set("pos").alias("dropped")))
    # A merge join at every size: the dropped positions grow with the corpus.
    out = keyed.join(hits.hint("merge"), ["t", "u"], "left")
    none = F.array().cast("array<int>")

    def rest(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("dropped", none))
        return F.struct(
            F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n").alias("kept"),
            F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(kept)).cast("long").alias("n_dropped"))

    whole = F.split(F.coalesce(F.col("row").getField(text_col), F.lit("")), "\n", -1)
    return out.select(F.explode(F.array(let(whole, rest))).alias("r"), "row").select("r.kept", "r.n_lines", "r.n_dropped", "row")
