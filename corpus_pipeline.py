"""The corpus pipeline: language, repeated lines, near duplicates, source mix, packed sequences.

Each stage takes ``(spark, docs, sf_dir)``, works on all rows that the stage before it kept, and returns the columns of
``documents``; the last returns the packed pieces. ``run`` writes each result as a table and reads it for the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sievelight.llm import language, line_dedup, mixing, ngram_jaccard, packing
from sievelight.llm.tables import saved

def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognised language; ``und`` ones (null texts, texts without a letter) go. ``lang`` becomes the recognised one.

    Repeated rows are judged alike, a null ``doc_id`` is no obstacle, an empty table stays empty.
    """
    found = language.identify(docs).where(F.col("lang_pred") != language.UNKNOWN)
    return found.select(*[
        F.col("lang_pred").alias(c) if c == "lang" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that ten documents or more share; null texts stay null."""
    kept = line_dedup.drop_lines(docs)
    changed = {"text": F.when(F.col("row.text").isNotNull(), F.col("kept")), "n_chars": F.length("kept").cast("long")}
    return kept.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def _whole(docs: DataFrame, id_name: str) -> DataFrame:
    """Rows as one struct beside their id: no column of theirs can clash with one of a join."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").alias(id_name))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of linked documents.

    Repeated rows (equal id and text) count once. Rows of a null id form no group of their own: one of each text stays if its
    group has no id. Empty texts are linked with nothing and stay; an empty table stays empty.
    """
    found = ngram_jaccard.near_duplicates(docs).where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    kept = found.select(F.col("doc_id").alias("kept")).distinct()
    rows = _whole(docs, "own").join(kept, F.col("own").eqNullSafe(F.col("kept")), "left_semi")
    return rows.select("row.*").dropDuplicates(["doc_id", "text"])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; a part of a document counts as whole from one half on.

    A null source is a source. Empty texts are not taken. Rows that share an id are taken as often as the one of them that is taken
    most, a null id like any other; an empty table stays empty.
    """
    mixed = mixing.mix(docs).select(F.col("row.doc_id").alias("mixed"), F.when(
        F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int").alias("n"))
    times = mixed.where("n > 0").groupBy("mixed").agg(F.max("n").alias("n"))
    wanted = _whole(docs, "own").join(times, F.col("own").eqNullSafe(F.col("mixed")))
    return wanted.select("row", F.explode(F.sequence(F.lit(1), F.col("n")))).select("row.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs).select(
        "row.doc_id", "row.source", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "certified")


STAGES = [
    ("language_id", language_id), ("line_dedup", drop_repeated_lines), ("ngram_jaccard", near_duplicates),
    ("source_mixing", mix_sources), ("best_fit_packing", pack_sequences),
]
#: Language scores, hash orders and tokenizers are not in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
