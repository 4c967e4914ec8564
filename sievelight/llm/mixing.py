"""Mixing sources to target weights with exact block quotas and a hypergeometric splitting tree.

Each source's words are laid out in a permuted document order. Its target is a number of whole passes
plus the first part of one more pass, cut into blocks of a fixed number of words. A tree splits the vector
of block quotas in halves, each by a multivariate-hypergeometric draw, down to the output shards; so
every shard gets an exact, random share of every source. Shards draw disjoint blocks of a permutation of each
source's blocks and order their documents by a hash.
"""

from __future__ import annotations

import json
import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.llm.tables import saved
from sievelight.llm.text import WORD

#: Fixed values of the mix: weights by rank of the source, repeated; most passes over a source.
WEIGHTS, MOST_PASSES = (5, 2, 1), 3
BLOCK_WORDS = 1 << 14
SHARD_WORDS = 1 << 22
SHARD_LIMIT = 1 << 14
#: Blocks in all, at most: of a corpus with more words they are longer. Numbers of blocks that one row of a range makes.
MOST_BLOCKS, RANGE_BLOCKS = 1 << 28, 1 << 16
#: Slices of the permuted order of a source, so that no task holds a whole source.
SLICES = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES) -> DataFrame:
    """``sources(source, source_size)`` with ``target``: water-filling of all sizes by weight under the caps.

    One row per source goes through global windows; documents never do.
    """
    ranked = sources.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
    w = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("w", w.cast("double")).withColumn("cap", F.col("source_size").cast("double") * most)
    by = Window.orderBy(F.col("cap") / F.col("w"), "rank")
    left = F.sum("source_size").over(Window.partitionBy()) - F.coalesce(
        F.sum("cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    level = left / F.sum("w").over(by.rowsBetween(0, Window.unboundedFollowing))
    filled = ranked.withColumn("level", level).withColumn("full", F.col("level") * F.col("w") >= F.col("cap"))
    # The first source below its cap has the final level.
    final = F.min(F.when(~F.col("full"), F.struct(F.col("cap") / F.col("w"), "rank", "level"))).over(Window.partitionBy())["level"]
    return filled.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(final * F.col("w"))).select(
        "source", "rank", "source_size", "target")


def split_quotas(blocks: list[int], shards: int, seed: int) -> list[list[int]]:
    """Blocks of every source in every shard: a binary tree of hypergeometric draws."""
    rng = np.random.default_rng(seed)

    def halve(counts: np.ndarray, leaves: int) -> list[list[int]]:
        if leaves == 1:
            return [counts.tolist()]
        left = leaves // 2
        taken = int(counts.sum()) * left // leaves
        own = rng.multivariate_hypergeometric(counts, taken, method="marginals")
        return halve(own, left) + halve(counts - own, leaves - left)

    return halve(np.array(blocks, np.int64), shards)


def _permutation(n: int, rank: int, seed: int) -> tuple[int, int]:
    """Step and shift of a permutation of n blocks, i -> (i * step + shift) mod n: near the golden section, moved by the seed."""
    rng = np.random.default_rng([seed, rank])
    step = max(1, int(n * (0.6180339887 + 0.01 * rng.random())))
    while math.gcd(step, n) != 1:
        step += 1
    return step, int(rng.integers(n))


def placements(
    docs: DataFrame, source_col: str = "source", text_col: str = "text", seed: int = 1,
    weights: tuple[int, ...] = WEIGHTS, most: int = MOST_PASSES, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and pass that the mix takes, and one with ``pass`` null for a document not taken.

    ``(uid, row, size, source_size, target, pass, words, shard, position)``. ``row`` is a struct of the input
    columns other than the text. ``words`` is the size, but for the document in which the last part pass of a
    source ends. ``shard`` and ``position`` order the output. A null source is a source, ordered last;
    a null or empty text has size 0 and is not taken; repeated rows are separate documents. An empty table gives
    an empty result. The number of sources has to fit the driver, as any list of weights does.
    """
    others = [c for c in docs.columns if c != text_col]
    sized = saved(docs.select(
        F.monotonically_increasing_id().alias("uid"), F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"),
        F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")).withColumn(
        "h", F.xxhash64(F.lit(seed), "row", "size")).withColumn("slice", F.shiftrightunsigned("h", 54).cast("int")))
    sums = sized.groupBy("source", "slice").agg(F.sum("size").alias("own"))
    total = saved(targets(sums.groupBy("source").agg(F.sum("own").alias("source_size")), weights, most))
    plan = total.withColumns({
        "words": F.round("target").cast("long"),
        "passes": F.when(F.col("source_size") > 0, F.floor(F.round("target") / F.col("source_size"))).otherwise(0).cast("long"),
    }).withColumn("rest", F.col("words") - F.col("passes") * F.col("source_size"))
    wanted = [(r["rank"], r["words"]) for r in plan.select("rank", "words").orderBy("rank").collect()]
    block_words = max(block_words, -(-sum(n for _, n in wanted) // MOST_BLOCKS))
    counts = [(rank, -(-n // block_words)) for rank, n in wanted]
    all_words = sum(b for _, b in counts) * block_words
    shards = min(SHARD_LIMIT, 1 << max(0, math.ceil(math.log2(max(1, all_words / SHARD_WORDS)))))
    quotas = split_quotas([b for _, b in counts], shards, seed)
    dealt, at = [], [0] * len(counts)
    for shard, own in enumerate(quotas):
        for i, n in enumerate(own):
            if n:
                dealt.append({"rank": counts[i][0], "low": at[i], "high": at[i] + n - 1, "shard": shard})
                at[i] += n
    steps = [{"rank": rank, "step": step, "shift": shift, "of": n} for rank, n in counts if n for step, shift in [_permutation(n, rank, seed)]]
    spark = docs.sparkSession

    def table(rows: list[dict], schema: str) -> DataFrame:
        return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))

    ranges = table(dealt, "rank int, low long, high long, shard int").select(
        "rank", "shard", "high", F.explode(F.sequence("low", "high", F.lit(RANGE_BLOCKS).cast("long"))).alias("low"))
    if sum(n for _, n in counts) > RANGE_BLOCKS:
        ranges = ranges.repartition("rank", "low")  # each task makes the blocks of some ranges
    drawn = ranges.select("rank", "shard", F.explode(
        F.sequence("low", F.least("high", F.col("low") + RANGE_BLOCKS - 1))).alias("drawn"))
    # Block i of a source is drawn at (i * step + shift) mod its number of blocks.
    before = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = sums.withColumn("before", F.coalesce(F.sum("own").over(before), F.lit(0))).drop("own").alias("s").join(
        plan.alias("p"), F.col("s.source").eqNullSafe(F.col("p.source"))).select("s.*", "rank", "source_size", "target", "passes", "rest")
    slices = slices.join(table(steps, "rank int, step long, shift long, of long"), "rank", "left")
    inner = Window.partitionBy("rank", "d.slice").orderBy("h", "uid").rowsBetween(Window.unboundedPreceding, -1)
    laid = sized.alias("d").join(
        slices.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")) & (F.col("d.slice") == F.col("s.slice"))).select(
        "uid", "row", "size", "h", "rank", "source_size", "target", "passes", "rest", "step", "shift", "of",
        (F.col("before") + F.coalesce(F.sum("size").over(inner), F.lit(0))).alias("start"))
    part = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("start")))
    passes = F.filter(
        F.transform(F.sequence(F.lit(0).cast("long"), F.col("passes")), lambda p: F.struct(
            p.alias("pass"), F.when(p < F.col("passes"), F.col("size")).otherwise(part).alias("words"))),
        lambda x: x["words"] > 0)
    taken = laid.select("uid", "row", "size", "h", "rank", "source_size", "target", "start", "step", "shift", "of", F.explode_outer(passes).alias("t"))
    block = F.floor((F.col("t.pass") * F.col("source_size") + F.col("start")) / block_words)
    placed = taken.withColumn("drawn", F.pmod(block * F.col("step") + F.col("shift"), F.col("of"))).join(drawn, ["rank", "drawn"], "left")
    return placed.select(
        "uid", "row", "size", "source_size", "target", F.col("t.pass").alias("pass"), F.col("t.words").alias("words"), "shard",
        F.xxhash64(F.lit(seed), "shard", "h", "t.pass").alias("position"))


def mix(docs: DataFrame, source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """``(row, size, source_size, target, taken, shards)``, one per row of ``docs``; see ``placements``."""
    rows = placements(docs, source_col, text_col, **options)
    return rows.groupBy("uid").agg(
        F.first("row").alias("row"), F.first("size").alias("size"), F.first("source_size").alias("source_size"),
        F.first("target").alias("target"), F.coalesce(F.sum("words"), F.lit(0)).alias("taken"),
        F.sort_array(F.collect_set("shard")).alias("shards")).drop("uid")
