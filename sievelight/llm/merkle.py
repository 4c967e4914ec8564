"""Document fingerprints: a Merkle tree over paragraphs and sections, as SQL expressions.

A leaf is the digest of a paragraph (a line) with its length; a section is a run of paragraphs that ends at an
empty paragraph or at one whose digest starts with 0 or 1 (so boundaries follow the content, and an edit moves few
of them); the root is the digest of the section digests. Equal roots mean equal texts; where roots
differ, comparing section digests and then leaves locates the edits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.functions.text import let
from sievelight.llm.tables import saved


def leaves(text: Column) -> Column:
    """``digest:length`` of every paragraph, in order; a null text is empty."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda p: F.concat(
        F.substring(F.sha2(p, 256), 1, 16), F.lit(":"), F.length(p).cast("string")))


def sections(paragraphs: Column) -> Column:
    """``array<struct<digest, leaves>>`` of the leaves of a text."""
    def cut(own: Column) -> Column:
        last = F.size(own) - 1
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | F.get(own, i).rlike("^[01]|:0$"))
        return let(ends, lambda at: F.transform(at, lambda e, k: let(
            F.when(k == 0, F.lit(0)).otherwise(F.get(at, k - 1) + 1),
            lambda start: let(F.slice(own, start + 1, e - start + 1), lambda part: F.struct(
                F.substring(F.sha2(F.concat(F.lit("section\n"), F.array_join(part, "\n")), 256), 1, 16).alias("digest"),
                part.alias("leaves"))))))

    return let(paragraphs, cut)


def tree(text: Column) -> Column:
    """``struct<root, sections>`` of a text."""
    return let(sections(leaves(text)), lambda s: F.struct(
        F.sha2(F.concat(F.lit("root\n"), F.array_join(s["digest"], "\n")), 256).alias("root"), s.alias("sections")))


def serialized(own: Column) -> Column:
    """A tree as text: ``root;section[leaf,leaf];section[leaf]``."""
    return F.concat_ws(";", own["root"], F.array_join(F.transform(own["sections"], lambda s: F.concat(
        s["digest"], F.lit("["), F.array_join(s["leaves"], ","), F.lit("]"))), ";"))


def all_leaves(own: Column) -> Column:
    return F.array_distinct(F.flatten(own["sections"]["leaves"]))


def _weight(labels: Column) -> Column:
    return F.aggregate(labels, F.lit(0).cast("long"), lambda total, x: total + 1 + F.substring_index(x, ":", -1).cast("long"))


def likeness(a: Column, b: Column) -> Column:
    """Share of the distinct paragraphs of two leaf arrays that both have, weighted by length: 0 to 1."""
    return 2 * _weight(F.array_intersect(a, b)) / (_weight(a) + _weight(b))


def differing(a: Column, b: Column) -> Column:
    """Sections of tree ``a`` with the leaves that ``b`` does not have: where the edits are."""
    return let(all_leaves(b), lambda other: F.filter(
        F.transform(a["sections"], lambda s, i: F.struct(i.alias("section"), F.array_except(s["leaves"], other).alias("leaves"))),
        lambda x: F.size(x["leaves"]) > 0))


def following(keys: DataFrame) -> DataFrame:
    """``keys(id, tie, n)`` with ``next_id, next_tie``: the next in descending id, after the last the first.

    Keys are dealt to ranges, ordered within each, and the ends of the ranges are linked: no task sees all keys.
    """
    order = [F.col("id").desc_nulls_last(), F.col("tie").asc()]
    dealt = saved(keys.repartitionByRange(*order).withColumn("block", F.spark_partition_id()))
    w = Window.partitionBy("block").orderBy(*order)
    rows = dealt.select("*", F.lead(F.struct("id", "tie")).over(w).alias("next"), F.row_number().over(w).alias("r"))
    firsts = rows.where("r = 1").select("block", F.struct("id", "tie").alias("first"))
    blocks = Window.orderBy("block")  # one row per range
    chain = firsts.select("block", F.coalesce(
        F.lead("first").over(blocks), F.first("first").over(blocks.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("after"))
    out = rows.join(chain, "block").withColumn("next", F.coalesce("next", "after"))
    return out.select("id", "tie", "n", F.col("next.id").alias("next_id"), F.col("next.tie").alias("next_tie"))


def compare_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every row's text and of its edited text, with likenesses; see ``op2`` for the columns.

    The edited text has its last ``floor(n / 2)`` code points replaced by the first as many (or all) of the next
    document's, in descending id, null ids last, equal ids by a hash of the text; after the last comes the first. Rows with
    equal id and text are one document in that order and get equal results. A null text is empty. A single document
    is its own next. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    keys = rows.select("id", "tie", F.length("text").cast("long").alias("n")).distinct()
    order = following(keys).alias("o")
    same = F.col("o.next_id").eqNullSafe(F.col("d.id")) & (F.col("o.next_tie") == F.col("d.tie"))
    heads = rows.alias("d").join(order, same).select(
        F.col("o.id").alias("id"), F.col("o.tie").alias("tie"),
        F.substring("d.text", F.lit(1), F.floor(F.col("o.n") / 2).cast("int")).alias("head"),
        F.array_distinct(leaves(F.col("d.text"))).alias("next_leaves")).dropDuplicates(["id", "tie"]).alias("h")
    joined = rows.alias("d").join(heads, F.col("d.id").eqNullSafe(F.col("h.id")) & (F.col("d.tie") == F.col("h.tie")))
    n = F.length("d.text")
    edited = F.concat(F.substring("d.text", F.lit(1), n - F.floor(n / 2).cast("int")), F.col("h.head"))

    def once(**values: Column) -> Column:
        return F.explode(F.array(F.struct(*[v.alias(k) for k, v in values.items()])))

    step = joined.select(F.col("d.id").alias("id"), n.cast("long").alias("n_chars"), "h.next_leaves", once(text=F.col("d.text"), edited=edited).alias("x"))
    trees = step.select("id", "n_chars", "next_leaves", F.sha2("x.edited", 256).alias("edited_sha256"), once(
        own=tree(F.col("x.text")), edited=tree(F.col("x.edited"))).alias("t"))
    done = trees.select("id", "n_chars", "edited_sha256", "t", "next_leaves", once(
        own=all_leaves(F.col("t.own")), edited=all_leaves(F.col("t.edited"))).alias("l"))
    return done.select(
        F.col("id").alias(id_col), "n_chars", "edited_sha256", serialized(F.col("t.own")).alias("fingerprint"),
        serialized(F.col("t.edited")).alias("edited_fingerprint"), likeness(F.col("l.own"), F.col("l.edited")).alias("near_edited"),
        likeness(F.col("l.own"), F.col("next_leaves")).alias("near_next"),
        F.transform(differing(F.col("t.edited"), F.col("t.own")), lambda x: x["section"]).alias("edited_sections"))
