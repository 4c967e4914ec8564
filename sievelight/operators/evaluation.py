"""Redaction-quality evaluation: corpus checks, span matching, metrics, gates and ranking."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from sievelight.operators.skew import blocked_before, ranked
from sievelight.session import cut_lineage

# --- L1-L3: field paths, spans, preservation --------------------------------------------------------


def path_problem(path: Column) -> Column:
    """Why a field path is malformed; null when it is fine."""
    rest = _path_rest(path)
    good = rest.rlike(r"\A(?:[^.\[]+|\[\p{Nd}+\])(?:\.?(?:[^.\[]+|\[\p{Nd}+\]))*\z")
    return F.when((path != "$") & ~good, F.lit("malformed_path"))


def _path_rest(path: Column) -> Column:
    return F.when(path.startswith("$"), F.regexp_replace(F.substring(path, F.lit(2), F.char_length(path)), r"\A\.", "")
                  ).otherwise(path)


def variant_path(path: Column) -> Column:
    """``a.b[0]`` as the quoted form VARIANT reads; null when malformed."""
    parts = F.regexp_extract_all(_path_rest(path), F.lit(r"\[[0-9]+\]|[^.\[]+"), F.lit(0))
    quoted = F.transform(parts, lambda t: F.when(t.rlike(r"\A\[[0-9]+\]\z"), t).otherwise(
        F.concat(F.lit("['"), t, F.lit("']"))))
    return F.when(path == "$", F.lit("$")).when(
        path_problem(path).isNull(), F.concat(F.lit("$"), F.array_join(quoted, "")))


def resolve_path(df: DataFrame, doc: str = "doc_v", path: str = "field_path") -> DataFrame:
    """Add ``value_v`` (VARIANT) and ``path_problem``."""
    value = F.try_variant_get(F.col(doc), variant_path(F.col(path)), "variant")
    out = df.withColumn("value_v", value)
    return out.withColumn(
        "path_problem",
        F.coalesce(path_problem(F.col(path)), F.when(F.col("value_v").isNull(), F.lit("path_does_not_resolve"))),
    )


def _with_docs(rows: DataFrame, docs: DataFrame, record: str, doc: str) -> DataFrame:
    parsed = docs.select(record, F.try_parse_json(F.col(doc)).alias("doc_v"))
    return rows.join(parsed, record, "left")


def audit_spans(expected: DataFrame, docs: DataFrame, record: str = "record_id", doc: str = "doc") -> DataFrame:
    """``record_id, entity_id, problem`` for expected entities (``entity_id, category, subtype,
    field_path, start, end``)."""
    rows = resolve_path(_with_docs(expected, docs, record, doc))
    is_text = F.schema_of_variant("value_v") == "STRING"
    size = F.char_length(F.col("value_v").cast("string"))
    problem = (
        F.when(F.col("doc_v").isNull(), F.lit("record_missing")).when(F.col("path_problem").isNotNull(), F.col("path_problem"))
        .when(~is_text, F.lit("not_a_string")).when(F.col("start") >= F.col("end"), F.lit("start_not_before_end"))
        .when(F.col("end") > size, F.lit("span_exceeds_length"))
    )
    bad = rows.select(record, "entity_id", problem.alias("problem")).where("problem IS NOT NULL")
    ids = expected.groupBy(record, "entity_id").agg(F.count("*").alias("_n")).where("_n > 1").select(
        record, "entity_id", F.lit("duplicate_entity_id").alias("problem"))
    spans = expected.groupBy(record, "field_path", "start", "end", "category", "subtype").agg(
        F.count("*").alias("_n"), F.min("entity_id").alias("entity_id")).where("_n > 1").select(
        record, "entity_id", F.lit("duplicate_span").alias("problem"))
    return bad.unionByName(ids).unionByName(spans)


def audit_preservation(
    protected: DataFrame, assertions: DataFrame, docs: DataFrame, record: str = "record_id", doc: str = "doc"
) -> DataFrame:
    """``record_id, item, problem``: protected-field hashes (``field_path, expected_value_sha256``) and
    required substrings (``assertion_id, field_path, required_substring``)."""
    p = resolve_path(_with_docs(protected, docs, record, doc))
    actual = F.sha2(F.to_json("value_v"), 256)
    wrong = F.when(F.col("path_problem").isNotNull(), F.col("path_problem")).when(
        actual != F.regexp_replace("expected_value_sha256", r"\Asha256:", ""), F.lit("hash_mismatch"))
    out = p.select(record, F.col("field_path").alias("item"), wrong.alias("problem"))
    twice = protected.groupBy(record, "field_path").agg(F.count("*").alias("_n")).where("_n > 1").select(
        record, F.col("field_path").alias("item"), F.lit("duplicate_protected_path").alias("problem"))
    a = resolve_path(_with_docs(assertions, docs, record, doc))
    lost = (
        F.when(F.col("path_problem").isNotNull(), F.col("path_problem"))
        .when(F.schema_of_variant("value_v") != "STRING", F.lit("not_a_string"))
        .when(~F.contains(F.col("value_v").cast("string"), F.col("required_substring")), F.lit("substring_absent"))
    )
    kept = a.select(record, F.col("assertion_id").alias("item"), lost.alias("problem"))
    again = assertions.groupBy(record, "assertion_id").agg(F.count("*").alias("_n")).where("_n > 1").select(
        record, F.col("assertion_id").alias("item"), F.lit("duplicate_assertion_id").alias("problem"))
    return out.unionByName(kept).where("problem IS NOT NULL").unionByName(twice).unionByName(again)


def audit_corpus(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """``item, problem``: listed against present files, hashes, duplicates, order.

    ``manifest``: ``pos, record_id, input_path, expected_path, input_sha256, expected_sha256``.
    ``files``: ``path, sha256``. The order check compares neighbours by an equi join on the position.
    """
    listed = manifest.select(F.explode(F.array(
        F.struct(F.col("input_path").alias("path"), F.col("input_sha256").alias("want")),
        F.struct(F.col("expected_path").alias("path"), F.col("expected_sha256").alias("want")),
    )).alias("_l")).select("_l.*")
    present = files.select("path", F.col("sha256").alias("have"), F.lit(True).alias("_present"))
    both = listed.withColumn("_listed", F.lit(True)).join(present, "path", "full_outer")
    state = (
        F.when(F.col("_present").isNull(), F.lit("file_not_found"))
        .when(F.col("_listed").isNull(), F.lit("unlisted_file"))
        .when(F.col("want") != F.col("have"), F.lit("sha256_mismatch"))
    )
    out = both.select(F.col("path").alias("item"), state.alias("problem")).where("problem IS NOT NULL")
    for c in ("record_id", "input_path", "expected_path"):
        out = out.unionByName(
            manifest.groupBy(c).agg(F.count("*").alias("_n")).where("_n > 1")
            .select(F.col(c).alias("item"), F.lit(f"duplicate_{c}").alias("problem")))
    escapes = F.lit(False)
    for c in ("input_path", "expected_path"):
        escapes = escapes | F.col(c).startswith("/") | F.array_contains(F.split(c, "/"), "..")
    out = out.unionByName(manifest.where(escapes).select(
        F.col("record_id").alias("item"), F.lit("path_not_relative").alias("problem")))
    after = manifest.select((F.col("pos") - 1).alias("pos"), F.col("record_id").alias("_next"))
    unsorted = manifest.select("pos", "record_id").join(after, "pos").where(F.col("record_id") > F.col("_next"))
    return out.unionByName(unsorted.select(F.col("record_id").alias("item"), F.lit("not_sorted").alias("problem")))


# --- L5: matching ---------------------------------------------------------------------------------

SPAN_KEYS = ["record_id", "field_path", "category"]
BIN = 256
#: Positions per block of the island search.
BLOCK = 65_536


def _span_bins(df: DataFrame, width: int) -> DataFrame:
    first = F.floor(F.col("start") / width)
    last = F.floor((F.greatest(F.col("end"), F.col("start") + 1) - 1) / width)
    return df.withColumn("_bin", F.explode(F.sequence(first, last)))


def overlapping_pairs(found: DataFrame, expected: DataFrame, keys: list[str], width: int = BIN) -> DataFrame:
    """(found_id, entity_id, overlap, exact, lo, hi) for spans of equal keys that overlap; lo, hi: hull of both.

    Spans are cut into position bins and joined on (keys, bin), so a long text with many spans
    spreads over tasks and distant spans never meet. A pair is kept only in the bin where its
    overlap starts.
    """
    f = _span_bins(found.select(*keys, "found_id", "start", "end"), width)
    e = _span_bins(expected.select(
        *keys, "entity_id", F.col("start").alias("e_start"), F.col("end").alias("e_end"),
        F.col("start"), F.col("end")), width).drop("start", "end")
    from_, to = F.greatest("start", "e_start"), F.least("end", "e_end")
    return (
        f.join(e, [*keys, "_bin"])
        .where((F.col("start") < F.col("e_end")) & (F.col("e_start") < F.col("end")))
        .where(F.col("_bin") == F.floor(from_ / width))
        .select(*keys, "found_id", "entity_id", (to - from_).alias("overlap"),
                ((F.col("start") == F.col("e_start")) & (F.col("end") == F.col("e_end"))).alias("exact"),
                F.least("start", "e_start").alias("lo"), F.greatest("end", "e_end").alias("hi"))
    )


def match_spans(found: DataFrame, expected: DataFrame, keys: list[str] | None = None, width: int = BIN) -> DataFrame:
    """One-to-one matches, largest overlap first: ``keys, found_id, entity_id, overlap, exact``.

    Ties go to the smaller entity id, then the smaller found id. Pairs that overlap without a gap form an
    island; islands are independent, so each is passed once, best pair first. Pairs arrive sorted and
    stream by: a task only remembers the ends taken in the current island. Of repeated rows one matches.
    """
    keys = keys or SPAN_KEYS
    pairs = cut_lineage(overlapping_pairs(found, expected, keys, width))
    # An island starts where no earlier pair of the same keys reaches; block borders keep hot keys apart.
    block = F.floor(F.col("lo") / BLOCK)
    order = ["lo", "hi", "entity_id", "found_id"]
    reach = blocked_before(pairs, keys, order, block, {"_reach": (F.col("hi"), F.max, F.greatest)})
    fresh = F.col("_reach").isNull() | (F.col("lo") >= F.col("_reach"))
    known = blocked_before(reach, keys, order, block, {"_before": (F.when(fresh, F.col("lo")), F.max, F.greatest)})
    islands = known.withColumn("_island", F.when(fresh, F.col("lo")).otherwise(F.col("_before")))
    group = [*keys, "_island"]
    out = [*keys, "found_id", "entity_id", "overlap", "exact"]
    ranked = islands.select(*group, *out[len(keys):]).repartition(*group).sortWithinPartitions(
        *group, F.desc("overlap"), "entity_id", "found_id")
    return ranked.mapInPandas(_greedy(group, out), ranked.select(*out).schema)


def _greedy(group: list[str], out: list[str]):
    """Rows sorted by (group, best pair first) -> the pairs whose ends no better pair of the group took."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, ends = None, set()
        for pdf in batches:
            keep = []
            for found, entity, *own in zip(pdf["found_id"], pdf["entity_id"], *(pdf[c] for c in group)):
                if own != current:
                    current, ends = own, set()
                pair = {("found", found), ("entity", entity)}
                keep.append(ends.isdisjoint(pair))
                if keep[-1]:
                    ends |= pair
            yield pdf.loc[keep, out]

    return run


def label_spans(found: DataFrame, expected: DataFrame, matches: DataFrame, keys: list[str] | None = None,
                dims: list[str] | None = None) -> DataFrame:
    """One row per outcome: ``dims, outcome (tp / fp / fn), exact``. ``dims`` exist on both inputs."""
    keys, dims = keys or SPAN_KEYS, dims or ["category"]
    fk, ek = list(dict.fromkeys([*keys, "found_id"])), list(dict.fromkeys([*keys, "entity_id"]))
    # Both sides use the matches: they are made once. One outer join gives hits and misses.
    matches = cut_lineage(matches.select(*dict.fromkeys([*fk, *ek]), "exact"))
    judged = expected.join(matches.select(*ek, "exact", F.lit(True).alias("_hit")), ek, "left").select(
        *dims, F.when(F.col("_hit"), F.lit("tp")).otherwise(F.lit("fn")).alias("outcome"),
        F.when(F.col("_hit"), F.col("exact")).otherwise(F.lit(False)).alias("exact"))
    fp = found.join(matches.select(*fk), fk, "left_anti").select(
        *dims, F.lit("fp").alias("outcome"), F.lit(False).alias("exact"))
    return judged.unionByName(fp)


# --- L6-L8: metrics -------------------------------------------------------------------------------


def add_scores(df: DataFrame) -> DataFrame:
    """Precision, recall, F1, F2 and exact-span accuracy from counts; null (with a reason) when a
    denominator is zero."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    p, r = F.col("precision"), F.col("recall")
    return (
        df.withColumns({"precision": F.try_divide(tp, tp + fp), "recall": F.try_divide(tp, tp + fn)})
        .withColumns({
            "f1": F.try_divide(2 * p * r, p + r), "f2": F.try_divide(5 * p * r, 4 * p + r),
            "exact_span_accuracy": F.try_divide(F.col("exact").cast("double"), tp),
        })
        .withColumn("null_reason", F.concat_ws(
            ",", F.when(p.isNull(), F.lit("no_detections")), F.when(r.isNull(), F.lit("no_expectations")),
            F.when(F.col("f1").isNull(), F.lit("f_undefined"))))
    )


def redaction_metrics(outcomes: DataFrame, dims: list[str]) -> DataFrame:
    """Metrics for every prefix of ``dims`` (``candidate`` > ``category`` > ``subtype`` > ``shape``) and
    in total, as grouping sets over one map-side aggregate."""
    sets = [[F.col(d) for d in dims[: i + 1]] for i in range(len(dims))] + [[]]
    counted = outcomes.groupingSets(sets, *[F.col(d) for d in dims]).agg(
        F.count_if(F.col("outcome") == "tp").alias("tp"), F.count_if(F.col("outcome") == "fp").alias("fp"),
        F.count_if(F.col("outcome") == "fn").alias("fn"), F.count_if(F.col("exact")).alias("exact"),
        F.grouping_id().cast("int").alias("grouping"),
    )
    return add_scores(counted)


def preservation_metrics(records: DataFrame, *keys: str) -> DataFrame:
    """Decision preservation, destructive false positives and modified clean records by ``keys``.

    ``records``: booleans ``has_assertions, assertions_kept, schema_valid, identity_unchanged,
    is_clean, modified`` and the count ``destructive_fp``.
    """
    kept = F.col("assertions_kept") & F.col("schema_valid") & F.col("identity_unchanged")
    subject = F.col("has_assertions")
    return records.groupBy(*keys).agg(
        F.count_if(subject).alias("decision_records"), F.count_if(subject & kept).alias("decisions_preserved"),
        F.try_divide(F.count_if(subject & kept).cast("double"), F.count_if(subject).cast("double"))
        .alias("decision_preservation"),
        F.sum("destructive_fp").alias("destructive_false_positives"),
        F.count_if(F.col("is_clean") & F.col("modified")).alias("clean_records_modified"),
        F.count_if(~F.col("identity_unchanged")).alias("protected_field_mutations"),
        F.count_if(~F.col("schema_valid")).alias("schema_validation_failures"),
    )


def determinism(runs: DataFrame, min_repeats: int = 5) -> DataFrame:
    """Per candidate and record: repeats, distinct digests and whether the record is deterministic."""
    return runs.groupBy("candidate", "record_id").agg(
        F.count("*").alias("repeats"), F.count_distinct("digest").alias("digests")
    ).withColumn("deterministic", (F.col("repeats") >= min_repeats) & (F.col("digests") == 1))


# --- L9-L11: gates and ranking ---------------------------------------------------------------------

GATE_STATUSES = ["failed", "passed", "pending"]  # fixed values
# Weights of the comparative score.
WEIGHTS = {"detection": 0.30, "precision": 0.20, "security": 0.20, "performance": 0.10, "packaging": 0.10,
           "maintainability": 0.10}


def gate_rollup(gates: DataFrame) -> DataFrame:
    """Per candidate: ``all_passed``, sorted pending and failed gate ids, and problems of the list.

    The collected sets hold gate ids, of which a candidate has a short fixed list.
    """
    status, gid = F.col("status"), F.col("gate_id")
    pick = lambda s: F.array_sort(F.collect_set(F.when(status == s, gid)))
    valid = F.coalesce(status.isin(*GATE_STATUSES), F.lit(False))
    return gates.groupBy("candidate").agg(
        (F.coalesce(F.bool_and(F.when(valid, status == "passed")), F.lit(False))).alias("all_passed"),
        pick("pending").alias("pending_gate_ids"), pick("failed").alias("failed_gate_ids"),
        F.count_if(~valid).alias("invalid_statuses"),
        (F.count(gid) - F.count_distinct(gid)).alias("duplicate_gate_ids"),
    )


def rank_candidates(scores: DataFrame, rollup: DataFrame) -> DataFrame:
    """Weighted score and rank among candidates that passed every gate; equal scores share a rank."""
    total = sum((F.col(k) * w for k, w in WEIGHTS.items()), F.lit(0.0))
    eligible = scores.join(rollup.where("all_passed").select("candidate"), "candidate", "left_semi")
    scored = eligible.withColumn("weighted_score", F.round(total, 6))
    return ranked(scored, "weighted_score", "rank")


def audit_candidates(matrix: DataFrame, gates: DataFrame, metrics: DataFrame) -> DataFrame:
    """``candidate, problem`` across the candidate matrix (``configuration_digest, corpus_digest,
    hard_gates_passed, selection_eligible, pending_gate_ids``), the gate rollup and the metrics
    (``corpus_digest``)."""
    m = matrix.select("candidate", F.struct(*[c for c in matrix.columns if c != "candidate"]).alias("m"))
    g = gates.select("candidate", F.struct("all_passed", "pending_gate_ids").alias("g"))
    x = metrics.select("candidate", F.struct("corpus_digest").alias("x"))
    rows = m.join(g, "candidate", "full_outer").join(x, "candidate", "full_outer")
    digest = r"\A(?:sha256:)?[0-9a-f]{64}\z"
    passed = F.coalesce("g.all_passed", F.lit(False))
    checks = [
        F.when(F.col("m").isNull(), F.lit("missing_in_matrix")), F.when(F.col("g").isNull(), F.lit("missing_in_gates")),
        F.when(F.col("x").isNull(), F.lit("missing_in_metrics")),
        F.when(~F.col("m.pending_gate_ids").eqNullSafe(F.col("g.pending_gate_ids")), F.lit("pending_ids_drift")),
        F.when(~F.col("m.hard_gates_passed").eqNullSafe(passed), F.lit("hard_gates_inconsistent")),
        F.when(~F.col("m.selection_eligible").eqNullSafe(passed), F.lit("selection_inconsistent")),
        F.when(~F.coalesce(F.col("m.configuration_digest").rlike(digest), F.lit(False)),
               F.lit("configuration_digest_invalid")),
        F.when(~F.coalesce(F.col("m.corpus_digest").rlike(digest), F.lit(False)), F.lit("corpus_digest_invalid")),
        F.when(F.col("x.corpus_digest").isNotNull() & (F.col("x.corpus_digest") != F.col("m.corpus_digest")),
               F.lit("metric_corpus_digest_differs")),
    ]
    out = rows.select("candidate", F.explode(F.array_compact(F.array(*checks))).alias("problem"))
    several = matrix.agg(F.count_distinct("corpus_digest").alias("_n")).where("_n > 1").select(
        F.lit(None).cast("string").alias("candidate"), F.lit("several_corpus_digests").alias("problem"))
    return out.unionByName(several)
