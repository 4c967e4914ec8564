"""Trace, chain and conformance audits. Each returns rows with a value-free ``problem``.

Neighbouring records are found by equi joins on (group, position) or by windows over blocks of positions, so one
long chain spreads over many tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from sievelight.functions import variant as V
from sievelight.functions.canonical import (
    ascii_json, canonical, canonical_digest, json_array, json_map, json_object, json_string,
)
from sievelight.functions.crypto import sha256_tag
from sievelight.functions.sensitive import EMAIL_PATTERN, has_hit
from sievelight.functions.text import first_text, pin, strip
from sievelight.operators.redaction import FLAG_KEYS, has_flags, observation_text, signals_json, sorted_map
from sievelight.operators.skew import blocked_before

# --- K1: phase traces -----------------------------------------------------------------------------

# Phase id, what it produces, authority before, after and transition.
PHASES = [
    ("PHASE-01-PROVIDER-ACQUISITION", "provider-capture/v1", "external_evidence", "external_evidence", "none"),
    ("PHASE-04-OBSERVATION", "observation/v1", "external_evidence", "normalized_evidence", "normalize"),
    ("PHASE-05-PROVIDER-ADVISORIES", "ingress-advisory/v1", "normalized_evidence", "normalized_evidence", "annotate"),
    ("PHASE-06-UNIVERSAL-NORMALIZATION", "adapter-emission/v1", "normalized_evidence", "normalized_evidence",
     "normalize"),
    ("PHASE-07-UNIVERSAL-ADVISORIES", "ingress-advisory/v1", "normalized_evidence", "normalized_evidence", "annotate"),
    ("PHASE-08-GATEWAY-MAPPING", "external-ingest-envelope/v2", "normalized_evidence", "normalized_evidence",
     "wire_projection"),
    ("PHASE-08-GATEWAY-DELIVERY", "gateway-delivery-receipt/v1", "normalized_evidence", "normalized_evidence",
     "deliver"),
]
CONTRACTS = {p[0]: p[1] for p in PHASES}


def _advisory_json(arr: Column) -> Column:
    return json_array(F.transform(arr, lambda a: json_object({
        "code": json_string(a["kind"]), "message": json_string(a["message"]),
        "metadata": json_map(a["metadata"], flags=("schema_version",)),
    })))


def emission_fields(prefix: str) -> dict[str, Column]:
    """Encoded JSON values of an emission checkpoint by key, without its advisories."""

    def c(name: str) -> Column:
        return F.col(prefix + name)

    signals = {"advisory_signals": signals_json(c("advisory_signals"))}
    evidence = json_array(F.transform(c("evidence"), lambda e: json_object({
        "source_ref": json_object({k: json_string(e["source_ref"][k]) for k in ("source_id", "ref", "url", "kind")}),
        "metadata": json_map(e["metadata"], signals, FLAG_KEYS),
        **{k: json_string(e[k]) for k in ("excerpt", "author", "timestamp", "evidence_id")},
    })))
    provenance = F.when(c("provenance").isNull(), F.lit("null")).otherwise(json_object({
        k: json_string(c("provenance")[k])
        for k in ("delivery_mode", "verification", "provider_event_id", "provider_resource_id")
    }))
    return {
        **{k: json_string(c(k)) for k in ("source_id", "title", "body", "emission_type", "adapter_version")},
        "evidence": evidence, "provenance": provenance,
        "metadata": json_map(c("metadata"), signals, FLAG_KEYS),
    }


def _emission_rest(prefix: str) -> Column:
    """JSON of an emission checkpoint without its version and advisories, keys in order.

    Without signals and flags every value is text: one writer call encodes the row.
    """
    fields = emission_fields(prefix)
    del fields["adapter_version"]

    def texts(s: Column, keys) -> list[Column]:
        return [F.coalesce(s[k], F.lit("")).alias(k) for k in keys]

    row = {k: F.coalesce(F.col(prefix + k), F.lit("")) for k in ("source_id", "title", "body", "emission_type")}
    provenance = F.col(prefix + "provenance")
    row["evidence"] = F.transform(prefix + "evidence", lambda e: F.struct(
        *texts(e, ("author", "evidence_id", "excerpt")), sorted_map(e["metadata"]).alias("metadata"),
        F.struct(*texts(e["source_ref"], ("kind", "ref", "source_id", "url"))).alias("source_ref"), *texts(e, ("timestamp",))))
    row["metadata"] = sorted_map(F.col(prefix + "metadata"))
    row["provenance"] = F.when(provenance.isNotNull(), F.struct(
        *texts(provenance, ("delivery_mode", "provider_event_id", "provider_resource_id", "verification"))))
    plain = F.to_json(F.struct(*[row[k].alias(k) for k in sorted(row)]), {"ignoreNullFields": "false"})
    special = (
        F.col(prefix + "advisory_signals").isNotNull() | F.col(prefix + "evidence").isNull() | has_flags(F.col(prefix + "metadata"))
        | F.exists(prefix + "evidence", lambda e: has_flags(e["metadata"]))
    )
    return F.when(special, json_object(fields)).otherwise(plain)


def _column_digest(col: Column) -> Column:
    """``canonical_digest`` of a plain column: only text with control escapes leaves the generated code."""
    return sha256_tag(F.when(F.contains(col, F.lit("\\u00")), canonical(col)).otherwise(col))


def phase_trace(df: DataFrame, trace: str = "trace_id", envelope: str = "envelope_json",
                capture: str | None = None, delivery: str | None = None) -> DataFrame:
    """Up to seven phase records per row of ``trace_id, o (observation), e (emission), envelope_json``.

    ``capture`` and ``delivery`` name optional JSON text columns; delivery needs ``status`` in it.
    Each phase's input is the previous phase's output, so the digests form a chain.
    """
    scoped = lambda s: F.filter("e.advisories", lambda a: a["metadata"]["scope"] == s)
    no_text = F.lit(None).cast("string")
    # Encode every part once; the documents of the phases are put together from the same pieces.
    encoded = pin(df, {
        "_observation": observation_text("o."), "_rest": _emission_rest("e."), "_version": json_string(F.col("e.adapter_version")),
        "_adv_integration": _advisory_json(scoped("integration")), "_adv_all": _advisory_json(F.col("e.advisories")),
        "_provider_codes": F.transform(scoped("integration"), lambda a: a["kind"]),
        "_universal_codes": F.transform(scoped("universal"), lambda a: a["kind"]),
    })

    def ahead(head: list[Column], document: str) -> Column:
        """An object with members in front of its own; keys stay in order, as the callers choose them."""
        return F.concat(F.lit("{"), *head, F.lit(","), F.substring(document, 2, 2**31 - 1))

    def advised(advisories: str) -> list[Column]:
        return [F.lit('"advisories":'), F.col(advisories)]

    def emission(advisories: str) -> Column:
        return ahead([F.lit('"adapter_version":'), F.col("_version"), F.lit(","), *advised(advisories)], "_rest")

    base = encoded.select(
        trace, "_observation", "_provider_codes", "_universal_codes",
        F.col(envelope).alias("_envelope"), (F.col(capture) if capture else no_text).alias("_capture"),
        (F.col(delivery) if delivery else no_text).alias("_delivery"), ahead(advised("_adv_integration"), "_observation").alias("_annotated"),
        emission("_adv_integration").alias("_normalized"), emission("_adv_all").alias("_emission"),
    )
    delivered = F.coalesce(
        V.text(F.try_parse_json("_delivery"), "$.status") == "accepted", F.lit(False)
    ) | F.coalesce(V.integer(F.try_parse_json("_delivery"), "$.status") == 201, F.lit(False))
    none = F.array().cast("array<string>")
    base = base.withColumns({"_start": F.coalesce("_capture", F.lit("{}")), "_gate": F.when(delivered, F.lit("pass")).otherwise(F.lit("fail"))})
    # A phase's input is the output before it: each document has one digest.
    documents = ["_start", "_capture", "_observation", "_annotated", "_normalized", "_emission", "_envelope", "_delivery"]
    base = base.withColumns({f"{c}_digest": _column_digest(F.col(c)) for c in documents})
    steps = [
        ("_capture", "_start", none, F.lit("pass")), ("_observation", "_start", none, F.lit("pass")),
        ("_annotated", "_observation", F.col("_provider_codes"), no_text),
        ("_normalized", "_annotated", none, F.lit("pass")),
        ("_emission", "_normalized", F.col("_universal_codes"), no_text),
        ("_envelope", "_emission", none, F.lit("pass")),
        ("_delivery", "_envelope", none, F.col("_gate")),
    ]
    records = [
        F.when(F.col(out).isNotNull(), F.struct(
            F.lit(phase).alias("phase_id"), F.lit(contract).alias("contract_id"),
            F.col(given).alias("input_data"), F.col(out).alias("output_data"),
            F.col(f"{given}_digest").alias("input_digest"), F.col(f"{out}_digest").alias("output_digest"),
            codes.alias("advisories"), gate.alias("gate"), F.lit(before).alias("authority_before"),
            F.lit(after).alias("authority_after"), F.lit(move).alias("authority_transition"),
            F.lit(False).alias("canonical"),
            F.when(gate == "fail", F.lit("failed")).otherwise(F.lit("completed")).alias("receipt_status"),
        ))
        for (phase, contract, before, after, move), (out, given, codes, gate) in zip(PHASES, steps)
    ]
    return base.select(trace, F.posexplode(F.array_compact(F.array(*records))).alias("pos", "_r")).select(
        trace, "pos", "_r.*"
    )


def _problems(df: DataFrame, keys: list[str], *checks: Column) -> DataFrame:
    """Explode the failed checks of each row."""
    return df.select(*keys, F.explode(F.array_compact(F.array(*checks))).alias("problem"))


#: Positions of a group that are settled side by side in one task.
RUN = 4096


def previous_row(df: DataFrame, keys: list[str], pos: str, values: list[str]) -> DataFrame:
    """Add ``prev_<value>`` and ``has_prev`` from the rows at ``pos - 1``, as an equi join would: a row comes once for each of them.

    The rows are made and shuffled once, by runs of positions, so a long group spreads over many tasks. The last rows of a run
    are seen by the next one too.
    """
    run = lambda p: F.floor(p / RUN)
    own, following = run(F.col(pos)), run(F.col(pos) + 1)
    dealt = df.select("*", F.posexplode(F.when(following > own, F.array(own, following)).otherwise(F.array(own))).alias("_seen", "_run"))
    before = Window.partitionBy(*keys, "_run").orderBy(pos).rangeBetween(-1, -1)
    known = F.col(pos).isNotNull()
    for k in keys:
        known = known & F.col(k).isNotNull()
    found = F.collect_list(F.struct(F.lit(True).alias("has_prev"), *[F.col(v).alias(f"prev_{v}") for v in values])).over(before)
    rows = dealt.withColumn("_found", found).where("_seen = 0").withColumn("_found", F.when(known, F.col("_found")))
    return rows.select(*df.columns, F.explode_outer("_found").alias("_p")).select(
        *df.columns, *[F.col(f"_p.prev_{v}").alias(f"prev_{v}") for v in values], F.coalesce("_p.has_prev", F.lit(False)).alias("has_prev"))


def audit_trace(df: DataFrame, trace: str = "trace_id") -> DataFrame:
    """``trace_id, pos, problem`` for phase records (contiguous ``pos`` from zero)."""
    rows = previous_row(df, [trace], "pos", ["output_digest"])
    contract = F.create_map(*[F.lit(x) for kv in CONTRACTS.items() for x in kv])
    found = _problems(
        rows, [trace, "pos"],
        F.when(strip(F.coalesce("phase_id", F.lit(""))) == "", F.lit("phase_id_required")),
        F.when(~contract[F.col("phase_id")].eqNullSafe(F.col("contract_id")), F.lit("contract_id_invalid")),
        F.when(F.col("input_digest") != canonical_digest(F.col("input_data")), F.lit("input_digest_invalid")),
        F.when(F.col("output_digest") != canonical_digest(F.col("output_data")), F.lit("output_digest_invalid")),
        F.when(F.col("has_prev") & (F.col("input_digest") != F.col("prev_output_digest")),
               F.lit("digest_chain_broken")),
        F.when(~F.col("canonical").eqNullSafe(F.lit(False)), F.lit("canonical_authority")),
    )
    repeated = df.groupBy(trace, "phase_id").agg(F.min("pos").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    again = (
        df.join(repeated, [trace, "phase_id"]).where(F.col("pos") > F.col("_first"))
        .select(trace, "pos", F.lit("duplicate_phase_id").alias("problem"))
    )
    return found.unionByName(again)


def audit_phases(df: DataFrame, required: list[str], trace: str = "trace_id") -> DataFrame:
    """``trace_id, problem`` for lifecycle phases: ``phase_id, title, function, data_json, display,
    preserved, added, removed, gate`` (ledger columns are string arrays)."""
    blank = lambda c: strip(F.coalesce(F.col(c), F.lit(""))) == ""
    name = F.coalesce("phase_id", F.lit(""))

    def ledger_bad(c: str) -> Column:
        return F.col(c).isNull() | F.exists(c, lambda x: x.isNull() | (strip(x) == ""))

    label = lambda suffix: F.concat(F.lit("phase_"), name, F.lit(suffix))
    v = F.try_parse_json("data_json")
    checks = [
        F.when(blank("phase_id"), F.lit("phase_id_required")),
        F.when(blank("title"), label("_title_required")), F.when(blank("function"), label("_function_required")),
        F.when(~V.is_object(v) | (V.kind(v, "$") == "OBJECT<>"), label("_data_required")),
        F.when(ledger_bad("display") | (F.size("display") == 0), label("_display_required")),
        *[F.when(ledger_bad(c), label(f"_{c}_items_must_be_nonempty_strings")) for c in ("preserved", "added", "removed")],
        F.when(blank("gate"), label("_gate_required")),
    ]
    found = _problems(df, [trace], *checks)
    counts = df.groupBy(trace, "phase_id").agg(F.count("*").alias("_n"))
    again = counts.where("_n > 1").select(trace, F.concat(F.lit("duplicate_phase_id:"), "phase_id").alias("problem"))
    needed = F.array(*map(F.lit, required)) if required else F.array().cast("array<string>")
    # Only required ids are collected, so the set has at most that many members.
    seen = df.groupBy(trace).agg(
        F.collect_set(F.when(F.col("phase_id").isin(*required), F.col("phase_id"))).alias("_seen")
    )
    missing = seen.withColumn("_missing", F.array_except(needed, "_seen")).where("size(_missing) > 0").select(
        trace, F.concat(F.lit("missing_required_phases:"), F.array_join("_missing", ",")).alias("problem")
    )
    return found.unionByName(again).unionByName(missing)


# --- K4-K8: compare two tables --------------------------------------------------------------------


def audit_loss(observations: DataFrame, emissions: DataFrame, key: str) -> DataFrame:
    """``key, problem``: an observation without emission or the reverse, or a changed excerpt."""
    o = observations.select(key, F.col("excerpt").alias("_o"), F.lit(True).alias("_has_o"))
    e = emissions.select(key, F.get("evidence", F.lit(0))["excerpt"].alias("_e"), F.lit(True).alias("_has_e"))
    problem = (
        F.when(F.col("_has_e").isNull(), F.lit("emission_missing"))
        .when(F.col("_has_o").isNull(), F.lit("observation_missing"))
        .when(~F.col("_o").eqNullSafe(F.col("_e")), F.lit("content_changed"))
    )
    return o.join(e, key, "full_outer").select(key, problem.alias("problem")).where("problem IS NOT NULL")


# Order in which golden stages are compared.
GOLDEN_STAGES = [
    "acquisition_verification", "parsed_facts", "redaction_receipt", "integration_advisories", "observation",
    "universal_advisories", "adapter_emission", "external_ingest_envelope", "delivery_or_cursor",
]


def harness_digest(encoded: Column) -> Column:
    """Digest of canonical JSON with non-ASCII characters escaped."""
    return sha256_tag(ascii_json(encoded))


def golden_diff(actual: DataFrame, golden: DataFrame, keys: list[str] | None = None,
                stages: list[str] | None = None) -> DataFrame:
    """Per connector and mode: stages passed before the first failing stage, and both digests there.

    Inputs have ``connector, mode, stage, digest``.
    """
    keys = keys or ["connector", "mode"]
    order = F.array_position(F.array(*map(F.lit, stages or GOLDEN_STAGES)), F.col("stage"))
    a = actual.select(*keys, "stage", F.col("digest").alias("observed_digest"))
    g = golden.select(*keys, "stage", F.col("digest").alias("expected_digest"))
    both = a.join(g, [*keys, "stage"], "full_outer").withColumn("_no", order)
    bad = ~F.col("observed_digest").eqNullSafe(F.col("expected_digest"))
    first = F.min(F.when(bad, F.struct("_no", "stage", "expected_digest", "observed_digest")))
    return both.groupBy(*keys).agg(
        first.alias("_f"), F.count_if(~bad).alias("matching_stages"), F.count("*").alias("stages")
    ).select(
        *keys, "stages", "matching_stages", F.col("_f.stage").alias("failed_stage"),
        F.col("_f.expected_digest").alias("expected_digest"), F.col("_f.observed_digest").alias("observed_digest"),
        F.col("_f").isNull().alias("passed"),
    )


# Fields an acquisition receipt must have.
ACQUISITION_FIELDS = [
    "original_payload_sha256", "provider_headers", "provider_verification", "replay_window", "receiver",
    "captured_at", "source_scope",
]


def resolve_dots(path: Column) -> Column:
    """Absolute form of a repository path: ``.`` and ``..`` are resolved."""
    parts = F.aggregate(
        F.split(path, "/"), F.array().cast("array<string>"),
        lambda acc, p: F.when(p.isin("", "."), acc)
        .when(p == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))))
        .otherwise(F.concat(acc, F.array(p))),
    )
    return F.concat(F.lit("/"), F.array_join(parts, "/"))


def audit_acquisition(df: DataFrame, receipt: str = "receipt_v", require_verified: Column | None = None,
                      path: str | None = None, keys: list[str] | None = None) -> DataFrame:
    """First problem per capture receipt (VARIANT). ``path`` names a column that must lie in the scope."""
    v = F.col(receipt)
    keys = keys or [c for c in df.columns if c not in (receipt, path)]
    absent = F.lit(False)
    for f in ACQUISITION_FIELDS:
        absent = absent | V.kind(v, f"$.{f}").isNull()
    must = F.lit(True) if require_verified is None else require_verified
    result = V.text(v, "$.provider_verification.result")
    problem = (
        F.when(~V.is_object(v), F.lit("receipt_missing")).when(absent, F.lit("receipt_incomplete"))
        .when(V.text(v, "$.provider_verification.over") != "original_bytes", F.lit("not_over_original_bytes"))
        .when(must & (result != "verified"), F.lit("not_verified"))
        .when(~must & ~result.isin("verified", "not_applicable"), F.lit("verification_result_invalid"))
        .when(~V.loose(v, "$.original_payload_sha256").startswith("sha256:"), F.lit("payload_digest_missing"))
    )
    if path is not None:
        root = resolve_dots(V.loose(v, "$.source_scope"))
        full = resolve_dots(F.coalesce(F.col(path), F.lit("")))
        inside = (full == root) | full.startswith(F.concat(F.rtrim(root, F.lit("/")), F.lit("/")))
        problem = problem.when(~inside, F.lit("path_escapes_scan_root"))
    return df.select(*keys, problem.alias("problem")).where("problem IS NOT NULL")


IDENTITY_PROOF = ["source_ref.ref", "source_ref.source_id", "timestamp", "mode"]  # fixed values


def structural_proof(raw: DataFrame, sanitized: DataFrame, key: str) -> DataFrame:
    """Parse-both-and-compare: per key the fields that differ and ``preserved``.

    Inputs are the observations of the raw and of the sanitized payloads.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(key, F.array(*[F.col(f).cast("string") for f in IDENTITY_PROOF]).alias(name))

    both = side(raw, "_a").join(side(sanitized, "_b"), key, "full_outer")
    names = F.array(*[F.lit(f.split(".")[-1]) for f in IDENTITY_PROOF])
    changed = F.array_compact(F.transform(
        names, lambda n, i: F.when(~F.get("_a", i).eqNullSafe(F.get("_b", i)), n)))
    return both.select(key, changed.alias("changed_fields")).withColumn("preserved", F.size("changed_fields") == 0)


# Placeholder per category.
PLACEHOLDERS = {
    "[redacted:email]": "pii", "[redacted:phone]": "pii", "[redacted:secret]": "secret", "[redacted:phi]": "phi",
    "[redacted:pan]": "pan",
}


def _occurrences(col: Column, needle: str) -> Column:
    return ((F.char_length(col) - F.char_length(F.replace(col, F.lit(needle), F.lit("")))) / len(needle)).cast("int")


def redaction_delta(df: DataFrame, before: str, after: str, *keys: str) -> DataFrame:
    """Placeholders added by sanitizing, by category and ``keys``; only growth counts."""
    deltas = F.array(*[
        F.struct(F.lit(cat).alias("category"),
                 (_occurrences(F.col(after), tok) - _occurrences(F.col(before), tok)).alias("n"))
        for tok, cat in PLACEHOLDERS.items()
    ])
    rows = df.select(*keys, F.explode(F.filter(deltas, lambda d: d["n"] > 0)).alias("_d"))
    return rows.groupBy(*keys, F.col("_d.category").alias("category")).agg(F.sum("_d.n").alias("added"))


# --- K9-K12: ledgers and stage bundles -------------------------------------------------------------


def ledger_entries(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """Ledger text split into entries: ``keys, pos, entry_no, content, previous, chain, is_genesis``."""
    head = r"(?m)^### Entry #(\d+)"
    numbers = F.regexp_extract_all(F.col(text), F.lit(head), F.lit(1))
    bodies = F.split(F.col(text), head, -1)
    rows = df.select(
        *keys, F.posexplode(F.transform(numbers, lambda n, i: F.struct(n.alias("n"), F.get(bodies, i + 1).alias("body"))))
        .alias("pos", "_e"),
    )
    return parse_ledger(rows.select(*keys, "pos", F.col("_e.n").alias("entry_no"), F.col("_e.body").alias("body")))


def parse_ledger(df: DataFrame, body: str = "body") -> DataFrame:
    b = F.col(body)
    prev = strip(F.regexp_extract(b, r"\*\*Previous Hash\*\*:\s*(.+)", 1))
    hex_prev = F.regexp_extract(prev, r"\A[0-9a-f]{64}", 0)

    def after(label: str) -> Column:
        return F.nullif(F.regexp_extract(b, f"(?s){label}.*?([0-9a-f]{{64}})", 1), F.lit(""))

    return df.withColumns({
        "content": after("Content Hash"), "chain": after("Chain Hash"),
        "previous": F.nullif(first_text(hex_prev, prev), F.lit("")),
    }).withColumn("is_genesis", F.coalesce(F.contains("previous", F.lit("GENESIS")), F.lit(False))).drop(body)


def audit_ledger(df: DataFrame, ledger: str, pos: str = "pos", block_size: int = 100_000) -> DataFrame:
    """``ledger, pos, problem`` for entries ``content, previous, chain, is_genesis``.

    The link to compare with is the last valid one before the entry. It comes from a running maximum over
    (position, link), next to the first genesis as a running minimum; both are split into blocks of positions in
    one pass, so a ledger of any length is checked in parallel.
    """
    whole = F.col("content").isNotNull() & F.col("previous").isNotNull() & F.col("chain").isNotNull()
    gen = F.col("is_genesis")
    link = F.when(gen | whole, F.struct(F.col(pos).alias("p"), F.when(gen, F.col("content")).otherwise(
        F.col("chain")).alias("link")))
    rows = blocked_before(
        df, [ledger], [pos], F.floor(F.col(pos) / block_size),
        {"_last": (link, F.max, F.greatest), "_first": (F.when(gen, F.col(pos)), F.min, F.least)})
    expected = F.col("_last.link")
    return _problems(
        rows, [ledger, pos],
        F.when(gen & F.col("_first").isNotNull(), F.lit("multiple_genesis")),
        F.when(gen & F.col("content").isNull(), F.lit("genesis_without_content_hash")),
        F.when(gen & F.col("chain").isNotNull(), F.lit("genesis_with_chain_hash")),
        F.when(~gen & ~whole, F.lit("missing_hash")),
        F.when(~gen & whole & expected.isNotNull() & (F.col("previous") != expected), F.lit("previous_not_linked")),
        F.when(~gen & whole & (F.sha2(F.concat("content", "previous"), 256) != F.col("chain")),
               F.lit("chain_hash_mismatch")),
    )


# Stage order of a bundle and the rank of evidence classes.
STAGE_ORDER = [
    "raw_acquisition", "acquisition_verification", "sanitized_capture", "provider_fact_extraction",
    "provider_neutral_observation", "guarded_redaction", "sanitized_observation", "redaction_receipt",
    "integration_advisories", "universal_normalization", "universal_advisories", "adapter_emission",
    "external_ingest_envelope", "cursor_or_delivery_decision", "gateway_negotiation", "bot_acceptance",
    "durable_evidence", "candidate_or_decision_lifecycle", "recall_transformation", "agent_session_exposure",
]
CLASS_RANK = {"none": 0, "component": 1, "observed_live": 2, "terminal_product": 3, "human_accepted": 4}


def audit_stage_chain(df: DataFrame, bundle: str = "bundle_id", order: list[str] | None = None) -> DataFrame:
    """``bundle_id, pos, problem`` for stage records (``pos`` from zero) with ``stage_id, record_json,
    stage_record_digest, prev_stage_id, prev_stage_digest``; ``record_json`` is the canonical record
    without its digest and link."""
    rows = previous_row(
        df.withColumnsRenamed({"prev_stage_id": "link_stage", "prev_stage_digest": "link_digest"}),
        [bundle], "pos", ["stage_id", "stage_record_digest"],
    )
    names = F.array(*map(F.lit, order if order is not None else STAGE_ORDER))
    first = F.col("pos") == 0
    return _problems(
        rows, [bundle, "pos"],
        F.when(~F.get(names, F.col("pos").cast("int")).eqNullSafe(F.col("stage_id")), F.lit("stage_order")),
        F.when(~canonical_digest(F.col("record_json")).eqNullSafe(F.col("stage_record_digest")),
               F.lit("record_digest_mismatch")),
        F.when(first & F.col("link_stage").isNotNull(), F.lit("first_stage_has_link")),
        F.when(~first & F.col("link_stage").isNull(), F.lit("link_required")),
        F.when(~first & F.col("link_stage").isNotNull() & (F.col("link_stage") != F.col("prev_stage_id")),
               F.lit("link_stage_mismatch")),
        F.when(~first & F.col("link_stage").isNotNull()
               & ~F.col("link_digest").eqNullSafe(F.col("prev_stage_record_digest")), F.lit("link_broken")),
    )


def audit_dependencies(stages: DataFrame, bundle: str = "bundle_id") -> DataFrame:
    """``bundle_id, stage_id, depends_on, problem`` for ``depends_on_outputs`` (array of struct
    ``stage_id, output_digest, required_output, status``) against ``output_digest`` of the stages.

    A cited stage must not come later than the one that cites it.
    """
    deps = stages.select(bundle, "stage_id", "pos", F.explode("depends_on_outputs").alias("_d")).select(
        bundle, F.col("stage_id").alias("_stage"), F.col("pos").alias("_pos"), F.col("_d.stage_id").alias("stage_id"),
        F.col("_d.output_digest").alias("_cited"), F.col("_d.required_output").alias("_required"),
        F.col("_d.status").alias("_status"),
    )
    target = stages.select(bundle, "stage_id", F.col("pos").alias("_tpos"), F.col("output_digest").alias("_actual"))
    rows = deps.join(target, [bundle, "stage_id"], "left")
    cites = F.col("_cited").isNotNull()
    misses = F.col("_required").isNotNull() | F.col("_status").eqNullSafe(F.lit("missing"))
    produced = F.col("_actual").isNotNull() & (F.col("_tpos") <= F.col("_pos"))
    problem = (
        F.when(cites == misses, F.lit("exactly_one_of_digest_or_missing"))
        .when(cites & ~F.coalesce(produced, F.lit(False)), F.lit("no_output_artifacts"))
        .when(cites & (F.col("_cited") != F.col("_actual")), F.lit("output_digest_mismatch"))
        .when(~cites & (~F.col("_status").eqNullSafe(F.lit("missing"))
                        | (strip(F.coalesce("_required", F.lit(""))) == "")), F.lit("missing_declaration_incomplete"))
        .when(~cites & F.col("_actual").isNotNull(), F.lit("has_real_output"))
    )
    return rows.select(
        bundle, F.col("_stage").alias("stage_id"), F.col("stage_id").alias("depends_on"), problem.alias("problem")
    ).where("problem IS NOT NULL")


def audit_status(stages: DataFrame, bundle: str = "bundle_id", declared: DataFrame | None = None) -> DataFrame:
    """``bundle_id, stage_id, problem``: status rules, and the declared bundle class against the
    strongest class held (``declared``: ``bundle_id, evidence_class``).

    "Nothing passes after a failed or unproven stage" only needs the first such position per bundle,
    which is a map-side minimum.
    """
    bad = F.col("status").isin("failed", "unproven")
    firsts = stages.groupBy(bundle).agg(F.min(F.when(bad, F.col("pos"))).alias("_bad"))
    rows = stages.join(firsts, bundle)
    held, passed = F.coalesce("evidence_class", F.lit("")), F.col("status") == "passed"
    unproven, out = F.col("status") == "unproven", F.col("output_digest").isNotNull()
    found = _problems(
        rows, [bundle, "stage_id"],
        F.when(passed & (F.col("pos") > F.col("_bad")), F.lit("passed_after_failed_or_unproven")),
        F.when(passed & ~out, F.lit("passed_without_output")),
        F.when(passed & (held == "none"), F.lit("passed_holds_none")),
        F.when(passed & ~held.isin("none", "component"), F.lit("held_class_without_receipt")),
        F.when(unproven & out, F.lit("unproven_with_output")),
        F.when(unproven & (held != "none"), F.lit("unproven_holds_evidence")),
        F.when(unproven & ~F.coalesce("required_evidence_class", F.lit("")).isin(*list(CLASS_RANK)[1:]),
               F.lit("required_class_missing")),
    )
    if declared is None:
        return found
    strongest = stages.groupBy(bundle).agg(F.max(F.when(passed & (held == "component"), F.lit(1)).otherwise(
        F.lit(0))).alias("_held"))
    ranks = F.create_map(*[F.lit(x) for kv in CLASS_RANK.items() for x in kv])
    wrong = declared.join(strongest, bundle).where(~ranks[F.col("evidence_class")].eqNullSafe(F.col("_held"))).select(
        bundle, F.lit(None).cast("string").alias("stage_id"), F.lit("bundle_class_not_strongest_held").alias("problem")
    )
    return found.unionByName(wrong)


def strongest_class(stages: DataFrame, bundle: str = "bundle_id") -> DataFrame:
    held = F.when((F.col("status") == "passed") & (F.col("evidence_class") == "component"), F.lit(1)).otherwise(F.lit(0))
    names = F.array(*map(F.lit, CLASS_RANK))
    return stages.groupBy(bundle).agg(F.max(held).alias("_r")).select(
        bundle, F.get(names, "_r").alias("strongest_class"))


# --- K13-K14 --------------------------------------------------------------------------------------


def audit_raw_samples(texts: DataFrame, policy: DataFrame, keys: list[str], stage: str = "stage_id",
                      text: str = "text") -> DataFrame:
    """``keys, stage_id, problem`` with counts of distinct values: e-mails outside the allow-list.

    ``policy`` has one row per ``value_digest`` with ``allowed_stage_ids``. Values travel as digests
    only. Texts with catalog data are reported once.
    """
    value = lambda e: sha256_tag(e)
    found = (
        texts.where(F.contains(F.col(text), F.lit("@")))
        .select(*keys, stage, F.explode(F.array_distinct(F.transform(
            F.regexp_extract_all(F.col(text), F.lit("(?U)" + EMAIL_PATTERN), F.lit(0)), value))).alias("value_digest"))
    )
    judged = found.join(policy.select("value_digest", "allowed_stage_ids"), "value_digest", "left")
    problem = F.when(F.col("allowed_stage_ids").isNull(), F.lit("unknown_email")).when(
        ~F.array_contains("allowed_stage_ids", F.col(stage)), F.lit("outside_allowed_stage"))
    mails = judged.select(*keys, stage, problem.alias("problem")).where("problem IS NOT NULL")
    hits = texts.where(has_hit(F.col(text))).select(*keys, stage, F.lit("sensitive_data").alias("problem"))
    return mails.unionByName(hits).groupBy(*keys, stage, "problem").agg(F.count("*").alias("n_values"))


def _stream_digest(group: list[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state, count = None, None, 0

        def row():
            state.update(b"]")
            return [*current, "sha256:" + state.hexdigest(), count]

        done = []
        for pdf in batches:
            for rec in pdf.itertuples(index=False):
                key = tuple(getattr(rec, g) for g in group)
                if key != current:
                    if current is not None:
                        done.append(row())
                    current, state, count = key, hashlib.sha256(b"["), 0
                state.update((b"," if count else b"") + rec.piece.encode("utf-8"))
                count += 1
            yield pd.DataFrame(done, columns=[*group, "aggregate_digest", "n_artifacts"])
            done = []
        if current is not None:
            yield pd.DataFrame([row()], columns=[*group, "aggregate_digest", "n_artifacts"])

    return run


def aggregate_digest(df: DataFrame, group: list[str], path: str = "path", digest: str = "digest") -> DataFrame:
    """``group, aggregate_digest, n_artifacts``: digest over the path-sorted artifact list.

    SHA-256 of one concatenation is sequential by definition. Rows arrive sorted and feed a running
    hash, so a group needs one narrow pass and constant memory, however many artifacts it has.
    """
    piece = ascii_json(json_object({"digest": json_string(F.col(digest)), "path": json_string(F.col(path))}))
    rows = df.select(*group, F.col(path).alias("path"), piece.alias("piece"))
    ordered = rows.repartition(*group).sortWithinPartitions(*group, "path").drop("path")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*group).schema.fields)
    return ordered.mapInPandas(
        _stream_digest(group), schema=f"{fields}, aggregate_digest string, n_artifacts bigint"
    )
